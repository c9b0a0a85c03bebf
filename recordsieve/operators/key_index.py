"""Duplicate removal across deliveries: an index of all keys seen, in buckets, that grows and is never shuffled.

The index is a bucketed table under a path. A delivery is brought to the index's buckets, by the hash of its keys; the
index is read in place, bucket by bucket, as it is. Keys are kept as SHA-256, so a row of the index is 32 bytes and the
name of its delivery, however long a key is.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsieve.session import subfolders, work_dir, written

NULL_KEY = b"\0"  # NULL keys are equal to each other, and to no other


def open_index(spark: SparkSession, location: str, buckets: int = 200) -> tuple[str, int]:
    """The table over an index's folder, and its number of buckets: that of the folder if there is one already.

    Take as many buckets as shuffle partitions, or more; with fewer, Spark would rather shuffle both sides.
    """
    found = [int(n.removeprefix("buckets-")) for n in subfolders(spark, location) if n.startswith("buckets-")]
    buckets = found[0] if found else buckets
    place = f"{location.rstrip('/')}/buckets-{buckets}"
    name = f"key_index_{sha256(place.encode()).hexdigest()[:16]}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (seen_key BINARY, delivery STRING) USING parquet"
        f" CLUSTERED BY (seen_key) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return name, buckets


def _hashed(key: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(F.col(f"`{key}`").cast("binary"), 256)), F.lit(NULL_KEY))


def unseen_rows(df: DataFrame, key: str, index: DataFrame, order_by: Sequence[str], delivery: str) -> DataFrame:
    """The first row, in ``order_by`` order, of every key that no other delivery has brought, as (seen_key, row)."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    order = F.struct(*(F.col(f"`{c}`") for c in order_by))
    first = df.groupBy(_hashed(key).alias("seen_key")).agg(F.min_by(row, order).alias("row"))
    # A merge join reads the index by bucket; no other way of joining would do without an exchange or a broadcast.
    others = index.where(F.col("delivery") != delivery).select("seen_key")
    return first.join(others.hint("merge"), "seen_key", "left_anti")


def drop_seen(
    df: DataFrame, key: str, location: str, delivery: str, order_by: Sequence[str], buckets: int = 200
) -> DataFrame:
    """Rows of a delivery whose key is new, one for each key; the keys are added to the index under ``location``.

    ``delivery`` names what is delivered. The same delivery may be given again, after a crash or not: its own keys do not
    count as seen, and none is added twice. NULL keys count as one key.
    """
    spark = df.sparkSession
    name, buckets = open_index(spark, location, buckets)
    spark.catalog.refreshTable(name)
    index = spark.table(name)
    found = written(unseen_rows(df, key, index, order_by, delivery), work_dir(spark, "unseen"))
    own = index.where(F.col("delivery") == delivery).select("seen_key")
    added = found.select("seen_key").join(own.hint("merge"), "seen_key", "left_anti")
    added = added.withColumn("delivery", F.lit(delivery))
    # Written first, as the table that is added to is read here; one file per bucket.
    added = written(added, work_dir(spark, "added-keys")).repartition(buckets, "seen_key")
    added.select("seen_key", "delivery").write.insertInto(name)
    return found.select("row.*")
