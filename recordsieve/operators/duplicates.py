"""Duplicate reports and removal by any key column.

Long keys (whole texts) are compared by their SHA-256, so 32 bytes per row are
shuffled instead of the text. NULL keys are equal to each other, as in pandas,
but are not a distinct key.

Rows whose key occurs once need not move. A first pass over the key column alone
counts slots: a key's hash modulo a fixed number. The slots that were hit twice
or more become a bitmap, at most SLOTS / 8 bytes, which is broadcast and tested
where the rows are. Only possible repeats go on to the exact step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordsieve.functions.names import unused
from recordsieve.operators.membership import bounded, fits_broadcast
from recordsieve.session import work_dir, written

MAX_HOT_KEYS = 100_000
SLOTS = 1 << 26  # 2^20 rows of 64 bits


def _key(column: str, long_keys: bool) -> Column:
    c = F.col(f"`{column}`")
    return F.unhex(F.sha2(c.cast("binary"), 256)) if long_keys else c


def key_counts(df: DataFrame, key: str, long_keys: bool = False) -> DataFrame:
    """Rows per key, combined per task first: a hot key is one row per task."""
    return df.groupBy(_key(key, long_keys).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def possible_repeats(df: DataFrame, key: str, long_keys: bool = False, slots: int = SLOTS) -> tuple[DataFrame, str]:
    """``df`` with a boolean column, and its name: false only for rows whose key occurs once.

    Nothing is shuffled but slot numbers, combined within each task first. Among far more keys than slots every row is a
    possible repeat, and the exact step has all to do, as it would without this one.
    """
    slot, bits, word, mark = (unused(n, df.columns) for n in ("slot", "slot_bits", "slot_word", "repeats"))
    number = F.pmod(F.xxhash64(_key(key, long_keys)), F.lit(slots))
    hit = df.select(number.alias(slot)).groupBy(slot).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    one = F.expr(f"shiftleft(1L, CAST({slot} & 63 AS INT))")
    bitmap = hit.groupBy(F.expr(f"shiftright({slot}, 6)").alias(word)).agg(F.bit_or(one).alias(bits))
    bitmap = written(bitmap, work_dir(df.sparkSession, "repeated-slots"))
    # Its rows are slots / 64 at most, whatever the table.
    marked = df.withColumn(slot, number).join(F.broadcast(bitmap), F.expr(f"shiftright({slot}, 6) = {word}"), "left")
    test = F.expr(f"coalesce(shiftright({bits}, CAST({slot} & 63 AS INT)) & 1L, 0L) = 1L")
    return marked.select(*(F.col(f"`{c}`") for c in df.columns), test.alias(mark)), mark


def duplicate_rows(df: DataFrame, key: str, long_keys: bool = False) -> DataFrame:
    """All rows whose key occurs more than once.

    Possible repeats are found first, see above; the rest is left out where it
    is. Their keys are counted exactly and stored. Then the rows are read: if the
    stored keys are small they are broadcast, and full rows are not shuffled at
    all. If not, the hottest keys are still broadcast (at most MAX_HOT_KEYS of
    them, by their counts, if they are small enough) and only the rest is
    shuffled, so no task gets a hot key.
    """
    marked, mark = possible_repeats(df, key, long_keys)
    likely = marked.where(F.col(mark)).drop(mark)
    repeated = key_counts(likely, key, long_keys).where("n > 1")
    keys = written(repeated, work_dir(df.sparkSession, "duplicate-keys"))
    return rows_with_keys(likely, keys, _key(key, long_keys), fits_broadcast(keys.select("key")))


def rows_with_keys(df: DataFrame, keys: DataFrame, key: Column, small: bool) -> DataFrame:
    """Rows of ``df`` whose key is in ``keys`` (``key``, ``n`` rows of it)."""
    name = unused("repeated_key", df.columns)
    keys = keys.select(F.col("key").alias(name), "n")

    def semi(rows, some_keys, how="left_semi"):
        return rows.join(some_keys, key.eqNullSafe(F.col(name)), how)

    if small:
        return semi(df, F.broadcast(keys.select(name)))
    # Fewer than MAX_HOT_KEYS keys can exceed this share of the rows.
    share = (keys.agg(F.sum("n")).first()[0] or 0) // MAX_HOT_KEYS
    hot = bounded(keys.where(F.col("n") > share).select(name))
    cold = keys.where(F.col("n") <= share).select(name)
    return semi(df, hot).unionByName(semi(semi(df, hot, "left_anti"), cold))


def duplicate_summary(df: DataFrame, key: str, long_keys: bool = False) -> DataFrame:
    """Total rows, rows with a repeated key, distinct repeated keys."""
    repeated = F.col("n") > 1

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return key_counts(df, key, long_keys).agg(
        total(F.col("n")).alias("total_rows"),
        total(F.when(repeated, F.col("n"))).alias("dup_rows"),
        F.count_if(repeated & F.col("key").isNotNull()).alias("dup_keys"),
    )


def drop_duplicates(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    long_keys: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row per key in ``order_by`` order, all or some ``columns``.

    Rows whose key certainly occurs once stay where they are. The others go
    through an aggregate, not a window: copies are dropped within each task
    before the shuffle, so one key with a third of all rows does not fill one
    task. Name enough columns in ``order_by`` to make the choice unique.
    """
    names = list(columns or df.columns)
    marked, mark = possible_repeats(df, key, long_keys)
    single = marked.where(~F.col(mark)).select(*(F.col(f"`{c}`") for c in names))
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    order = F.struct(*(F.col(f"`{c}`") for c in order_by))
    first = marked.where(F.col(mark)).groupBy(_key(key, long_keys).alias("key")).agg(F.min_by(row, order).alias("row"))
    return single.unionAll(first.select("row.*"))
