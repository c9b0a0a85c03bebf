"""Test tables seen as record dumps.

``documents`` + ``labels`` stand for submissions, ``conversations`` and
``events`` for comments. Every row becomes one JSON line. The modulo terms only
decide which values a line carries (or how it is damaged); no row is left out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPICS_DOCUMENTS = ["Src0", "src3", "SRC5", "src8", "src9", "src10"]
TOPICS_EVENTS = ["Click", "VIEW "]
BOTS_EVENTS = [f"User_{i}" for i in range(10)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core some rows of a table that has fewer files than cores (a
    small test table is one Parquet row group, so one task). Real tables have
    many files and are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= cores else df.repartition(cores, key)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def _every(n: int, value) -> Column:
    return F.when(F.col("event_id") % n == 0, F.lit(value))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line)"""
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("subreddit"),
        F.col("lang").alias("author"),
        F.col("text").alias("selftext"),
        F.col("n_chars").alias("score"),
        (F.col("toxic") == 1).alias("over_18"),
        (F.col("quality") == 1).alias("is_original_content"),
        F.when(F.col("quality") == 0, F.lit("moderator")).alias("removed_by"),
        F.when(F.col("quality").isNotNull(), F.lit("labelled")).alias("distinguished"),
    )
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    rows = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.to_json(record).alias("line"))


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, line)"""
    record = F.struct(
        F.concat(F.lit("c"), "conv_id").alias("link_id"),
        F.when(F.length("text") >= 100, F.lit("Long")).otherwise("Short").alias("subreddit"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
        F.col("turn").cast("string").alias("score"),
    )
    return spread(table(spark, sf_dir, "conversations"), "conv_id").select(
        "conv_id", "turn", F.to_json(record).alias("line")
    )


def _event_lines(spark: SparkSession, sf_dir: str, *rule_fields: Column) -> DataFrame:
    record = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.initcap("event_type").alias("subreddit"),
        F.concat(F.lit("User_"), "user_id").alias("author"),
        F.when(F.col("event_id") % 10 == 0, F.lit("x"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("score"),
        *rule_fields,
    )
    nested = F.when(F.col("event_id") % 5 == 0, F.lit("{}")).otherwise(F.col("props"))
    whole = F.concat(F.expr("substring(flat, 1, length(flat) - 1)"), F.lit(',"gildings":'), nested, F.lit("}"))
    flat = spread(table(spark, sf_dir, "events"), "event_id").withColumn("flat", F.to_json(record))
    return flat.withColumn("whole", whole).select(
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 89 == 0, F.lit(" \t"))
        .when(F.col("event_id") % 97 == 0, F.expr("substring(whole, 1, length(whole) - 3)"))
        .otherwise(F.col("whole"))
        .alias("line"),
    )


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event_type, line)"""
    return _event_lines(
        spark,
        sf_dir,
        _every(11, "moderator").alias("banned_by"),
        (F.col("event_id") % 13 == 0).alias("collapsed_because_crowd_control"),
        _every(17, "GIF").alias("comment_type"),
        (F.col("event_id") % 19 == 0).cast("int").alias("controversiality"),
        _every(23, "moderator").alias("removed_by"),
        _every(29, "deleted").alias("removed_by_category"),
    )


def submission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event_type, line)"""
    return _event_lines(
        spark,
        sf_dir,
        (F.col("event_id") % 11 == 0).alias("quarantine"),
        _every(13, "moderator").alias("banned_by"),
        _every(17, "moderator").alias("removed_by"),
        _every(19, "deleted").alias("removed_by_category"),
        (F.col("event_id") % 23 == 0).alias("over_18"),
    )


def write_zst(
    lines: DataFrame, root: str, broken: tuple[str, ...] = (), wide: tuple[str, ...] = (), frame_rows: int | None = None
) -> None:
    """Write (kind, name, line) as ``root/<kind>/<name>-<task>.zst``.

    Each task writes its own files, so nothing is shuffled. Files whose name is
    in ``broken`` end inside a frame, those in ``wide`` have a window of 2^31
    bytes. With ``frame_rows`` a frame ends, in the middle of a line, about so often.
    """
    run = uuid.uuid4().hex[:8]

    def pack(batches):
        import pandas as pd
        import zstandard
        from pyarrow import fs
        from pyspark import TaskContext

        system, base = fs.FileSystem.from_uri(root)
        task = TaskContext.get().partitionId()
        open_files = {}

        def packer_of(name):
            if name not in wide:
                return zstandard.ZstdCompressor().compressobj()
            params = zstandard.ZstdCompressionParameters(window_log=31, enable_ldm=True, hash_log=20, chain_log=20)
            return zstandard.ZstdCompressor(compression_params=params).compressobj()

        for batch in batches:
            for (kind, name), rows in batch.groupby(["kind", "name"]):
                if (kind, name) not in open_files:
                    system.create_dir(f"{base}/{kind}", recursive=True)
                    out = system.open_output_stream(f"{base}/{kind}/{name}-{run}{task:05d}.zst", compression=None)
                    open_files[kind, name] = out, packer_of(name)
                out, packer = open_files[kind, name]
                step = frame_rows or len(rows)
                for at in range(0, len(rows), step):
                    data = "".join(f"{line}\n" for line in rows["line"][at : at + step]).encode()
                    cut = len(data) // 2 if frame_rows else len(data)
                    out.write(packer.compress(data[:cut]))
                    if frame_rows:
                        out.write(packer.flush(zstandard.COMPRESSOBJ_FLUSH_FINISH))
                        packer = packer_of(name)
                        open_files[kind, name] = out, packer
                        out.write(packer.compress(data[cut:]))
        for (kind, name), (out, packer) in open_files.items():
            mode = zstandard.COMPRESSOBJ_FLUSH_BLOCK if name in broken else zstandard.COMPRESSOBJ_FLUSH_FINISH
            out.write(packer.flush(mode))
            out.close()
        yield pd.DataFrame({"files": [len(open_files)]})

    lines.mapInPandas(pack, "files bigint").write.format("noop").mode("overwrite").save()
