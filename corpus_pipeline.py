"""A corpus pipeline of five stages: each works on all documents its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns the next one's documents. `run` writes each stage's rows as Parquet into
the shared folder and reads them back. A stage decides by row, not by id: ids that are missing or repeat lose no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsieve.llm import decontaminate, mixing, near_dups, secrets, toxicity
from recordsieve.llm.rows import fresh, numbered
from recordsieve.operators.membership import bounded
from recordsieve.session import remove, work_dir, written


def _rows(docs: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    """The documents with a row number, its name, and (doc_id, text) with the number in the place of the id."""
    row = fresh("row", docs.columns)
    whole = numbered(docs, row)
    return whole, row, whole.select(F.col(row).alias("doc_id"), "text")


def _without(whole: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """The rows whose number is not in the column doc_id of `dropped`, which is broadcast if it is proven small."""
    found = written(dropped.select(F.col("doc_id").alias(row)).distinct(), work_dir(whole.sparkSession, "dropped"))
    return whole.join(bounded(found), row, "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold. Labels come from the table `labels`, texts from `docs`."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        F.col("doc_id").alias("id"), F.col("toxic").alias("label")
    )
    whole, row, texts = _rows(docs)
    learned = docs.select(F.col("doc_id").alias("id"), "text")
    return _without(whole, row, toxicity.toxicity(texts, labels, texts=learned).where("predicted = 1"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8): the one with the smallest id; documents without
    an id come last, and among equal ids the first row stays."""
    whole, row, texts = _rows(docs)
    found = near_dups.near_duplicates(texts).select(F.col("doc_id").alias(row), "component_id")
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = written(found.join(several, "component_id"), work_dir(spark, "groups"))
    ids = whole.select(row, F.col("doc_id").alias("id")).join(bounded(members), row)
    order = F.struct(F.col("id").isNull(), "id", row)
    first = ids.groupBy("component_id").agg(F.min(order)[row].alias("doc_id")).select("doc_id")
    dropped = members.select(F.col(row).alias("doc_id")).join(first, "doc_id", "left_anti")
    return _without(whole, row, dropped)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole, row, texts = _rows(docs)
    return _without(whole, row, decontaminate.contaminated(texts, items))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars, if there is one, brought up to date where the text changed."""
    names = docs.columns
    if "n_chars" not in names:
        return secrets.redacted(docs)
    before = fresh("before", names)
    new = secrets.redacted(docs.withColumn(before, F.sha2(F.col("text"), 256)))
    changed = ~F.sha2(F.col("text"), 256).eqNullSafe(F.col(before))
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
    return new.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row per copy taken, in order of virtual finish time."""
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

#: Trained and approximate stages have no SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, store = spark.read.parquet(f"{sf_dir}/documents.parquet"), work_dir(spark, "pipeline")
    before = None
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{store}/{name}")
        if before:
            remove(spark, f"{store}/{before}")
        before = name
    return docs
