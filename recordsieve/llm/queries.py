"""One query per operator, over its whole tables, with the parameters of its contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsieve.llm import (
    collocations,
    decontaminate,
    fingerprints,
    fp_search,
    mixing,
    near_dups,
    ngram_lm,
    quality,
    secrets,
    spans,
    token_orc,
    toxicity,
    warc,
)
from recordsieve.llm.oracle import ORACLE
from recordsieve.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def _labels(spark: SparkSession, sf_dir: str, label: str, rule: Column) -> DataFrame:
    """(id, label) of the rows whose labels may be learned from."""
    return table(spark, sf_dir, "labels").where(rule).select(F.col("doc_id").alias("id"), F.col(label).alias("label"))


def _by_id(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), "text")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _remainder(10) == 0
    scored = ngram_lm.score(docs, ngram_lm.train(docs.where(~held_out).select("text")))
    return scored.withColumn("held_out", held_out)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), work_dir(spark, "warc-archives"))
    rows = warc.read_archives(archives, payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, _labels(spark, sf_dir, "toxic", _remainder(3) != 1), texts=_by_id(docs))
    return scored.withColumn("held_out", _remainder(3) == 1)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dups.near_duplicates(docs, near_dups.Settings(width=3, percent=85))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.quality(docs, _labels(spark, sf_dir, "quality", _remainder(4) != 2), texts=_by_id(docs))
    return scored.withColumn("held_out", _remainder(4) == 2)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.span_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    settings = token_orc.Settings(public_tokenizers.path("word_bpe_49k.json"), by_piece=True, end=2)
    return token_orc.token_store(docs, work_dir(spark, "token-orc"), settings)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fp_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))


REGISTRY = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_warc,
        op3_secret_scans,
        op4_mixing,
        op5_toxicity,
        op6_near_dedup,
        op7_quality,
        op8_substring_dedup,
        op9_decontamination,
        op10_fingerprints,
        op11_token_orc,
        op12_ranked_search,
        op13_collocations,
    )
}

__all__ = ["ORACLE", "REGISTRY"]
