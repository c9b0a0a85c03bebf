"""Tests against word lists (topics to keep, authors to drop).

A list is a one-column DataFrame ``item`` of distinct lower-case words. It is
broadcast only after its size has been measured. Beyond the bound the plan is
an ordinary equi-join: the list has one row per key, and adaptive execution
splits a hot key of the big side into several tasks.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsieve.functions.names import unused
from recordsieve.functions.text import WHITESPACE

MAX_BROADCAST_ITEMS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def word_list(spark: SparkSession, items: Iterable[str]) -> DataFrame:
    """List given in code: trimmed, lower-cased, blanks dropped, distinct."""
    words = sorted({w.strip(WHITESPACE).lower() for w in items} - {""})
    return spark.createDataFrame(pa.table({"item": pa.array(words, pa.string())}))


def fits_broadcast(
    words: DataFrame,
    max_items: int = MAX_BROADCAST_ITEMS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure a table against the broadcast bounds.

    The limit only stops the measuring early on a huge table; no row is lost.
    """
    width = " + ".join(f"coalesce(octet_length(CAST(`{c}` AS STRING)), 0)" for c in words.columns)
    n, size = (
        words.limit(max_items + 1)
        .selectExpr("count(*)", f"coalesce(sum(16 + {width}), 0)")
        .first()
    )
    return n <= max_items and size <= max_bytes


def bounded(words: DataFrame) -> DataFrame:
    """The table with a broadcast hint if it is proven small, else as it is."""
    return F.broadcast(words) if fits_broadcast(words) else words


def _renamed(df: DataFrame, words: DataFrame) -> tuple[DataFrame, str]:
    """The list with a column name that ``df`` does not have."""
    name = unused("listed_item", df.columns)
    return bounded(words.withColumnRenamed("item", name)), name


def flag_members(df: DataFrame, key: str, words: DataFrame, flag: str) -> DataFrame:
    """Add boolean ``flag``: is ``key`` in the list? Keeps every row once."""
    listed, name = _renamed(df, words)
    joined = df.join(listed, F.expr(f"{key} = {name}"), "left")
    return joined.selectExpr(*(f"`{c}`" for c in df.columns), f"{name} IS NOT NULL AS {flag}")


def keep_members(df: DataFrame, key: str, words: DataFrame) -> DataFrame:
    listed, name = _renamed(df, words)
    return df.join(listed, F.expr(f"{key} = {name}"), "left_semi")


def drop_members(df: DataFrame, key: str, words: DataFrame) -> DataFrame:
    listed, name = _renamed(df, words)
    return df.join(listed, F.expr(f"{key} = {name}"), "left_anti")
