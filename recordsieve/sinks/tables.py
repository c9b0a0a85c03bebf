"""Partitioned outputs. A rerun replaces the partitions of its own files only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.operators.stats import BY_FILE


def _writer(df: DataFrame, by: Sequence[str]):
    return (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    )


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one output partition together; adaptive execution joins small
    ones and splits a hot one, so files come out evenly sized."""
    return df.hint("rebalance", *(F.col(c) for c in by))


def write_parquet(
    df: DataFrame, path: str, by: Sequence[str] = BY_FILE, balance: bool = True
) -> None:
    """``balance=False`` saves a shuffle for small tables or rows already
    grouped by ``by``."""
    rows = balanced(df, by) if balance else df
    _writer(rows, by).option("compression", "snappy").parquet(path)


def _csv_text(name: str, dtype: str) -> str:
    if dtype == "boolean":
        return f"CASE `{name}` WHEN true THEN 'True' WHEN false THEN 'False' END AS `{name}`"
    if dtype == "timestamp":
        utc = f"to_utc_timestamp(`{name}`, current_timezone())"
        fraction = f"replace(date_format({utc}, '.SSSSSS'), '.000000', '')"
        return f"date_format({utc}, 'yyyy-MM-dd HH:mm:ss') || {fraction} || '+00:00' AS `{name}`"
    return f"`{name}`"


def write_csv(
    df: DataFrame, path: str, by: Sequence[str] = BY_FILE, balance: bool = True
) -> None:
    """CSV with a header per part file, quotes only where needed.

    NULL and '' both come out empty. Spaces at the ends of values are kept.
    """
    by = tuple(by)
    shown = balanced(df, by) if by and balance else df
    shown = shown.selectExpr(*(_csv_text(n, t) for n, t in shown.dtypes))
    writer = _writer(shown, by) if by else shown.write.mode("overwrite")
    writer.options(
        header=True,
        escape='"',
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_report(report: DataFrame, path: str, by: Sequence[str] = BY_FILE) -> None:
    """Report lines as text, in order within and across the part files."""
    order = [*(F.col(c) for c in by), F.col("section"), F.col("rank").desc(), F.col("line")]
    ordered = report.repartitionByRange(*order).sortWithinPartitions(*order)
    _writer(ordered.select(*by, "line"), by).text(path)
