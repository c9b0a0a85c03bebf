"""Duplicate check and removal on a CSV output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordsieve.operators.duplicates import drop_duplicates, duplicate_rows, duplicate_summary
from recordsieve.sinks.tables import write_csv
from recordsieve.sources.files import read_csv


def check_duplicates(
    spark: SparkSession,
    csv_path: str,
    output: str,
    id_column: str = "id",
    schema: str | None = None,
    long_keys: bool = True,
) -> DataFrame:
    """Summary of repeated ids; the rows themselves go to ``output`` as CSV, if
    there are any. Keys are compared by their SHA-256 unless ``long_keys`` is off."""
    rows = read_csv(spark, csv_path, schema)
    summary = duplicate_summary(rows, id_column, long_keys)
    counts = summary.first()
    if counts["dup_rows"] > 0:
        write_csv(duplicate_rows(rows, id_column, long_keys), output, by=())
    return spark.createDataFrame([counts], summary.schema)


def remove_duplicates(
    spark: SparkSession, csv_path: str, output: str, id_column: str = "id", schema: str | None = None
) -> DataFrame:
    """Write the CSV again to ``output``, one row for each id: the first by all columns. Returns the counts before.

    Rows without an id count as one.
    """
    rows = read_csv(spark, csv_path, schema)
    write_csv(drop_duplicates(rows, id_column, rows.columns, long_keys=True), output, by=())
    return duplicate_summary(rows, id_column, long_keys=True)
