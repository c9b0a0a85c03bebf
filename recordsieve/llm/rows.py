"""Row numbers: an identity for rows whose ids may be missing or repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.session import work_dir, written


def fresh(name: str, taken: Sequence[str]) -> str:
    """`name`, or name_2, name_3, ... if a column is called so (in any case) already."""
    used, n, found = {c.lower() for c in taken}, 1, name
    while found.lower() in used:
        n, found = n + 1, f"{name}_{n + 1}"
    return found


def numbered(docs: DataFrame, row: str) -> DataFrame:
    """`docs` with a bigint column `row`, different in every row and the same whenever it is read.

    Rows read from Parquet files have it already: the file's turn by name and the row's place in the file, so nothing is
    written and the number survives any re-reading. Other rows are written with a number once. Numbers go by file and
    place, so rows keep their order as far as there is one.
    """
    spark, names = docs.sparkSession, docs.columns
    if not _scans_files(docs) or "_metadata" in names:
        return written(docs.withColumn(row, F.monotonically_increasing_id()), work_dir(spark, "numbered"))
    path, place, file, turn = (fresh(c, [*names, row]) for c in ("file_path", "row_index", "file", "file_turn"))
    whole = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    paths = sorted(r[0] for r in whole.select(path).distinct().collect())  # one for each file
    files = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], f"{file} string, {turn} bigint")
    number = F.shiftleft(turn, 36) + F.col(place)
    return whole.join(F.broadcast(files), F.col(path) == F.col(file), "left").select(*names, number.alias(row))


def _scans_files(docs: DataFrame) -> bool:
    """Whether each row is one row of a Parquet file: a scan, perhaps with columns or rows left out, and nothing else."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName().startswith("LogicalRelation") and "parquet" in plan.toString()
