"""Which version of which file is published.

Every run writes its results under ``run=<id>`` of each table, and then one list of the files it has done: that list is
the commit. A file's live version is the last run that has done it. Readers see live versions only; versions that have
been replaced, and what a run left that broke off, are deleted afterwards. One job at a time writes to an output.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordsieve.operators.membership import bounded
from recordsieve.operators.project import coerce
from recordsieve.session import remove, subfolders
from recordsieve.specs import SPECS

MANIFEST = (
    "kind string, base_name string, path string, size bigint, file_id string, batch string, seq bigint, run string"
)
ERRORS = "kind string, base_name string, path string, size bigint, error string, run string"

#: Of a file: its kind, a hash of its path (names may repeat in different folders), and its name.
BY_FILE = ("kind", "file_id", "base_name")
FILE_ID = "'f' || lpad(lower(hex(xxhash64(path))), 16, '0')"

TABLES = (
    *(f"{kind}/{form}" for kind in SPECS for form in ("parquet", "csv")),
    *(f"stats/{name}" for name in ("cells", "totals", "by_reason", "by_group", "report", "null_audit")),
    "rejected",
)


_SCHEMAS = {
    "stats/cells": "subreddit string, reason string, n bigint",
    "stats/totals": "n_read bigint, n_processed bigint, n_written bigint, n_filtered bigint, n_filtered_legacy bigint",
    "stats/by_reason": "reason string, n bigint",
    "stats/by_group": "subreddit string, n_all bigint, n_topic bigint, n_kept bigint",
    "stats/null_audit": "col string, nulls_before bigint, nulls_after bigint",
    "rejected": "id string, col string, value string",
}


def _schema(spark: SparkSession, table: str) -> StructType:
    """Columns of a published table, with those of its folders."""
    if table in _SCHEMAS:
        own = spark.createDataFrame([], _SCHEMAS[table]).schema
    else:
        spec = SPECS[table.split("/")[0]]
        own = coerce(spark.createDataFrame([], ", ".join(f"`{n}` string" for n in spec.names)), spec).schema
    folders = spark.createDataFrame([], "run string, kind string, file_id string, base_name string").schema
    return StructType([*own.fields, *folders.fields])


def read_table(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A table of earlier runs, empty if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def live_files(spark: SparkSession, output: str) -> DataFrame:
    """The last entry of every file that has been done."""
    entries = read_table(spark, f"{output}/manifest", MANIFEST)
    last = entries.groupBy("kind", "path").agg(F.max_by(F.struct(*entries.columns), "seq").alias("last"))
    return last.select("last.*")


def pending(listed: DataFrame, output: str) -> DataFrame:
    """Of listed files, those that no run and no batch has done, or that have another size since."""
    done = live_files(listed.sparkSession, output).select("kind", "path", "size")
    return listed.join(bounded(done), ["kind", "path", "size"], "left_anti")


def unseen(listed: DataFrame, output: str) -> DataFrame:
    """Of pending files, those that have not failed as they are."""
    failed = read_table(listed.sparkSession, f"{output}/errors", ERRORS).select("kind", "path", "size").distinct()
    return pending(listed, output).join(bounded(failed), ["kind", "path", "size"], "left_anti")


def begin(spark: SparkSession, output: str) -> int:
    """The next run's number. Deletes what runs have left that broke off before their commit."""
    entries = read_table(spark, f"{output}/manifest", MANIFEST)
    last, done = entries.agg(F.max("seq"), F.collect_set("run")).first()  # a name for each run
    for table in TABLES:
        for name in subfolders(spark, f"{output}/{table}"):
            if name.startswith("run=") and name.removeprefix("run=") not in done:
                remove(spark, f"{output}/{table}/{name}")
    return (last or 0) + 1


def live(spark: SparkSession, output: str, table: str, rows: DataFrame | None = None) -> DataFrame:
    """Rows of a published table (``stats/totals``, ``comments/parquet``, ...), live versions only.

    Give ``rows`` where the table needs another reader than Parquet; they need the columns of the folders.
    """
    if rows is None:
        rows = read_table(spark, f"{output}/{table}", _schema(spark, table))
    # The name comes from the list, as folders give '007' as a number.
    files = live_files(spark, output).select("run", "kind", "file_id", F.col("base_name").alias("name_"))
    found = rows.join(bounded(files), ["run", "kind", "file_id"])
    others = [c for c in rows.columns if c not in ("run", *BY_FILE)]
    return found.select("kind", F.col("name_").alias("base_name"), *others)


def retire(spark: SparkSession, output: str) -> None:
    """Delete the versions that have been replaced."""
    entries = read_table(spark, f"{output}/manifest", MANIFEST)
    last = F.max("seq").over(Window.partitionBy("kind", "path"))
    old = entries.withColumn("last", last).where("seq < last").select("run", "kind", "file_id").collect()
    there = {t: set(subfolders(spark, f"{output}/{t}")) for t in TABLES} if old else {}
    for r in old:
        for table, runs in there.items():
            if f"run={r.run}" in runs:
                remove(spark, f"{output}/{table}/run={r.run}/kind={r.kind}/file_id={r.file_id}")
