"""New files only, with Structured Streaming's own bookkeeping.

The stream is one of files, not of lines: a micro-batch is a list of arrivals, which goes through the same reader, the
same results and the same ledger as a run over a whole tree. So windows up to 2^31 are read, a corrupt file is listed in
``errors`` while the others are published, a batch that is run again after a crash does nothing twice, and what a stream
has done is done for ``run_dataset`` too, and the other way round.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from recordsieve.functions.text import base_name
from recordsieve.plans import ledger
from recordsieve.plans.dataset import run_files
from recordsieve.sources.files import file_sizes
from recordsieve.specs import SPECS, RecordSpec

log = logging.getLogger(__name__)

ARRIVAL = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(spark: SparkSession, folder: str, kind: str, pattern: str, max_files: int | None) -> DataFrame:
    """Stream of (kind, base_name, path, size). Contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(ARRIVAL).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    name = base_name("path") + " AS base_name"
    return reader.load(folder).selectExpr(f"'{kind}' AS kind", name, "path", "length AS size")


def stream_dataset(
    spark: SparkSession,
    root: str,
    output: str,
    checkpoint: str,
    topics: DataFrame,
    bots: DataFrame,
    pattern: str = "*.zst",
    csv: bool = True,
    max_files: int | None = None,
    **options,
) -> None:
    """Process what arrived under ``root/<kind>/`` since the last call, and files that failed and have changed since.

    A micro-batch holds whole files. Files that a run or an earlier batch has done are left out, by path and size.
    """
    output = output.rstrip("/")
    for kind, spec in SPECS.items():
        folder = f"{root.rstrip('/')}/{kind}"
        try:
            files = arrivals(spark, folder, kind, pattern, max_files)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("no folder %s", folder)
            continue
        process = _processor(spec, topics, bots, output, checkpoint, csv=csv, **options)
        query = (
            files.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{kind}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        # The stream knows a file by its path, and so does not see that one has been repaired.
        process(ledger.unseen(file_sizes(spark, folder, kind, pattern), output), None)


def _processor(spec: RecordSpec, topics: DataFrame, bots: DataFrame, output: str, checkpoint: str, **options):
    def process(files: DataFrame, batch_id: int | None) -> None:
        todo = ledger.pending(files, output).orderBy("path").collect()
        if todo:
            batch = f"{checkpoint.rstrip('/')}/{spec.kind}#{'repaired' if batch_id is None else batch_id}"
            run_files(files.sparkSession, spec, todo, output, topics, bots, batch=batch, **options)

    return process
