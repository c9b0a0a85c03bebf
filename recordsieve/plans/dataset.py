"""Clean a whole tree of dumps, only what is not done yet."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordsieve.functions.text import base_name
from recordsieve.operators import stats
from recordsieve.operators.audit import staged_audit
from recordsieve.operators.cascade import judge
from recordsieve.operators.membership import bounded
from recordsieve.operators.project import rejected_values, staged
from recordsieve.plans import ledger
from recordsieve.plans.ledger import BY_FILE, FILE_ID, read_table
from recordsieve.session import remove, work_dir, written
from recordsieve.sinks.tables import write_csv, write_parquet, write_report
from recordsieve.sources.files import FILES, file_sizes, list_files
from recordsieve.sources.zst import block_lines, read_zst
from recordsieve.specs import SPECS, RecordSpec

log = logging.getLogger(__name__)

PARSE_BYTES = 64 * 1024 * 1024  # compressed input per parse task
MAX_BATCH_BYTES = 256 * 1024**3  # compressed input per run


def pending_files(spark: SparkSession, root: str, output: str) -> DataFrame:
    """Files under ``root`` that no earlier run or batch has completed."""
    return ledger.pending(list_files(spark, root), output)


def publish(
    lines: DataFrame,
    files: DataFrame,
    spec: RecordSpec,
    topics: DataFrame,
    bots: DataFrame,
    output: str,
    run: str,
    store: str,
    csv: bool = True,
    null_text: str = "",
    balance: bool = False,
) -> DataFrame:
    """Clean the stripped lines of some whole files and write all results of the run.

    ``lines`` has (kind, file_id, base_name, path, line, error), ``files`` a row for each file, also for those without
    lines. A file with an error publishes nothing and is listed in ``errors``. Give ``balance`` if the lines of a file are
    not together. Returns the failed files.
    """
    spark = lines.sparkSession
    judged = staged(judge(lines, spec, topics, bots, stripped=True), spec, null_text)
    seen = Observation("judged")
    judged = judged.observe(
        seen,
        F.count_if(F.col("error").isNotNull()).alias("errors"),
        F.coalesce(F.sum(F.size("rejected")), F.lit(0)).alias("rejected"),
    )
    rows = written(judged, f"{store}/judged")
    metrics = seen.get

    errors = f"{output}/errors"
    failed = rows.where("error IS NOT NULL").groupBy("path").agg(F.min("error").alias("error"))
    failed = failed.join(files, "path").select("kind", "base_name", "path", "size", "error", F.lit(run).alias("run"))
    write_parquet(failed, errors, ("run", "kind"), balance=False)
    failed = read_table(spark, errors, ledger.ERRORS).where((F.col("run") == run) & (F.col("kind") == spec.kind))
    if metrics["errors"]:
        rows = rows.join(bounded(failed.select("path")), "path", "left_anti")
        files = files.join(bounded(failed.select("path")), "path", "left_anti")

    def place(table: str) -> str:
        return f"{output}/{table}/run={run}"

    # The counts of this run are small; every report is made from them.
    cells = written(stats.cells(rows, BY_FILE), f"{store}/cells")
    write_parquet(cells, place("stats/cells"), BY_FILE)
    seeded = stats.seeded(cells, files, BY_FILE)
    write_parquet(stats.totals(seeded, BY_FILE), place("stats/totals"), BY_FILE, balance=False)
    write_parquet(stats.by_reason(seeded, spec.reasons, BY_FILE), place("stats/by_reason"), BY_FILE, balance=False)
    write_parquet(stats.by_group(cells, BY_FILE), place("stats/by_group"), BY_FILE)
    write_report(stats.report_lines(seeded, spec.reasons, BY_FILE), place("stats/report"), BY_FILE)
    write_parquet(staged_audit(rows, spec, BY_FILE), place("stats/null_audit"), BY_FILE, balance=False)
    if metrics["rejected"]:
        write_parquet(rejected_values(rows, BY_FILE), place("rejected"), BY_FILE, balance=False)

    kept = rows.where("out IS NOT NULL").select(*BY_FILE, "out.*")
    write_parquet(kept, place(f"{spec.kind}/parquet"), BY_FILE, balance=balance)
    if csv:
        again = spark.read.schema(kept.schema).parquet(place(f"{spec.kind}/parquet"))
        write_csv(again, place(f"{spec.kind}/csv"), BY_FILE, balance=False)
    return failed


def _batches(files: list, max_bytes: int | None) -> Iterator[list]:
    batch, size = [], 0
    for f in files:
        if batch and max_bytes and size + f.size > max_bytes:
            yield batch
            batch, size = [], 0
        batch.append(f)
        size += f.size
    if batch:
        yield batch


def _uneven(files: list, slots: int) -> bool:
    """Would one file keep a single task busy long after the others?"""
    total = sum(f.size for f in files)
    return len(files) < slots or max(f.size for f in files) > 4 * total / slots


def spread_lines(blocks: DataFrame, parts: int) -> DataFrame:
    """The lines of blocks, dealt out to ``parts`` tasks block by block: a shuffled row is up to 1024 lines."""
    return block_lines(blocks.repartition(parts, "path", "part", "line_no"))


def run_files(
    spark: SparkSession,
    spec: RecordSpec,
    files: list,
    output: str,
    topics: DataFrame,
    bots: DataFrame,
    csv: bool = True,
    null_text: str = "",
    batch: str | None = None,
    slots: int | None = None,
) -> str:
    """Clean some files of one kind as one run and mark them done.

    ``files`` are rows of ``list_files``. They are marked after all results are written, which makes these the live
    version; earlier versions are deleted then. ``batch`` names what asked for the run. ``slots`` is the number of tasks
    that run at a time, for the decision how to spread lines; by default the session's. Returns the run id.
    """
    run = f"r{uuid.uuid4().hex}"
    log.info("run %s: %d files of %s", run, len(files), spec.kind)
    seq = ledger.begin(spark, output)
    store = work_dir(spark, f"run-{spec.kind}")
    slots = slots or spark.sparkContext.defaultParallelism
    uneven = _uneven(files, slots)
    lines = read_zst(spark, [(f.path, f.size) for f in files], blocks=uneven)
    if uneven:
        # A frame is decompressed by one task, but its lines are parsed by many.
        lines = spread_lines(lines, max(4 * slots, sum(f.size for f in files) // PARSE_BYTES))
    lines = lines.selectExpr(
        f"'{spec.kind}' AS kind", f"{FILE_ID} AS file_id", base_name("path") + " AS base_name", "path", "line", "error"
    )
    rows = [(f.kind, f.base_name, f.path, f.size) for f in files]
    listed = spark.createDataFrame(rows, FILES).selectExpr("*", f"{FILE_ID} AS file_id")
    failed = publish(
        lines, listed, spec, topics, bots, output, run, store, csv=csv, null_text=null_text, balance=uneven
    )
    done = listed.join(failed.select("path"), "path", "left_anti").withColumns(
        {"batch": F.lit(batch or run), "seq": F.lit(seq).cast("bigint"), "run": F.lit(run)}
    )
    write_parquet(done.coalesce(1), f"{output}/manifest", ("run",), balance=False)
    ledger.retire(spark, output)
    remove(spark, store)
    return run


def process_files(
    spark: SparkSession,
    kind: str,
    paths: str | list[str],
    output: str,
    topics: DataFrame,
    bots: DataFrame,
    **options,
) -> str:
    """Clean the given files, whether or not they have been done before."""
    files = file_sizes(spark, paths, kind).collect()
    return run_files(spark, SPECS[kind], files, output.rstrip("/"), topics, bots, **options)


def run_dataset(
    spark: SparkSession,
    root: str,
    output: str,
    topics: DataFrame,
    bots: DataFrame,
    max_batch_bytes: int | None = MAX_BATCH_BYTES,
    pattern: str = "*.zst",
    **options,
) -> list[str]:
    """Clean all pending ``root/{comments,submissions}/*.zst`` into ``output``.

    ``max_batch_bytes`` bounds the (compressed) input per run, so that a long
    job has points to resume from. Returns the run ids.
    """
    output = output.rstrip("/")
    listed = list_files(spark, root, pattern)
    files = ledger.pending(listed, output).orderBy("kind", "path").collect()
    return [
        run_files(spark, spec, batch, output, topics, bots, **options)
        for kind, spec in SPECS.items()
        for batch in _batches([f for f in files if f.kind == kind], max_batch_bytes)
    ]
