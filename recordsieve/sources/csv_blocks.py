"""One big CSV over many tasks, line ends within quotes included.

Whether a place in a file is inside quotes depends on all quotes before it. So each block's quotes are counted first, one
task per block; the counts, one small row each, are added up along the file; and then every block is read knowing how it
begins. A record belongs to the block in which the one before it ends. Quotes within values are doubled, as the CSV sink
and most writers do; records end with a line feed, with or without a carriage return before it.
"""

from __future__ import annotations

import csv

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordsieve.sources.files import file_sizes
from recordsieve.sources.zst import _place

BLOCK_BYTES = 32 * 1024 * 1024
BATCH_RECORDS = 8192
_QUOTE, _END = 34, 10


def _range(path: str, begin: int, end: int) -> np.ndarray:
    system, inner = _place(path)
    with system.open_input_file(inner) as file:
        return np.frombuffer(file.read_at(end - begin, begin), np.uint8)


def _ends(data: np.ndarray, is_open: bool) -> tuple[np.ndarray, bool]:
    """Places after the ends of records, and whether the data end inside quotes."""
    inside = np.bitwise_xor.accumulate((data == _QUOTE).view(np.uint8)) ^ np.uint8(is_open)
    return np.flatnonzero((data == _END) & (inside == 0)) + 1, bool(inside[-1]) if len(data) else is_open


def block_records(path: str, size: int, begin: int, end: int, is_open: bool) -> list[bytes]:
    """The records of a block of a file, without line ends; blank lines are no records."""
    data = _range(path, begin, end)
    cuts, is_open = _ends(data, is_open)
    first = 0
    if begin:
        if not len(cuts):
            return []  # in the middle of a record
        first, cuts = int(cuts[0]), cuts[1:]
    parts, at = [data], end
    while at < size:  # up to the first end in the next block
        more = _range(path, at, min(at + (1 << 20), size))
        found, is_open = _ends(more, is_open)
        parts.append(more[: found[0]] if len(found) else more)
        at = size if len(found) else at + len(more)
    whole = np.concatenate(parts).tobytes()
    bounds = [first, *cuts.tolist(), len(whole)]
    records = (whole[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    return [r for r in (x.removesuffix(b"\n").removesuffix(b"\r") for x in records) if r]


def read_csv_blocks(
    spark: SparkSession, path: str, schema: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """CSV files with a header as ``read_csv`` reads them, every file by as many tasks as it has blocks.

    All columns are STRING unless a schema is given. Empty fields are NULL. No files, or files without records, give no
    rows.
    """
    files = file_sizes(spark, path, "csv", "*.csv").where("size > 0").select("path", "size")
    step = F.lit(block_bytes)
    blocks = files.withColumn("begin", F.explode(F.sequence(F.lit(0), F.col("size") - 1, step.cast("bigint"))))
    blocks = blocks.withColumn("end", F.least(F.col("begin") + step, "size"))
    n = max(1, blocks.count())
    blocks = blocks.repartition(n, "path", "begin")
    if schema is None:
        names = _header(blocks)
        if not names:
            return spark.createDataFrame([], "value string").limit(0)
        schema = ", ".join(f"`{name}` string" for name in names)

    def count(batches):
        for batch in batches:
            rows = batch.to_pylist()
            quotes = [int((_range(r["path"], r["begin"], r["end"]) == _QUOTE).sum()) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())], [*batch.schema.names, "quotes"])

    counted = blocks.mapInArrow(count, "path string, size bigint, begin bigint, end bigint, quotes bigint")
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)

    def read(batches):
        for batch in batches:
            for r in batch.to_pylist():
                records = block_records(r["path"], r["size"], r["begin"], r["end"], r["open"])
                records = records[1:] if r["begin"] == 0 else records
                for at in range(0, len(records), BATCH_RECORDS):
                    texts = [x.decode("utf-8", "replace") for x in records[at : at + BATCH_RECORDS]]
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["record"])

    records = placed.drop("quotes").repartition(n, "path", "begin").mapInArrow(read, "record string")
    options = {"escape": '"', "nullValue": "", "emptyValue": "", "multiLine": "true"}
    return records.select(F.from_csv("record", schema, options).alias("row")).select("row.*")


def _header(blocks: DataFrame) -> list[str]:
    def first(batches):
        for batch in batches:
            for r in batch.to_pylist():
                records = block_records(r["path"], r["size"], 0, r["end"], False)[:1]
                yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace") for x in records], pa.string())], ["record"])

    one = blocks.where("begin = 0").orderBy("path").limit(1).mapInArrow(first, "record string").first()
    return next(csv.reader([one.record])) if one else []
