"""Compressed lines as a Python data source.

The JVM reader takes windows up to 2^27 bytes only; dumps are packed with up to 2^31. A file is Zstandard, gzip or plain
text by its first bytes. Memory is bounded: the window, one block of 128 KiB and one batch of lines (and the longest
line). Tasks on files with a 2^31 window need 2 GiB each outside the JVM heap.

A big file of many frames is read by many tasks: its frames are found from their headers, and a task gets a run of them.
Lines go over the seams: a task leaves out what comes before its first line end, and reads on into the next run up to the
first line end there. A frame itself cannot be split, nor can gzip. Plain text is split anywhere in the same way.
"""

from __future__ import annotations

import codecs
import io
import json
from collections.abc import Iterator, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from recordsieve.sources import frames

FORMAT = "zst_lines"
SCHEMA = "path string, part bigint, line_no bigint, line string, error string"
BLOCKS = "path string, part bigint, line_no bigint, lines array<string>, error string"

MAX_WINDOW = 2**31
READ_BYTES = 128 * 1024
BATCH_ROWS = 8192
BATCH_CHARS = 8 * 1024 * 1024
BLOCK_ROWS = 1024
BLOCK_CHARS = 1024 * 1024
PACK_BYTES = 128 * 1024 * 1024
PACKS_PER_SLOT = 4
SPLIT_BYTES = 256 * 1024 * 1024


def _place(path: str):
    """File system and path within it, of a plain path as listings give it (not encoded as a URI would be)."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    scheme, rest = path.split("://", 1)
    host, _, inner = rest.partition("/")
    system, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{quote(host, safe='@:.')}/")
    return system, f"{base.rstrip('/')}/{inner}" if base.strip("/") else f"/{inner}"


def open_input(path: str):
    """Input stream on any file system Arrow knows (local, hdfs, s3, gs)."""
    system, inner = _place(path)
    return system.open_input_stream(inner, compression=None, buffer_size=READ_BYTES)


def _unzipped(raw, at: int, end: int | None, max_window: int) -> Iterator[tuple[bool, bytes]]:
    """(whether it is beyond `end`, bytes) of the frames from `at` on; a step gives one block's bytes at most."""
    import zstandard

    context, frame = zstandard.ZstdDecompressor(max_window_size=max_window), None
    for place, begins, piece in frames.pieces(raw.read, at):
        frame = context.decompressobj() if begins else frame
        if data := frame.decompress(piece):
            yield end is not None and place >= end, data


def _gunzipped(raw) -> Iterator[tuple[bool, bytes]]:
    import zlib

    member, begun = zlib.decompressobj(31), False
    while block := raw.read(READ_BYTES):
        while block:
            if data := member.decompress(block, READ_BYTES):
                yield False, data
            begun, block = True, member.unconsumed_tail
            if member.eof:
                block, member, begun = member.unused_data, zlib.decompressobj(31), False
    if begun:
        raise EOFError("file ends inside a gzip member")


def _plain(raw, at: int, end: int | None) -> Iterator[tuple[bool, bytes]]:
    while True:
        beyond = end is not None and at >= end
        data = raw.read(READ_BYTES if end is None or beyond else min(READ_BYTES, end - at))
        if not data:
            return
        yield beyond, data
        at += len(data)


def _line_end(data: bytes) -> int:
    """Place after the first line end, 0 without one. A carriage return at the very end counts as one."""
    found = [i for i in (data.find(b"\n"), data.find(b"\r")) if i >= 0]
    return min(found) + (2 if data[min(found) : min(found) + 2] == b"\r\n" else 1) if found else 0


def _own_lines(flagged: Iterator[tuple[bool, bytes]], drop_first: bool) -> Iterator[bytes]:
    """The lines that begin in a part, or exactly at its end. ``flagged`` goes on beyond the end, where told so.

    What comes before the first line end belongs to the part before; a part without a line end has no lines.
    """
    state, after_cr = "drop" if drop_first else "own", False
    for beyond, data in flagged:
        if state == "drop":
            if after_cr:
                cut = int(data.startswith(b"\n"))
                if cut and beyond:
                    return
            else:
                cut = _line_end(data)
                if cut and beyond:
                    return
                if not cut:
                    continue
                if cut == len(data) and data.endswith(b"\r"):
                    after_cr = True  # a line feed may follow
                    continue
            data, state, after_cr = data[cut:], "own", False
            if not data:
                continue
        if not beyond:
            yield data
            continue
        if after_cr:
            if data.startswith(b"\n"):
                yield b"\n"
            return
        cut = _line_end(data)
        yield data[:cut] if cut else data
        if cut and not (cut == len(data) and data.endswith(b"\r")):
            return
        after_cr = bool(cut)


def span_bytes(path: str, at: int = 0, end: int | None = None, max_window: int = MAX_WINDOW) -> Iterator[bytes]:
    """Decompressed bytes of the lines of a file, or of the part of it from `at` to `end`, in small chunks."""
    with open_input(path) as raw:
        head = raw.read(4)
    with open_input(path) as raw:
        if at:
            _skip(raw, at)
        if frames.is_frame(head) or (head and path.endswith(".zst")):
            flagged = _unzipped(raw, at, end, max_window)
        elif head.startswith(frames.GZIP):
            flagged = _gunzipped(raw)
        else:
            flagged = _plain(raw, at, end)
        yield from _own_lines(flagged, bool(at))


def _skip(raw, n: int) -> None:
    if raw.seekable():
        raw.seek(n)
        return
    while n:
        n -= len(raw.read(min(n, 1 << 20)))


def text_chunks(chunks: Iterator[bytes]) -> Iterator[str]:
    """Bad UTF-8 becomes U+FFFD, any line end ``\\n``."""
    utf8 = codecs.getincrementaldecoder("utf-8")("replace")
    decoder = io.IncrementalNewlineDecoder(utf8, translate=True)
    for data in chunks:
        yield decoder.decode(data)
    yield decoder.decode(b"", final=True)


def line_batches(chunks: Iterator[str], rows: int = BATCH_ROWS, chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Stripped lines in batches bounded by rows and by size."""
    batch, size, tail = [], 0, []
    for chunk in chunks:
        first, *rest = chunk.split("\n")
        tail.append(first)
        for piece in rest:
            batch.append("".join(tail).strip())
            size += len(batch[-1])
            tail = [piece]
            if len(batch) >= rows or size >= chars:
                yield batch
                batch, size = [], 0
    last = "".join(tail)
    if last:
        batch.append(last.strip())
    if batch:
        yield batch


class _Files(InputPartition):
    """What one task reads: whole files, and parts of files (path, begin, end)."""

    def __init__(self, paths: list[str], parts: Sequence[tuple[str, int, int | None]] = ()):
        self.paths, self.parts = paths, parts


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"])
        self.parts = json.loads(options.get("parts", "[]"))
        self.max_window = int(options.get("maxWindow", MAX_WINDOW))
        self.pack_bytes = int(options.get("packBytes", PACK_BYTES))
        self.blocks = options.get("rows") == "blocks"

    def __getstate__(self):
        # Every task gets a copy of the reader, and its own files in its partition: no task needs the lists.
        return {**self.__dict__, "files": [], "parts": []}

    def _packed(self, sized: list[tuple], most: int) -> list[list]:
        packs, room = [], 0
        for thing, size in sized:
            if size > room:
                packs.append([])
                room = most
            packs[-1].append(thing)
            room -= size
        return packs

    def partitions(self):
        """One big file or part per task; small files are packed, as are small neighbouring parts. Biggest files first,
        so that the longest task is not the last to start."""
        files = [(path, size) for path, size in sorted(self.files, key=lambda f: (-f[1], f[0]))]
        parts = [((path, begin, end), size) for path, begin, end, size in self.parts]
        # Parts are even, so there are a few packs per slot: one more than slots would take twice the time.
        runs = self._packed(parts, self.pack_bytes // PACKS_PER_SLOT)
        return [_Files([], pack) for pack in runs] + [_Files(paths) for paths in self._packed(files, self.pack_bytes)]

    def read(self, partition):
        import zlib

        import pyarrow as pa
        import zstandard

        kind = pa.list_(pa.string()) if self.blocks else pa.string()
        names = ["path", "part", "line_no", "lines" if self.blocks else "line", "error"]
        types = [pa.string(), pa.int64(), pa.int64(), kind, pa.string()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        bounds = (BLOCK_ROWS, BLOCK_CHARS) if self.blocks else (BATCH_ROWS, BATCH_CHARS)
        for path, part, end in [*partition.parts, *((path, 0, None) for path in partition.paths)]:
            line_no = 1
            try:
                data = span_bytes(path, part, end, self.max_window)
                for lines in line_batches(text_chunks(data), *bounds):
                    n = len(lines)
                    if self.blocks:
                        columns = [[path], [part], [line_no], [lines], [None]]
                    else:
                        columns = [[path] * n, [part] * n, range(line_no, line_no + n), lines, [None] * n]
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                    line_no += n
            except (zstandard.ZstdError, zlib.error, EOFError, OSError, pa.ArrowException) as e:
                # One unreadable file must not stop the others.
                row = {"path": path, "part": part, "error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([row], schema=schema)


class ZstLines(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return BLOCKS if self.options.get("rows") == "blocks" else SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def _parts_of(path: str, size: int, least: int) -> list[tuple[int, int | None]]:
    """How a file is divided; one part if it cannot be, or cannot be read (the reader then reports that)."""
    try:
        system, inner = _place(path)
        with system.open_input_file(inner) as file:
            head = file.read(4)
            if frames.is_frame(head):
                found = frames.runs(frames.starts(file), size, least)
            elif head.startswith(frames.GZIP) or path.endswith(".zst"):
                found = [(0, size)]
            else:
                found = [(at, min(at + least, size)) for at in range(0, size, least)]
    except (EOFError, OSError, ValueError):
        return [(0, None)]
    return [*found[:-1], (found[-1][0], None)]


def split_files(spark: SparkSession, files: Sequence[tuple[str, int]], least: int) -> list[tuple[str, int, int | None]]:
    """(path, begin, end) of the parts of the given files, of `least` bytes or more each. One task walks a file."""
    if not files:
        return []

    def walk(batches):
        import pandas as pd

        for batch in batches:
            rows = [
                (path, begin, end)
                for path, size in zip(batch["path"], batch["size"], strict=True)
                for begin, end in _parts_of(path, int(size), least)
            ]
            yield pd.DataFrame(rows, columns=["path", "begin", "end"]).astype({"end": "Int64"})

    listed = spark.createDataFrame(list(files), "path string, size bigint").repartition(len(files), "path")
    return [tuple(r) for r in listed.mapInPandas(walk, "path string, begin bigint, end bigint").collect()]


def read_zst(
    spark: SparkSession,
    files: Sequence[tuple[str, int]],
    max_window: int = MAX_WINDOW,
    split_bytes: int = SPLIT_BYTES,
    blocks: bool = False,
) -> DataFrame:
    """Lines of ``files`` (path, size in bytes), stripped at both ends.

    ``(path, part, line_no, line, error)``; lines are numbered within a part, and ``part`` is the place in the file where
    it begins, 0 for files that are read whole. A file that cannot be read to its end adds one row with ``error`` set and
    ``line`` NULL. Files of ``split_bytes`` or more are divided at frames; a task reads several parts if they are small. With ``blocks`` a row has up to 1024 ``lines``,
    and ``line_no`` is the first one's number.
    """
    spark.dataSource.register(ZstLines)
    share = sum(size for _, size in files) // spark.sparkContext.defaultParallelism
    big = [(p, s) for p, s in files if s >= split_bytes]
    small = [[p, int(s)] for p, s in files if s < split_bytes]
    sizes = dict(big)
    parts = [(p, a, b, (sizes[p] if b is None else b) - a) for p, a, b in split_files(spark, big, split_bytes)]
    return (
        spark.read.format(FORMAT)
        .option("packBytes", str(min(PACK_BYTES, share)))
        .option("files", json.dumps(small))
        .option("parts", json.dumps(parts))
        .option("maxWindow", str(max_window))
        .option("rows", "blocks" if blocks else "lines")
        .load()
    )


def block_lines(blocks: DataFrame) -> DataFrame:
    """The rows of ``read_zst`` from its blocks; the other columns are carried along."""
    others = [c for c in blocks.columns if c not in ("line_no", "lines", "error")]
    return blocks.selectExpr(*others, "line_no AS first", "error", "posexplode_outer(lines) AS (place, line)").selectExpr(
        *others, "first + place AS line_no", "line", "error"
    )
