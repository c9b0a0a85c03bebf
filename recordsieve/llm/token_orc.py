"""Token ids as ORC: integer run-length encoding, row indexes, Bloom filters on document ids, stripe-parallel reads.

A store is a folder of ORC files, one per range of doc_id, in ascending order within and across files:

    documents/  doc_id, tie, start_in_file, n_tokens, ids (array<int>)
    files/      a row per file: its name, first document, number of tokens, and `start`, the ids of all files before it

ORC writes integer columns with its run-length encoding, so `ids` and the counters are small without further work. Every
stripe has a row index (least and greatest value of each column for every `stride` rows) and a Bloom filter of doc_id, so
a reader asked for some documents skips stripes and row groups that cannot hold them; a reader asked for a range of
positions skips files by the table `files` and row groups by `start_in_file`. A file is read by as many tasks as it has
stripes.

Texts are shuffled once, to their range of ids, and encoded where they land; ids are never shuffled. The running sum of a
file is made by the one task that writes it. The sums of the files, a row for each, are added up in a table of that size.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordsieve.llm.text import ALONE, GLUE, buffers, slices, words
from recordsieve.operators.membership import bounded

DOCUMENTS = "doc_id bigint, tie bigint, start_in_file bigint, n_tokens bigint, ids array<int>"
FILES = "file string, first struct<doc_id:bigint,tie:bigint>, n_documents bigint, n_tokens bigint, start bigint"


@dataclass(frozen=True)
class Settings:
    #: Of the installed tokenizers library; the path is a parameter, the file is not part of this library.
    tokenizer: str
    #: Whether the tokenizer drops white space, knows no case, and always parts ASCII letters, digits (one by one) and other
    #: signs, so that the ids of a text are those of its pieces. Each piece is then encoded once and remembered. Otherwise
    #: whole texts are encoded.
    by_piece: bool = False
    #: Appended to every document.
    end: int = 2
    stripe_bytes: int = 32 << 20
    stride: int = 1_000
    fpp: float = 0.01
    compression: str = "zstd"


_loaded: dict = {}


def _tokenizer(path: str):
    """Opened once by each worker. Workers are the parallelism, so the library's own threads are off."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
        _loaded[path].no_padding()
        _loaded[path].no_truncation()
    return _loaded[path]


def _encode(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    found = [x.ids for x in _tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes


#: So many pieces are encoded as one text.
JOINED = 200


def _word_ends(path: str) -> np.ndarray | None:
    """Whether each id ends a word, of a tokenizer that marks those by a suffix; None of any other."""
    if ("ends", path) not in _loaded:
        suffix, vocabulary = getattr(_tokenizer(path).model, "end_of_word_suffix", None), _tokenizer(path).get_vocab()
        ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        _loaded["ends", path] = ends if suffix else None
    return _loaded["ends", path]


def _encode_words(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same for runs of letters, by a tokenizer that drops white space: many at a time, parted where words end.

    Each piece has one such end at least, so if there are as many ends as pieces, each has one. Otherwise the pieces of
    a group are encoded one by one.
    """
    ends = _word_ends(path)
    if ends is None:
        return _encode(path, texts)
    groups = [texts[i : i + JOINED] for i in range(0, len(texts), JOINED)]
    joined, lengths = _encode(path, [" ".join(g) for g in groups])
    ids, sizes = [], []
    for group, part in zip(groups, np.split(joined, np.cumsum(lengths)[:-1]), strict=True):
        size = np.diff(np.flatnonzero(ends[part]), prepend=-1)
        if len(size) != len(group) or int(size.sum()) != len(part):
            part, size = _encode(path, group)
        ids.append(part)
        sizes.append(size)
    return np.concatenate(ids), np.concatenate(sizes).astype(np.int64)


def _classes() -> np.ndarray:
    """Letters, digits and other signs. Pieces are not cut at bytes of other characters, at control bytes, at an apostrophe
    (as in `it's`) and at a bar (as in `<|name|>`), as these may belong to what stands beside them."""
    out = np.full(256, GLUE, np.uint8)
    out[33:127] = 2
    out[[*range(65, 91), *range(97, 123)]] = 1
    out[48:58] = ALONE
    out[[ord("'"), ord("|")]] = GLUE
    return out


class Pieces:
    """Ids of pieces seen before, by the pieces' hashes: a piece is encoded by the library once for each worker.

    `most` pieces are remembered at a time (about 30 bytes each); beyond that the list begins anew. Nearly all pieces are
    found at one look into a table by the first `bits` bits of their hashes; only those whose place another piece has
    taken, and new ones, are sorted and looked up in the list.
    """

    def __init__(self, path: str, most: int = 1 << 21, bits: int = 20):
        self.path, self.most, self.classes, self.shift = path, most, _classes(), np.uint64(64 - bits)
        self.size = 1 << bits
        self.clear()

    def clear(self) -> None:
        self.taken, self.entry = np.zeros(self.size, np.uint64), np.full(self.size, -1, np.int32)
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, and whose ids they have
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        plain = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        order = np.argsort(~plain, kind="stable")
        n, hashes = int(plain.sum()), hashes[order]
        parts = [_encode_words(self.path, [texts[i] for i in order[:n].tolist()])] if n else []
        parts += [_encode(self.path, [texts[i] for i in order[n:].tolist()])] if n < len(texts) else []
        ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        number = len(self.ends) - 1 + np.arange(len(hashes))
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        back = np.argsort(hashes)
        hashes, number = hashes[back], number[back]
        at = np.searchsorted(self.known, hashes)
        self.known, self.number = np.insert(self.known, at, hashes), np.insert(self.number, at, number)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts, begins, stops = words(column, spans=True, classes=self.classes)
        data, _ = buffers(column)
        place = (hashes >> self.shift).astype(np.int64)
        entry = self.entry[place]
        rest = np.flatnonzero((self.taken[place] != hashes) | (entry < 0))
        if len(rest):
            entry[rest], cleared = self._entries(hashes[rest], begins[rest], stops[rest], data)
            if cleared:  # entries found before are no longer there
                return self.encode(column)
        begin, size = self.ends[entry], self.ends[entry + 1] - self.ends[entry]
        ends = np.cumsum(size)
        spot = np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))
        upto = np.concatenate([np.zeros(1, np.int64), ends])[np.concatenate([[0], np.cumsum(counts)])]
        return self.ids[spot], np.diff(upto)

    def _entries(self, hashes, begins, stops, data) -> tuple[np.ndarray, bool]:
        """The entries of pieces that the table does not have, and whether the list has begun anew."""
        kinds, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        cleared = bool(len(self.known)) and len(self.known) + len(kinds) > self.most
        if cleared:
            self.clear()
        new = kinds[~np.isin(kinds, self.known, assume_unique=True)] if len(self.known) else kinds
        if len(new):
            at = first[np.searchsorted(kinds, new)]
            places = zip(begins[at].tolist(), stops[at].tolist(), strict=True)
            self._learn(new, [data[a:b].tobytes().decode() for a, b in places])
        entries = self.number[np.searchsorted(self.known, kinds)]
        place = (kinds >> self.shift).astype(np.int64)
        free = np.flatnonzero(self.entry[place] < 0)
        spots, pick = np.unique(place[free], return_index=True)
        self.taken[spots], self.entry[spots] = kinds[free[pick]], entries[free[pick]]
        return entries[kind], cleared


def encoded(column: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one text after the other, each with the end id; and the number of ids of each text."""
    s = settings
    if s.by_piece:
        if ("pieces", s.tokenizer) not in _loaded:
            _loaded["pieces", s.tokenizer] = Pieces(s.tokenizer)
        memory = _loaded["pieces", s.tokenizer]
        ids, sizes = memory.encode(column)
    else:
        ids, sizes = _encode(s.tokenizer, [x or "" for x in column.to_pylist()])
    return np.insert(ids, np.cumsum(sizes), np.int32(s.end)), sizes + 1


def write_tokens(docs: DataFrame, store: str, settings: Settings) -> str:
    """Encode (doc_id, text, ...) into a new store; returns its path.

    NULL texts are empty: they hold the end id alone. Rows without a doc_id come first; rows that repeat one follow each
    other in the order of a hash of their texts, and equal rows are interchangeable. A text is encoded whole, however long
    it is. Without rows the store is empty. Other columns are not read.
    """
    s = settings
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", "tie"]
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)

    def encode(batches):
        start = 0
        for batch in slices(batches, "text", 1 << 20):
            ids, sizes = encoded(batch.column("text"), s)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("tie"),
                    pa.array(start + ends - sizes),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(ids)),
                ],
                ["doc_id", "tie", "start_in_file", "n_tokens", "ids"],
            )
            start += int(ends[-1])

    options = {
        "compression": s.compression,
        "orc.stripe.size": s.stripe_bytes,
        "orc.create.index": "true",
        "orc.row.index.stride": s.stride,
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": s.fpp,
    }
    # One file per task, or the running sum of a file would not start at 0.
    writer = dealt.mapInArrow(encode, DOCUMENTS).write.option("maxRecordsPerFile", 0)
    writer.options(**options).orc(f"{store}/documents")
    spark = docs.sparkSession
    found = spark.read.schema(DOCUMENTS).orc(f"{store}/documents").withColumn("file", F.col("_metadata.file_name"))
    files = found.groupBy("file").agg(
        F.min(F.struct(*order)).alias("first"), F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens")
    )
    before = Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1)  # over a row per file
    files = files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("bigint"))
    files.write.orc(f"{store}/files")
    return store


def read_tokens(spark: SparkSession, store: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, tie, start, n_tokens, ids) of all documents, or of those with the given ids.

    `start` is the number of ids of all documents before it. The condition on ids reaches the ORC reader, which skips by
    file, stripe and row group; `ids` is only read where it is used.
    """
    rows = spark.read.schema(DOCUMENTS).orc(f"{store}/documents")
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    rows = rows.withColumn("name", F.col("_metadata.file_name"))
    files = spark.read.schema(FILES).orc(f"{store}/files").select("file", "start")
    placed = rows.join(bounded(files), F.col("name") == F.col("file"))
    return placed.select("doc_id", "tie", (F.col("start") + F.col("start_in_file")).alias("start"), "n_tokens", "ids")


def read_range(spark: SparkSession, store: str, begin: int, end: int) -> DataFrame:
    """(start, ids) of the documents with ids at the positions begin to end (exclusive), cut to that range.

    Only files that overlap the range are opened, chosen from the table of files.
    """
    files = spark.read.schema(FILES).orc(f"{store}/files")
    some = files.where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > begin))
    names = [r.file for r in some.select("file").collect()]
    if not names:
        return spark.createDataFrame([], "start bigint, ids array<int>")
    rows = spark.read.schema(DOCUMENTS).orc([f"{store}/documents/{name}" for name in names])
    rows = rows.withColumn("name", F.col("_metadata.file_name"))
    placed = rows.join(bounded(some.select("file", F.col("start").alias("base"))), F.col("name") == F.col("file"))
    start = F.col("base") + F.col("start_in_file")
    placed = placed.withColumn("at", start).where((F.col("at") < end) & (F.col("at") + F.col("n_tokens") > begin))
    skip = F.greatest(F.lit(begin) - F.col("at"), F.lit(0))
    size = F.least(F.lit(end), F.col("at") + F.col("n_tokens")) - F.col("at") - skip
    return placed.select((F.col("at") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), size.cast("int")).alias("ids"))


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what `read_tokens` gives: counted and summed up from the ids as read.

    The checksum is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """

    def digest(batches):
        for batch in batches:
            column = batch.column("ids")
            flat = column.values.to_numpy(zero_copy_only=False).astype("<u4")
            ends = column.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "ids").mapInArrow(
        digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_store(docs: DataFrame, store: str, settings: Settings) -> DataFrame:
    """Write a store and give the digests of what is read back from it, one row per row of `docs`."""
    path = write_tokens(docs, store, settings)
    return digests(read_tokens(docs.sparkSession, path))
