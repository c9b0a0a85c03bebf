"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents give the TF-IDF weights (2^bits counts, bounded).
2. Benchmark items are cut into passages, and taken in blocks of at most `block` passages; each block is searched for in
   all documents. The space is made from all of the block's TF-IDF passages, and nothing of it from a sample: their right
   singular vectors come from a randomised SVD by distributed range finding, in which each pass is a job over the passages
   whose tasks send sums of rank x vocabulary numbers, bounded by the block.
3. Every document is cut into windows of two half-windows each; windows whose latent cosine with a passage reaches
   `cosine` are candidates. All windows of all documents are compared with the block in the tasks that hold them, so no
   document is shuffled, and nothing but the model is broadcast.
4. A candidate is checked by its longest common subsequence of words with the item, around the window. It counts if
   nearly all of the passage is there in order (`verbatim`), or a good part (`paraphrase`) and the answer: the last
   quarter of the passage, in order, by `answer` or more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm.text import NOT_ALNUM, distinct, random_words, slices, words
from recordsieve.session import work_dir, written

SCHEMA = "doc_id bigint, item_id bigint, cosine double, lcs double, answer double"


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    rank: int = 64
    extra: int = 16  # oversampling
    powers: int = 2
    half: int = 16  # words
    passage: int = 64  # words
    block: int = 2000  # passages searched for at once
    cosine: float = 0.45
    #: Windows of which the space holds less than this share, by length, resemble no passage of the block.
    explained: float = 0.2
    verbatim: float = 0.8
    paraphrase: float = 0.5
    answer: float = 0.6
    seed: int = 3


def _features(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def inverse_frequencies(texts: DataFrame, bits: int) -> np.ndarray:
    """log((documents + 1) / (documents with the feature + 1)) of each feature, over all rows of (text)."""

    def count(batches):
        sums, rows = np.zeros(1 << bits, np.int64), 0
        for batch in slices(batches, "text", 1 << 20):
            hashes, counts = words(batch.column("text"), NOT_ALNUM)
            doc = np.repeat(np.arange(len(counts)), counts)
            found, _ = distinct((doc << bits) | _features(hashes, bits))
            sums += np.bincount(found & ((1 << bits) - 1), minlength=1 << bits)
            rows += batch.num_rows
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(sums[at], rows))], ["feature", "n"]
        )

    found = texts.mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((1 << bits) + 1)
    counts[found.feature.to_numpy()] = found.n.to_numpy()
    return np.log((counts[-1] + 1) / (counts[:-1] + 1)).astype(np.float32)


def cut_items(items: list[tuple[int, str]], size: int) -> list[tuple[int, np.ndarray]]:
    """(item_id, word hashes) of each passage: whole items, or equal parts of at most `size` words of longer ones."""
    if not items:
        return []
    hashes, counts = words(pa.array([x[1] or "" for x in items], pa.large_string()), NOT_ALNUM)
    out, end = [], 0
    for (item, _), n in zip(items, counts.tolist(), strict=True):
        out += [(item, part) for part in np.array_split(hashes[end : end + n], max(1, -(-n // size))) if len(part)]
        end += n
    return out


def _vectors(passages: list[np.ndarray], idf: np.ndarray, vocabulary: np.ndarray, bits: int) -> list[tuple[bytes, bytes]]:
    """Places in the vocabulary and TF-IDF weights of each passage, of length 1 over all features."""
    out = []
    for hashes in passages:
        found, times = distinct(_features(hashes, bits))
        weight = times * idf[found]
        weight = (weight / max(np.sqrt((weight**2).sum()), 1e-9)).astype(np.float32)
        at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
        own = vocabulary[at] == found
        out.append((at[own].astype(np.uint32).tobytes(), weight[own].tobytes()))
    return out


def randomised_svd(rows: DataFrame, width: int, s: Settings) -> np.ndarray:
    """The first right singular vectors, float32[width, rank], of the sparse matrix with rows (number, places, weights).

    Range finding from a random combination of the rows, `powers` passes that sharpen it, then an exact decomposition in
    the space found. Each pass sums rank x width numbers in each task; the driver adds up one such sum per task.
    """
    size = min(s.rank + s.extra, width)
    sc = rows.sparkSession.sparkContext

    def summed(make, shape):
        def add(batches):
            total = np.zeros(shape, np.float32)
            for batch in batches:
                for number, places, weights in zip(*(batch.column(c) for c in ("number", "places", "weights")), strict=True):
                    at, w = np.frombuffer(places.as_buffer(), np.uint32), np.frombuffer(weights.as_buffer(), np.float32)
                    make(total, number.as_py(), at, w)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        parts = rows.mapInArrow(add, "part binary").collect()  # one row per task
        return sum((np.frombuffer(r.part, np.float32).reshape(shape).astype(np.float64) for r in parts), np.zeros(shape))

    def start(total, number, at, w):
        signs = np.random.Generator(np.random.PCG64([s.seed, number & ((1 << 64) - 1)])).standard_normal(size, np.float32)
        total[:, at] += signs[:, None] * w

    basis = np.linalg.qr(summed(start, (size, width)).T)[0].astype(np.float32)
    for _ in range(s.powers):
        shared = sc.broadcast(basis)

        def power(total, number, at, w, shared=shared):
            total[:, at] += (w @ shared.value[at])[:, None] * w

        basis = np.linalg.qr(summed(power, (size, width)).T)[0].astype(np.float32)
    shared = sc.broadcast(basis)

    def gram(total, number, at, w):
        y = w @ shared.value[at]
        total += y[:, None] * y

    _, turn = np.linalg.eigh(summed(gram, (size, size)))
    return (basis @ turn[:, ::-1][:, : s.rank]).astype(np.float32)


def common_subsequence(masks: dict[int, int], size: int, others: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel; `masks` has the places of each word of the first text."""
    rest = whole = (1 << size) - 1
    for word in others:
        hit = rest & masks.get(word, 0)
        if hit:
            rest = ((rest + hit) | (rest - hit)) & whole
    return size - rest.bit_count()


def _masks(hashes: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, h in enumerate(hashes):
        out[h] = out.get(h, 0) | 1 << i
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer): the benchmark items of (item_id, text) that documents (doc_id, text) hold.

    One row per row of `docs` and item, of the passage that fits best. NULL and empty texts hold nothing, items without
    words are held by nothing; equal items are all reported. Other columns are not read. Without documents or items there
    are no rows.
    """
    s, spark = settings, docs.sparkSession
    store = work_dir(spark, "decontaminate")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_items = benchmark.count()
    if not n_items:
        return spark.createDataFrame([], SCHEMA)
    idf = inverse_frequencies(texts.select("text"), s.bits)
    blocks = -(-n_items // (s.block // 2))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    found = None
    for block in range(blocks):
        items = [tuple(r) for r in benchmark.where(block_of == block).select("item_id", "text").collect()]
        part = _search(texts, items, idf, f"{store}/{block}", s)
        found = part if found is None else found.unionAll(part)
    return found


def _search(texts: DataFrame, items: list[tuple[int, str]], idf: np.ndarray, store: str, s: Settings) -> DataFrame:
    spark = texts.sparkSession
    passages = cut_items(items, s.passage)
    if not passages:
        return spark.createDataFrame([], SCHEMA)
    vocabulary = np.unique(np.concatenate([_features(h, s.bits) for _, h in passages]))
    n = len(passages)
    own = [(-1 - i, *v) for i, v in enumerate(_vectors([h for _, h in passages], idf, vocabulary, s.bits))]
    rows = spark.createDataFrame(own, "number bigint, places binary, weights binary")
    rows = written(rows.repartition(4, "number"), f"{store}/passages")
    space = randomised_svd(rows, len(vocabulary), s)

    queries = np.zeros((n, space.shape[1]), np.float32)
    for i, (_, places, weights) in enumerate(own):
        queries[i] = np.frombuffer(weights, np.float32) @ space[np.frombuffer(places, np.uint32)]
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    place = np.full(1 << s.bits, len(vocabulary), np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    shared = spark.sparkContext.broadcast(
        (np.vstack([space * idf[vocabulary][:, None], np.zeros_like(space[:1])]), queries.T.copy(), place, idf**2, [(i, h.tolist()) for i, h in passages])
    )

    def search(batches):
        weighted, targets, place, square, known = shared.value
        masks = {}
        for batch in slices(batches, "text", 1 << 19):
            hashes, counts = words(batch.column("text"), NOT_ALNUM)
            features = _features(hashes, s.bits)
            halves = -(-counts // s.half)
            owner = np.repeat(np.arange(len(counts)), halves)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(halves) - halves, halves)
            start = (np.cumsum(counts) - counts)[owner] + number * s.half
            if not len(start):
                continue
            # Each half's words as a row, padded with a word that weighs nothing; then one column of words at a time.
            inside = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
            row = np.repeat(np.cumsum(halves) - halves, counts) + inside // s.half
            at = np.full((len(start), s.half), len(weighted) - 1, np.int32)
            at[row, inside % s.half] = place[features]
            sums = np.zeros((len(start), targets.shape[0]), np.float32)
            for k in range(s.half):
                sums += weighted[at[:, k]]
            norms = np.add.reduceat(square[features], start)
            # A window is a half and the next one of the same text; the last half stands alone if it is the only one.
            pair = np.flatnonzero(owner[1:] == owner[:-1])
            single = np.flatnonzero(halves[owner] == 1)
            windows = np.concatenate([sums[pair] + sums[pair + 1], sums[single]])
            whole = np.concatenate([norms[pair] + norms[pair + 1], norms[single]])
            first = np.concatenate([pair, single])
            length = np.linalg.norm(windows, axis=1)
            near = np.flatnonzero(length >= s.explained * np.sqrt(whole))
            cosines = (windows[near] / np.maximum(length[near, None], 1e-9)) @ targets
            rows, items = np.nonzero(cosines >= s.cosine)
            best: dict[tuple[int, int], tuple] = {}
            for row, item in zip(rows.tolist(), items.tolist(), strict=True):
                half = int(first[near[row]])
                doc = int(owner[half])
                item_id, own = known[item]
                if item not in masks:
                    tail = own[-max(1, len(own) // 4) :]
                    masks[item] = _masks(own), _masks(tail), len(tail)
                low = int(start[half]) - len(own)
                text_low = int(start[half] - number[half] * s.half)
                region = hashes[max(low, text_low) : min(int(start[half]) + 2 * s.half + len(own), text_low + int(counts[doc]))]
                region = region.tolist()
                whole_mask, tail_mask, tail_size = masks[item]
                lcs = common_subsequence(whole_mask, len(own), region) / len(own)
                if lcs < s.paraphrase:
                    continue
                answer = common_subsequence(tail_mask, tail_size, region) / tail_size
                if lcs >= s.verbatim or answer >= s.answer:
                    got = lcs, answer, float(cosines[row, item])
                    best[doc, item_id] = max(best.get((doc, item_id), got), got)
            if best:
                ids = batch.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([d for d, _ in best])),
                        pa.array([i for _, i in best], pa.int64()),
                        *(pa.array([v[k] for v in best.values()], pa.float64()) for k in (2, 0, 1)),
                    ],
                    ["doc_id", "item_id", "cosine", "lcs", "answer"],
                )

    return texts.mapInArrow(search, SCHEMA)
