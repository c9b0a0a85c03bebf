"""Interpolated modified Kneser-Ney bigram model: counted in Spark, stored as sorted hash arrays, mapped for scoring.

Words are 64-bit hashes. The model consists of files in the shared folder, each written by the task of one bucket:

- words: sorted hashes and counts. A word's number is its place in all buckets together.
- pairs: sorted scrambled (word number, next word number) and counts. Scrambling is one-to-one, so a pair is exact, and it
  deals pairs evenly whatever word is frequent.
- contexts, by word number: in how many kinds of pairs with count 1, 2, 3+ the word comes first, in how many it comes last.

Everything is combined within each task before it is shuffled, as sorted arrays. There are as many buckets as input
splits, so a task's share stays that of a split at any size. Nothing is pruned. Only sizes, totals and counts of
counts reach the driver (a row per bucket).

p(w|u) = max(c(uw) - D, 0) / c(u) + g(u) p(w), with D1, D2, D3+ by Chen and Goodman for pairs with counts 1, 2, 3+ and
g(u) what they take off. p(w) is the same over the number of kinds of words before w, interpolated with 1 / (V + 1).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm.shared_arrays import mapped, save
from recordsieve.llm.text import distinct, mix, slices, words
from recordsieve.session import work_dir

END = np.uint64(0x8E5C1D2B3A497F61)
HOLD = 4_000_000  # tokens or pairs a task holds before it combines and emits them
BLOB = "bucket int, keys binary, counts binary"


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of `mix`."""
    x = x.astype(np.uint64, copy=True)
    x ^= (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x *= np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x ^= (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    x ^= (x >> np.uint64(30)) ^ (x >> np.uint64(60))
    return x


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text followed by the end token."""
    hashes, counts = words(column)
    return np.insert(hashes, np.cumsum(counts), END), counts + 1


def bounds(n: int) -> np.ndarray:
    """Where each of n equal ranges of 64-bit values begins."""
    return np.array([((i << 64) + n - 1) // n for i in range(n)], np.uint64)


def _dealt(keys: np.ndarray, counts: np.ndarray, n: int) -> pa.RecordBatch | None:
    """Sorted keys as one row for each bucket."""
    cuts = np.append(np.searchsorted(keys, bounds(n)), len(keys))
    full = np.flatnonzero(np.diff(cuts))
    rows = [(keys[cuts[i] : cuts[i + 1]].tobytes(), counts[cuts[i] : cuts[i + 1]].tobytes()) for i in full]
    return pa.RecordBatch.from_arrays(
        [pa.array(full, pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1))],
        ["bucket", "keys", "counts"],
    )


def counted(texts: DataFrame, keys_of, n: int) -> DataFrame:
    """The keys of all texts with their counts, combined within each task, in sorted pieces by bucket (BLOB)."""

    def count(batches):
        held, size = [], 0
        for batch in slices(batches, "text"):
            held.append(keys_of(batch.column("text")))
            size += len(held[-1])
            if size >= HOLD:
                yield _dealt(*_narrow(*distinct(np.concatenate(held))), n)
                held, size = [], 0
        if size:
            yield _dealt(*_narrow(*distinct(np.concatenate(held))), n)

    return texts.mapInArrow(count, BLOB)


def _narrow(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return keys, counts.astype(np.uint32)


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("keys")])
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("counts")])
    order = np.argsort(keys)
    keys = keys[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[cuts], np.add.reduceat(counts[order].astype(np.int64), cuts)


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def discounts(t: list[int]) -> np.ndarray:
    """D for counts 0, 1, 2, 3+. Where counts of counts are too few for the estimate, 0.5, 1 and 1.5."""
    t1, t2, t3, t4 = t
    if min(t) == 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = t1 / (t1 + 2 * t2)
    found = [1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3]
    return np.array([0.0] + [d if 0 < d < k else k / 2 for k, d in enumerate(found, 1)])


@dataclass(frozen=True)
class Model:
    """What a worker needs to open the model: folder, bucket sizes, and totals."""

    store: str
    n: int
    word_starts: np.ndarray  # first word number of each bucket, then V
    n_tokens: int
    n_texts: int
    pair_discounts: np.ndarray
    last_counts: list[int]  # counts of counts of the kinds of words before a word
    last_rest: int  # words with 3 and more
    last_total: int

    @property
    def size(self) -> int:
        return int(self.word_starts[-1])

    def word_numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (V where unknown) and count (0 where unknown) of sorted hashes."""
        numbers, counts = np.full(len(hashes), self.size, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.append(np.searchsorted(hashes, bounds(self.n)), len(hashes))
        for b in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(self.word_starts) > 0)):
            part = hashes[cuts[b] : cuts[b + 1]]
            keys = mapped(f"{self.store}/words-{b}", np.uint64)
            at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
            same = keys[at] == part
            numbers[cuts[b] : cuts[b + 1]][same] = at[same] + self.word_starts[b]
            counts[cuts[b] : cuts[b + 1]][same] = mapped(f"{self.store}/word-counts-{b}", np.int64)[at[same]]
        return numbers, counts

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted scrambled pairs, 0 where unknown."""
        out = np.zeros(len(keys), np.int64)
        cuts = np.append(np.searchsorted(keys, bounds(self.n)), len(keys))
        for b in np.flatnonzero(np.diff(cuts)):
            own = mapped(f"{self.store}/pairs-{b}", np.uint64)
            if not len(own):
                continue
            part = keys[cuts[b] : cuts[b + 1]]
            at = np.minimum(np.searchsorted(own, part), len(own) - 1)
            same = own[at] == part
            found = mapped(f"{self.store}/pair-counts-{b}", np.uint8)[at].astype(np.int64)
            big = mapped(f"{self.store}/pair-large-{b}", np.int64).reshape(2, -1)
            large = np.flatnonzero(same & (found == 255))
            found[large] = big[1][np.searchsorted(big[0], at[large])]
            out[cuts[b] : cuts[b + 1]] = np.where(same, found, 0)
        return out

    def context(self, numbers: np.ndarray) -> np.ndarray:
        """For word numbers (V: the start of a text): pairs it begins with count 1, 2, 3+; pairs it ends. int64[4, n]."""
        out = np.zeros((4, len(numbers)), np.int64)
        span = -(-(self.size + 1) // self.n)
        for r in np.unique(numbers // span):
            at = np.flatnonzero(numbers // span == r)
            own = mapped(f"{self.store}/contexts-{r}", np.uint32).reshape(4, -1)
            out[:, at] = own[:, numbers[at] - r * span]
        return out


def _pair_keys(model_words: Model, column: pa.Array) -> np.ndarray:
    numbers, sizes, _ = _numbered(model_words, column)
    before = np.concatenate([[model_words.size], numbers[:-1]])
    before[np.cumsum(sizes) - sizes] = model_words.size
    return mix((before.astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64))


def _numbered(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number and training count of each token, and the number of tokens of each text."""
    hashes, sizes = tokens(column)
    kinds, back = np.unique(hashes, return_inverse=True)
    numbers, counts = model.word_numbers(kinds)
    return numbers[back], sizes, counts[back]


def train(texts: DataFrame) -> Model:
    """The model of all texts of a DataFrame (text); a NULL text is empty and counts as one end token.

    Without texts, every token has probability 1 / (V + 1) = 1.
    """
    spark = texts.sparkSession
    store = work_dir(spark, "ngram-lm")
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"))
    n = max(4, texts.rdd.getNumPartitions())

    def save_words(key, table):
        b = key[0].as_py()
        keys, counts = _merged(table)
        save(f"{store}/words-{b}", keys)
        save(f"{store}/word-counts-{b}", counts)
        ends = int(counts[keys == END].sum())
        return pa.table({"bucket": pa.array([b], pa.int32()), "kinds": [len(keys)], "total": [int(counts.sum())], "ends": [ends]})

    rows = (
        counted(texts, lambda c: tokens(c)[0], n)
        .repartition(n, "bucket")
        .groupBy("bucket")
        .applyInArrow(save_words, "bucket int, kinds bigint, total bigint, ends bigint")
        .collect()
    )
    kinds = np.zeros(n, np.int64)
    for r in rows:
        kinds[r.bucket] = r.kinds
    starts = np.concatenate([[0], np.cumsum(kinds)])
    if starts[-1] >= (1 << 32) - 1:
        raise ValueError("more than 2^32 different words")
    model = Model(store, n, starts, sum(r.total for r in rows), sum(r.ends for r in rows), np.zeros(4), [0] * 4, 0, 0)
    if not rows:
        return model
    span = -(-(model.size + 1) // n)

    def save_pairs(key, table):
        b = key[0].as_py()
        keys, counts = _merged(table)
        save(f"{store}/pairs-{b}", keys)
        save(f"{store}/pair-counts-{b}", np.minimum(counts, 255).astype(np.uint8))
        large = np.flatnonzero(counts >= 255)
        save(f"{store}/pair-large-{b}", np.stack([large, counts[large]]))
        save(f"{store}/pair-stats-{b}", np.array(_count_of_counts(counts), np.int64))
        pairs = unmix(keys)
        first, last = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        rows = {"bucket": [], "keys": [], "counts": []}
        for kind, numbers in ((1, first[counts == 1]), (2, first[counts == 2]), (3, first[counts >= 3]), (4, last)):
            numbers, times = distinct(numbers)
            cuts = np.append(np.searchsorted(numbers, np.arange(n) * span), len(numbers))
            for r in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[r], cuts[r + 1])
                rows["bucket"].append(int(r) * 8 + kind)
                rows["keys"].append((numbers[part] - r * span).astype(np.uint32).tobytes())
                rows["counts"].append(times[part].astype(np.uint32).tobytes())
        return pa.table(rows, pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]))

    def save_contexts(key, table):
        r = key[0].as_py()
        sums = np.zeros((4, span), np.uint32)
        for b, keys, counts in zip(table["bucket"], table["keys"], table["counts"], strict=True):
            sums[b.as_py() % 8 - 1, np.frombuffer(keys.as_buffer(), np.uint32)] += np.frombuffer(counts.as_buffer(), np.uint32)
        save(f"{store}/contexts-{r}", sums)
        last = sums[3].astype(np.int64)
        stats = [*_count_of_counts(last), int((last >= 3).sum()), int(last.sum())]
        return pa.table({"range": pa.array([r], pa.int32()), "stats": pa.array([stats], pa.list_(pa.int64()))})

    pieces = (
        counted(texts, lambda c: _pair_keys(model, c), n)
        .repartition(n, "bucket")
        .groupBy("bucket")
        .applyInArrow(save_pairs, BLOB)
        .withColumn("range", F.expr("bucket div 8").cast("int"))
    )
    ranges = (
        pieces.repartition(n, "range")
        .groupBy("range")
        .applyInArrow(save_contexts, "range int, stats array<bigint>")
        .collect()
    )
    last = np.sum([r.stats for r in ranges], axis=0).tolist()
    stats = spark.range(0, n, 1, min(n, 16)).mapInArrow(_pair_stats(store), "stats array<bigint>").collect()
    pair_stats = np.sum([r.stats for r in stats], axis=0).tolist()
    for r in set(range(n)) - {r.range for r in ranges}:
        save(f"{store}/contexts-{r}", np.zeros((4, span), np.uint32))
    return Model(
        store, n, starts, model.n_tokens, model.n_texts, discounts(pair_stats), last[:4], last[4], last[5]
    )


def _pair_stats(store: str):
    def read(batches):
        for batch in batches:
            found = []
            for b in batch.column("id").to_pylist():
                try:
                    found.append(mapped(f"{store}/pair-stats-{b}", np.int64).tolist())
                except FileNotFoundError:  # no pair fell into this bucket
                    for name, kind in (("pairs", np.uint64), ("pair-counts", np.uint8), ("pair-large", np.int64)):
                        save(f"{store}/{name}-{b}", np.zeros(0, kind))
                    found.append([0] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], ["stats"])

    return read


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row of (doc_id, text).

    Scores are log10 probabilities of the whole text with its end; `base_score` is the add-0.1 unigram model's. A NULL
    text is empty: its only token is the end. Unknown words share 1 / (V + 1) of the lowest order.
    """
    size = model.size
    d_last = discounts(model.last_counts)
    total = max(model.last_total, 1)
    spare = (d_last[1] * model.last_counts[0] + d_last[2] * model.last_counts[1] + d_last[3] * model.last_rest) / total
    if not model.last_total:
        spare = 1.0

    def apply(batches):
        for batch in slices(batches, "text"):
            numbers, sizes, counts = _numbered(model, batch.column("text"))
            starts = np.cumsum(sizes) - sizes
            before = np.concatenate([[size], numbers[:-1]])
            unknown = before == size
            unknown[starts] = False  # the start of a text is a context the model knows
            before[starts] = size
            known = numbers < size
            base = np.log10((counts + 0.1) / (model.n_tokens + 0.1 * (size + 1)))

            kinds, back = np.unique(np.where(known, numbers, 0), return_inverse=True)
            ends_in = model.context(kinds)[3][back] * known if size else np.zeros(len(numbers))
            low = np.maximum(ends_in - d_last[np.minimum(ends_in, 3).astype(int)], 0) / total + spare / (size + 1)

            p = low
            if size:
                key = mix((before.astype(np.uint64) << np.uint64(32)) | numbers.astype(np.uint64))
                keys, where = np.unique(key, return_inverse=True)
                c = np.where(known & ~unknown, model.pair_counts(keys)[where], 0)
                firsts, back = np.unique(before, return_inverse=True)
                begins = model.context(firsts)[:3][:, back]
                # A word begins as many pairs as it occurs, the start of a text as many as there are texts.
                seen = np.where(before < size, np.concatenate([[0], counts[:-1]]), model.n_texts)
                d = model.pair_discounts
                off = (d[1:, None] * begins).sum(axis=0)
                whole = np.maximum(seen, 1)
                p = np.where(unknown | (seen == 0), low, np.maximum(c - d[np.minimum(c, 3)], 0) / whole + off / whole * low)
            scores = np.add.reduceat(np.log10(p), starts) if len(starts) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts), pa.int64()),
                    pa.array(np.full(len(sizes), model.n_tokens), pa.int64()),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(scores),
                    pa.array(10 ** np.minimum(-scores / sizes, 300)),
                ],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        apply,
        "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double,"
        " perplexity double",
    )
