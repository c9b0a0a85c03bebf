"""Logistic regression over hashed features, trained by FTRL-proximal.

Every coordinate has its own learning rate, and L1 keeps the weights of features that tell little at exactly 0. What is
left is a short list of (feature, weight), which is broadcast for scoring (at most 2^bits entries of 12 bytes).

Training uses all labelled rows. They are dealt by a hash of their ids into shards of about `max_rows` rows, as many as it
takes; each shard is learned by one task, update after update in hash order, so a task reads a bounded number of rows of
at most 2^bits features each. The shards' weights are averaged: each coordinate by the sum of squared slopes that a
shard has seen of it, so that a shard that never met a feature has no say in it. One shard's weights stay as they are.
Only features to which some shard gives a weight are shuffled for that, a small part of what the shards have seen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordsieve.llm.text import slices
from recordsieve.operators.membership import bounded
from recordsieve.session import work_dir, written

#: Of a text column: hashes of all features of all texts, and the number of each text's.
Features = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    max_rows: int = 16_000
    passes: int = 2
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    seed: int = 11


def presence(features: Features, column: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """The sorted distinct feature numbers of each text."""
    hashes, sizes = features(column)
    numbers = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    end = 0
    for size in sizes.tolist():
        part = np.sort(numbers[end : end + size])
        yield part[np.concatenate([np.ones(min(size, 1), bool), part[1:] != part[:-1]])].astype(np.uint32)
        end += size


class Learner:
    """The state of FTRL-proximal: z and n of each coordinate; the last coordinate is the constant term."""

    def __init__(self, settings: Settings):
        self.settings, size = settings, (1 << settings.bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.settings, self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0)
        return -shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)

    def learn(self, numbers: np.ndarray, label: int) -> None:
        at = np.append(numbers, len(self.z) - 1).astype(np.int64)
        w, n = self.weights(at), self.n[at]
        slope = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / self.settings.alpha * w
        self.n[at] = n + slope * slope

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights(np.arange(len(self.z)))
        return (kept := np.flatnonzero(w)).astype(np.uint32), w[kept].astype(np.float64)

    def seen(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, weight and sum of squared slopes of each coordinate that an example had."""
        kept = np.flatnonzero(self.n)
        return kept, self.weights(kept), self.n[kept]


def averaged(models: DataFrame, store: str) -> DataFrame:
    """(number, weight): the average of the shards' (number, weight, n), of the numbers that have a weight in any shard.

    Without a weight in every shard a number has none on average either; those rows, most of a model, are not shuffled.
    """
    some = written(models.where("weight <> 0").select("number").distinct(), store)
    rows = models.join(bounded(some), "number", "left_semi")
    # Added up in one order, whichever shard comes first.
    seen = rows.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("n", "weight"))).alias("x"))
    total = "aggregate(x, 0D, (a, y) -> a + y.n * y.weight) / aggregate(x, 0D, (a, y) -> a + y.n)"
    return seen.selectExpr("number", f"{total} AS weight")


def train(labels: DataFrame, texts: DataFrame, features: Features, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and weights, learned from `labels` (id, label) and `texts` (id, text).

    Labelled rows that have a text are found by their ids; only their texts are sent to their shards. Rows with a NULL
    label or id, or an id without a text, are left out; a NULL text is empty. Each labelled row is one example: an id that
    has several texts stands for the one with the smallest hash. Without rows, or with one label only, the score is the
    share of label 1 (0.5 without rows) that the constant term has reached.
    """
    s = settings
    known = labels.where("label IS NOT NULL AND id IS NOT NULL").select("id", F.col("label").cast("int").alias("label"))
    chosen = known.join(texts.select("id"), "id", "left_semi")
    names = ("shard", "turn", "label", "number", "pick")

    def learned(examples):
        """Examples by number: (pick, turn, label, features)."""
        learner = Learner(s)
        found = [(turn, label, np.frombuffer(x, np.uint32)) for _, turn, label, x in examples.values()]
        found.sort(key=lambda x: (x[0], x[1], x[2].tobytes()))
        for _ in range(s.passes):
            for _, label, numbers in found:
                learner.learn(numbers, label)
        columns = zip(learner.seen(), (pa.int32(), pa.float64(), pa.float64()), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns], ["number", "weight", "n"])

    def learn(batches):
        shard, examples = None, {}
        for batch in slices(batches, "text", 1 << 20):
            parts = presence(features, batch.column("text"), s.bits)
            rows = zip(*(batch.column(c).to_pylist() for c in names), parts, strict=True)
            for own, turn, label, number, pick, part in rows:
                if own != shard and examples:
                    yield learned(examples)
                    examples = {}
                shard = own
                if number not in examples or pick < examples[number][0]:
                    examples[number] = pick, turn, label, part.tobytes()
        if examples:
            yield learned(examples)

    def pack(batches):
        rows = [b for b in batches if b.num_rows]
        numbers, weights = (
            np.concatenate([np.zeros(0), *(b.column(c).to_numpy() for b in rows)]) for c in ("number", "weight")
        )
        order = np.argsort(numbers)
        numbers, weights = numbers[order].astype(np.uint32), weights[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array([numbers.tobytes()]), pa.array([weights.tobytes()])], ["numbers", "weights"]
        )

    store = work_dir(texts.sparkSession, "ftrl")
    chosen = written(chosen.withColumn("number", F.monotonically_increasing_id()), f"{store}/labelled")
    shards = max(1, -(-chosen.count() // s.max_rows))
    rows = texts.select("id", F.coalesce("text", F.lit("")).alias("text")).join(bounded(chosen), "id")
    rows = rows.select(
        F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(s.seed + 1)), F.lit(shards)).alias("shard"),
        F.xxhash64(F.col("id").cast("string"), F.lit(s.seed)).alias("turn"),
        "label",
        "number",
        F.xxhash64("text").alias("pick"),
        "text",
    )
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard")
    models = written(dealt.mapInArrow(learn, "number int, weight double, n double"), f"{store}/models")
    if shards > 1:
        models = averaged(models, f"{store}/weighted")
    some = models.where("weight <> 0").select("number", "weight")
    row = some.coalesce(1).mapInArrow(pack, "numbers binary, weights binary").first()
    return np.frombuffer(row.numbers, np.uint32), np.frombuffer(row.weights, np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], features: Features, bits: int, text: Column) -> DataFrame:
    """(doc_id, score) of every row; a NULL text is scored as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches):
        numbers, weights = shared.value  # short and sparse; each task lays them out for itself
        w = np.zeros((1 << bits) + 1, np.float32)
        w[numbers] = weights
        for batch in slices(batches, "text", 1 << 20):
            hashes, sizes = features(batch.column("text"))
            spots = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            hit = np.flatnonzero(w[spots])
            doc = np.searchsorted(np.cumsum(sizes), hit, "right")
            pairs = np.unique((doc << bits) | spots[hit])  # a feature counts once in each text
            total = np.bincount(pairs >> bits, w[pairs & ((1 << bits) - 1)], batch.num_rows) + w[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], ["doc_id", "score"]
            )

    return docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text")).mapInArrow(
        apply, "doc_id bigint, score double"
    )
