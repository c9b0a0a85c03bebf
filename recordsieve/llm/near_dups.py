"""Near-duplicate documents: MinHash bands, signature check, exact check on the full shingle sets, components.

1. Each document gets its shingle set's size and digest, its minima, and a key for each band of minima.
2. Documents with equal sets become one class; only the class's smallest id goes on. Large groups of copies end here.
3. Classes that share a band key form a bucket. Not all pairs of a bucket are compared: first each member with the
   bucket's smallest; then, where a bucket still holds several components, each member with up to 16 central members;
   then members that are still in different components. Pairs that are connected already need no check, so no component
   is lost, and there is no cap on a bucket. Links found by a step are between components of the steps before, so only
   those are connected anew; steps without open buckets, and components without new links, are left out. From the second step on, pairs are left out that cannot reach the threshold:
   a shingle that no other open member has is in no overlap, so the number of a member's other shingles bounds it.
   Central members are those with the fewest such shingles, like the text that copies derive from.
   The last step divides the shingles of open members into frequent ones and rare ones (at most `rare` members have
   them). A pair at the threshold either could reach it by frequent shingles alone, as few unconnected members of one
   bucket can, or it shares a rare one. Then it shares one among the rarest of both: a member with n shingles, m of them
   rare, needs r = max(1, percent of n - (n - m)) in common, so one of its m - r + 1 rarest must be common. Those are
   joined by value, where no value has more than `rare` members.
4. A pair is checked by its signatures (agreement far below the threshold rules it out), then exactly on both sets.

Two sets at the threshold miss each other in all 20 bands of 4 with odds of (1 - 0.85^4)^20 = 4e-7 (0.8: 3e-5).
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha1

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordsieve.llm.components import components
from recordsieve.llm.text import minima, mix, per_text, random_words, shingles, slices, words
from recordsieve.session import collect_garbage, remove, work_dir, written


@dataclass(frozen=True)
class Settings:
    width: int = 5
    percent: int = 80
    bands: int = 20
    rows: int = 4
    seed: int = 5
    #: Signatures that agree in fewer than the threshold minus this share are not compared further: over 5 standard
    #: deviations of the estimate at the threshold.
    slack: float = 0.25
    salts: int = 16
    rare: int = 64


def described(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, n_shingles, digest, signature, bands) of (doc_id, text); NULL texts count as empty."""

    def describe(batches):
        turn = random_words(s.rows, s.seed + 7) | np.uint64(1)
        names = random_words(s.bands, s.seed + 8)
        for batch in slices(batches, "text", 1 << 20):
            found, sizes = shingles(*words(batch.column("text")), s.width)
            lows = minima(found, sizes, s.bands * s.rows, s.seed)
            grouped = lows.astype(np.uint64).reshape(-1, s.bands, s.rows)
            keys = mix((grouped * turn).sum(axis=2, dtype=np.uint64) + names).astype(np.int64)
            sets = [_distinct(x) for x in per_text(found, sizes)]
            flat = pa.array(keys.ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([sha1(x.tobytes()).digest()[:16] for x in sets], pa.binary()),
                    pa.array([x.tobytes() for x in lows], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * s.bands, flat),
                ],
                ["doc_id", "n_shingles", "digest", "signature", "bands"],
            )

    schema = "doc_id bigint, n_shingles bigint, digest binary, signature binary, bands array<bigint>"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(describe, schema)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]])]


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, items): the sorted distinct shingle hashes of (doc_id, text), 8 bytes each."""

    def collect(batches):
        for batch in slices(batches, "text", 1 << 20):
            sets = [_distinct(x).tobytes() for x in per_text(*shingles(*words(batch.column("text")), width))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "items"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        collect, "doc_id bigint, items binary"
    )


def _joined(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(u, v, x, y): the column's values of both ends."""
    one = table.select(F.col("doc_id").alias("v"), F.col(column).alias("y"))
    two = table.select(F.col("doc_id").alias("u"), F.col(column).alias("x"))
    return pairs.join(one, "v").join(two, "u").select("u", "v", "x", "y")


def verified(pairs: DataFrame, signatures: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """The pairs (u, v) whose sets overlap by `percent` of their union or more."""

    def alike(batches):
        least = s.percent / 100 - s.slack
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32) for c in ("x", "y"))
                share = (x == y).reshape(batch.num_rows, -1).mean(axis=1)
                yield batch.select(["u", "v"]).filter(pa.array(share >= least))

    def overlap(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = (np.frombuffer(i.as_buffer(), np.uint64) for i in (x, y))
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= s.percent * (len(both) - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    likely = _joined(pairs, signatures, "signature").mapInArrow(alike, "u bigint, v bigint")
    return _joined(likely, sets, "items").mapInArrow(overlap, "u bigint, v bigint")


def _rare_items(sets: DataFrame, most: int) -> DataFrame:
    """(doc_id, item, f): the items of the sets (doc_id, items) that f sets have, f being `most` or less."""

    def spread(batches):
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("items")]
            if found:
                docs = np.repeat(batch.column("doc_id").to_numpy(), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(docs)], ["item", "doc_id"])

    rows = sets.mapInArrow(spread, "item bigint, doc_id bigint")
    counts = rows.groupBy("item").agg(F.count("*").alias("f")).where(F.col("f") <= most)
    return rows.join(counts, "item").select("doc_id", "item", "f")


def _rarest(items: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(item, doc_id, n, comp): of each of `docs` (doc_id, n, n_rare, comp), the rarest items, one of which any set
    at the threshold shares that shares a rare item at all."""
    order = Window.partitionBy("doc_id").orderBy("f", "item")
    ranked = items.join(docs, "doc_id").withColumn("rank", F.row_number().over(order))
    need = f"greatest(1, ({percent} * n + 99) div 100 - (n - n_rare))"
    return ranked.where(F.expr(f"f > 1 AND rank <= n_rare - {need} + 1")).select("item", "doc_id", "n", "comp")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of `docs` (doc_id, text, ...).

    A text's set is its distinct `width`-word shingles; shorter texts have their whole sequence as the only one. Texts
    without words have an empty set and are linked with nothing. Rows that repeat a doc_id are taken as one document
    where their texts are equal; ids must be unique otherwise. Rows without a doc_id get themselves no component (NULL,
    kept). Other columns are not read. No rows give no rows.
    """
    s, spark = settings, docs.sparkSession
    store = work_dir(spark, "near-dups")
    table = written(described(docs, s), f"{store}/described")
    filled = table.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(filled.groupBy("digest").agg(F.min("doc_id").alias("class_id")), f"{store}/classes")

    firsts = filled.join(classes, [filled.digest == classes.digest, filled.doc_id == classes.class_id], "left_semi")
    firsts = written(firsts.select("doc_id", "n_shingles", "signature", "bands"), f"{store}/firsts")
    keyed = firsts.select("doc_id", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket")).distinct()
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("members"), F.min("doc_id").alias("first"))
    # Written first, as a join with an aggregate of its own other side could not split a hot bucket.
    shared = written(shared.where("members > 1"), f"{store}/shared")
    members = written(keyed.join(shared, "bucket"), f"{store}/members")
    collect_garbage(spark)
    wanted = members.select("doc_id").distinct()
    signatures = written(firsts.join(wanted, "doc_id", "left_semi").select("doc_id", "signature"), f"{store}/signatures")
    texts = docs.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "text")
    sets = written(shingle_sets(texts, s.width), f"{store}/sets")
    collect_garbage(spark)

    def near_size(a: str, b: str):
        return F.expr(f"100 * least({a}, {b}) >= {s.percent} * greatest({a}, {b})")

    def can_link(n: str, common: str, m: str, other: str):
        return F.expr(f"100 * least({common}, {other}) >= {s.percent} * ({n} + {m} - least({common}, {other}))")

    def checked(pairs: DataFrame, step: int) -> DataFrame:
        ordered = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        return written(verified(ordered, signatures, sets, s), f"{store}/links-{step}")

    def open_members(named: DataFrame, step: int) -> DataFrame:
        """Those of the members (bucket, doc_id, n, first, comp, ...) whose buckets hold more than one component."""
        spans = named.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        mixed = written(spans.where("low < high").select("bucket"), f"{store}/mixed-{step}")
        return written(named.join(mixed, "bucket", "left_semi"), f"{store}/open-{step}")

    def joining(links: DataFrame, left: DataFrame) -> DataFrame | None:
        """(node, component) of the components of `left` that `links` join; None without links."""
        collect_garbage(spark)
        if links.isEmpty():
            return None
        names = left.select("doc_id", "comp").distinct()
        one = names.select(F.col("doc_id").alias("u"), F.col("comp").alias("x"))
        two = names.select(F.col("doc_id").alias("v"), F.col("comp").alias("y"))
        return components(links.join(one, "u").join(two, "v").select(F.col("x").alias("u"), F.col("y").alias("v")))

    def renamed(rows: DataFrame, found: DataFrame | None) -> DataFrame:
        """The rows, comp being what it has become in `found`."""
        if found is None:
            return rows
        names = rows.columns
        rows = rows.join(found, rows.comp == found.node, "left").withColumn("comp", F.coalesce("component", "comp"))
        return rows.select(*names)

    # Every member with its bucket's smallest. Members that are left have been compared with it.
    sizes = members.where("doc_id = first").select("bucket", F.col("n").alias("m"))
    pairs = members.where("doc_id <> first").join(sizes, "bucket").where(near_size("n", "m"))
    links = checked(pairs.select(F.col("doc_id").alias("a"), F.col("first").alias("b")), 1)
    collect_garbage(spark)
    found = [components(links)]

    named = renamed(members.select("bucket", "doc_id", "n", "first", F.col("doc_id").alias("comp")), found[0])
    opened = open_members(named, 2)

    def nearest_heads(left: DataFrame) -> DataFrame:
        """Links of every member with up to 16 others in other components."""
        pairs = left.where("doc_id <> first").join(heads, "bucket").where(
            (F.col("comp") != F.col("head.comp")) & can_link("n", "common", "head.n", "head.common")
        )
        return checked(pairs.select(F.col("doc_id").alias("a"), F.col("head.doc_id").alias("b")), 2)

    def all_others(left: DataFrame) -> DataFrame:
        """Links of every pair that is left: those that could be alike by frequent shingles alone, and those that share a
        rare one."""
        is_head = heads.select("bucket", F.col("head.doc_id").alias("doc_id"))
        alike = left.where(F.expr(f"doc_id <> first AND 100 * frequent >= {s.percent} * n"))
        alike = alike.join(is_head, ["bucket", "doc_id"], "left_anti").select(
            "bucket", F.struct("doc_id", "n", "frequent", "comp").alias("x")
        )
        pairs = alike.join(alike.withColumnRenamed("x", "y"), "bucket").where(
            (F.col("x.comp") < F.col("y.comp")) & can_link("x.n", "x.frequent", "y.n", "y.frequent")
        )
        pairs = pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        each = left.select("doc_id", "n", "n_rare", "comp").distinct()
        first = written(_rarest(rare, each, s.percent), f"{store}/rarest")
        first = first.select("item", F.struct("doc_id", "n", "comp").alias("x"))
        sharing = first.join(first.withColumnRenamed("x", "y"), "item").where(
            (F.col("x.comp") < F.col("y.comp")) & near_size("x.n", "y.n")
        )
        sharing = sharing.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        return checked(pairs.unionAll(sharing), 3)

    collect_garbage(spark)
    if not opened.isEmpty():
        sets_left = sets.join(opened.select("doc_id").distinct(), "doc_id", "left_semi")
        rare = written(_rare_items(sets_left, s.rare), f"{store}/rare")
        counts = rare.groupBy("doc_id").agg(F.count("*").alias("n_rare"), F.count_if(F.col("f") == 1).alias("own"))
        counts = written(counts, f"{store}/counts")
        # With n_rare, and how many shingles are common (to two members or more) and frequent.
        left = opened.join(counts, "doc_id", "left").fillna(0, ["n_rare", "own"])
        left = left.withColumn("common", F.col("n") - F.col("own")).withColumn("frequent", F.col("n") - F.col("n_rare"))
        left = written(left, f"{store}/bounded")
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(s.salts))
        heads = left.where("doc_id <> first").groupBy("bucket", salt.alias("salt")).agg(
            F.min(F.struct("own", "doc_id", "n", "common", "comp")).alias("head")
        )
        heads = written(heads.select("bucket", "head"), f"{store}/heads")
        collect_garbage(spark)
        found.append(joining(nearest_heads(left), left))
        if found[-1] is not None:
            left = open_members(renamed(left, found[-1]), 3)
        if not left.isEmpty():
            found.append(joining(all_others(left), left))

    named = classes.select("digest", F.col("class_id").alias("comp"))
    for step in found:
        named = renamed(named, step)
    named = named.select("digest", F.col("comp").alias("component"))
    out = table.join(named, (table.digest == named.digest) & (table.n_shingles > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select(table.doc_id, "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
    out = written(out, work_dir(spark, "near-dups-found"))
    remove(spark, store)
    return out
