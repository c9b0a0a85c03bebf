"""Ranked lexical search over document FP-trees, by depth-first branch-and-bound.

1. One pass over the texts makes a document's restricted vector: its terms among those of the items, with their counts,
   and n, the number of all its terms. N, L and the document frequencies are counted from these vectors.
2. Tasks take the vectors in blocks and build a document FP-tree of each. A vector's terms are put in order of frequency,
   most frequent first, and documents are sorted by them, so documents with a common beginning share a path and every
   subtree is a range of neighbours. A node keeps, for each term below it, the largest tf, and the smallest m.
3. A score grows with tf and falls with m, so a node's maxima and minimum bound every score below it. Each item walks the
   tree depth first, the best child first, and leaves out subtrees whose bound is below its `top`-th score so far (or
   equal to it, with only larger ids). Leaves are scored exactly. The best of one block are the mark for the next.
4. The tasks' lists, at most `top` per item, are merged by rank.

All arithmetic is in 64-bit integers, but for the logarithm of the weight. Terms are compared by 64-bit hashes.
Items are searched in blocks whose terms are bounded; the driver holds one block's terms and their frequencies, and
workers one block of vectors. Nothing else is collected or broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordsieve.llm.text import NOT_ALNUM, per_text, slices, words
from recordsieve.session import work_dir, written

RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"
_LAST = np.iinfo(np.int64).max  # stands for a NULL id, which comes after all others


@dataclass(frozen=True)
class Settings:
    top: int = 50
    #: Items searched in one pass: as many, and with texts of so many bytes together.
    items: int = 5_000
    item_bytes: int = 16 << 20
    #: Documents of one tree, and entries of their vectors.
    documents: int = 16_384
    entries: int = 4 << 20
    leaf: int = 128
    #: Terms by which documents are sorted; a path goes no deeper.
    depth: int = 12


# --- vectors ---


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs) of (doc_id, text): places in the sorted `vocabulary` and counts, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def restrict(batches):
        known = shared.value
        for batch in slices(batches, "text"):
            hashes, counts = words(batch.column("text"), NOT_ALNUM)
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = np.flatnonzero(known[at] == hashes) if len(known) else np.zeros(0, np.int64)
            doc = np.searchsorted(np.cumsum(counts), hit, "right")
            pairs, tf = np.unique(doc * max(len(known), 1) + at[hit], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(counts) + 1) * max(len(known), 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array((pairs % max(len(known), 1)).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64))),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(restrict, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


# --- tree ---


@dataclass
class Level:
    """The nodes of one depth, as ranges of documents, with their bounds and children (in the next level; -1: a leaf)."""

    begin: np.ndarray
    end: np.ndarray
    child: np.ndarray
    child_end: np.ndarray
    m: np.ndarray
    first_id: np.ndarray
    keys: np.ndarray  # term * number of nodes + node, sorted
    tf: np.ndarray


def _ranges_min(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    edges = np.stack([begin, end], axis=1).ravel()
    return np.minimum.reduceat(np.append(values, _LAST), edges)[::2]


class Tree:
    def __init__(self, ids: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, s: Settings):
        """Documents with at least one term each; `terms` are ranks by frequency, ascending within a document."""
        n = len(ids)
        ends = np.cumsum(sizes)
        inside = np.arange(len(terms)) - np.repeat(ends - sizes, sizes)
        doc = np.repeat(np.arange(n), sizes)
        path = np.full((n, s.depth), -1, np.int64)
        near = inside < s.depth
        path[doc[near], inside[near]] = terms[near]
        order = np.lexsort((ids, m, *(path[:, k] for k in range(s.depth - 1, -1, -1))))
        self.ids, self.m, path = ids[order], m[order], path[order]
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        place = place[doc]
        by = np.lexsort((place, terms))
        self.term, self.place, self.tf = terms[by].astype(np.int64), place[by], tfs[by]
        self.keys = self.term * n + self.place
        same = path[1:] == path[:-1]
        self.common = np.where(same.all(axis=1), s.depth, np.argmin(same, axis=1))  # with the next document's path
        self.levels: list[Level] = []
        nodes = [(0, n)]
        while nodes:
            nodes = self._add_level(nodes, s)

    def _add_level(self, nodes: list[tuple[int, int]], s: Settings) -> list[tuple[int, int]]:
        below: list[tuple[int, int]] = []
        child = np.full(len(nodes), -1)
        child_end = np.full(len(nodes), -1)
        for i, (a, b) in enumerate(nodes):
            if b - a > s.leaf:
                child[i] = len(below)
                below += self._split(a, b, s)
                child_end[i] = len(below)
        begin, end = (np.array(x, np.int64) for x in zip(*nodes, strict=True))
        node = np.full(len(self.ids), -1)
        node[np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin) + np.arange((end - begin).sum())] = (
            np.repeat(np.arange(len(nodes)), end - begin)
        )
        of = node[self.place]
        covered = np.flatnonzero(of >= 0)
        keys = self.term[covered] * len(nodes) + of[covered]
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.levels.append(
            Level(
                begin, end, child, child_end, _ranges_min(self.m, begin, end), _ranges_min(self.ids, begin, end),
                keys[cuts], np.maximum.reduceat(self.tf[covered], cuts),
            )
        )
        return below

    def _split(self, a: int, b: int, s: Settings) -> list[tuple[int, int]]:
        """Where the paths of the documents a to b part first; small neighbours go together. Equal paths are cut evenly."""
        inner = self.common[a : b - 1]
        part = inner.min()
        if part == s.depth:
            return [(x, min(x + s.leaf, b)) for x in range(a, b, s.leaf)]
        out = []
        start = a
        last = a
        for cut in [*(np.flatnonzero(inner == part) + a + 1).tolist(), b]:
            if cut - start > s.leaf and last > start:
                out.append((start, last))
                start = last
            if cut - start > s.leaf:
                out.append((start, cut))
                start = cut
            last = cut
        if start < b:
            out.append((start, b))
        return out

    def sums(self, keys, tf, width: int, m, low: int, high: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each entry low to high of a level (or of the documents), the weighted sum over an item's terms."""
        begin, end = np.searchsorted(keys, terms * width + low), np.searchsorted(keys, terms * width + high)
        size = end - begin
        total = int(size.sum())
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)
        which = np.repeat(np.arange(len(terms)), size)
        spot = keys[at] - terms[which] * width
        count = tf[at]
        worth = weights[which] * ((1_000_000_000 * count) // (1_000 * count + 20 * m[spot]))
        # Whole numbers below 2^53 throughout, so the sums are exact.
        return np.bincount(spot - low, worth, high - low).astype(np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], top: int):
        """`best` (scores, ids; best first) brought up to date with the documents of this tree."""
        scores, ids = best
        root = self.levels[0]
        stack = [(int(self.sums(root.keys, root.tf, 1, root.m, 0, 1, terms, weights)[0]), 0, 0)]
        while stack:
            bound, depth, node = stack.pop()
            full = len(scores) == top
            mark, last = (int(scores[-1]), int(ids[-1])) if full else (0, -1)
            level = self.levels[depth]
            if bound <= 0 or bound < mark or (full and bound == mark and level.first_id[node] > last):
                continue
            if level.child[node] < 0:
                low, high = int(level.begin[node]), int(level.end[node])
                got = self.sums(self.keys, self.tf, len(self.ids), self.m, low, high, terms, weights)
                keep = np.flatnonzero((got > 0) & (got >= mark))
                if len(keep):
                    scores, ids = np.concatenate([scores, got[keep]]), np.concatenate([ids, self.ids[low + keep]])
                    order = np.lexsort((ids, -scores))[:top]
                    scores, ids = scores[order], ids[order]
                continue
            low, high = int(level.child[node]), int(level.child_end[node])
            under = self.levels[depth + 1]
            bounds = self.sums(under.keys, under.tf, len(under.begin), under.m, low, high, terms, weights)
            for i in np.argsort(bounds, kind="stable").tolist():  # the best is taken first
                if bounds[i] > 0 and bounds[i] >= mark:
                    stack.append((int(bounds[i]), depth + 1, low + i))
        return scores, ids


def _blocks(batches, s: Settings) -> Iterator[list[pa.RecordBatch]]:
    """Batches cut and collected to blocks of bounded documents and entries."""
    block, n, size = [], 0, 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            ends = batch.column("terms").offsets.to_numpy()
            fits = int(np.searchsorted(ends, ends[at] + s.entries - size, "right")) - 1
            to = min(batch.num_rows, at + s.documents - n, max(fits, at + (n == 0)))
            if to > at:
                block.append(batch.slice(at, to - at))
                n, size, at = n + to - at, size + int(ends[to] - ends[at]), to
            if at < batch.num_rows:
                yield block
                block, n, size = [], 0, 0
    if block:
        yield block


def _tree(block: list[pa.RecordBatch], rank: np.ndarray, total: int, length: int, s: Settings) -> Tree | None:
    table = pa.Table.from_batches(block)
    table = table.filter(pa.compute.greater(pa.compute.list_value_length(table["terms"]), 0)).combine_chunks()
    if not table.num_rows:
        return None
    terms, tfs = table["terms"].combine_chunks(), table["tfs"].combine_chunks()
    sizes = np.diff(terms.offsets.to_numpy())
    own = rank[terms.flatten().to_numpy()]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((own, doc))
    n = table["n"].to_numpy()
    if 50 * int(n.max()) * total < 1 << 63:
        m = 50 + (50 * n * total) // length
    else:
        m = np.array([50 + (50 * int(x) * total) // length for x in n], np.int64)
    ids = table["doc_id"].fill_null(_LAST).to_numpy()
    return Tree(ids, m, sizes, own[order], tfs.flatten().to_numpy()[order], s)


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(item_id, rank, doc_id, score): of each row of `items` (item_id, text, ...), the `top` best rows of `docs` (doc_id,
    text, ...), by descending score and ascending doc_id; fewer if fewer have a score above 0.

    A term counts once in an item. NULL and empty texts have no terms: such a document is in no list, such an item has no
    list. A row without a doc_id comes after all others of its score. Rows that repeat a doc_id are separate documents
    and may be listed side by side; items that repeat an item_id are searched separately and both listed. Texts are read
    whole. Other columns are not read. Without documents or items there are no rows.
    """
    s, spark = settings, docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    asked = items.select(F.col("item_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    n_blocks = max(-(-size.n // s.items), -(-(size.bytes or 0) // s.item_bytes), 1)
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out = None
    for block in range(n_blocks):
        rows = asked.where(block_of == block).orderBy("item_id", "text").collect()
        found = _searched(texts, [tuple(r) for r in rows], f"{work_dir(spark, 'fp-search')}/{block}", s)
        out = found if out is None else out.unionAll(found)
    return out


def _searched(texts: DataFrame, items: list[tuple], store: str, s: Settings) -> DataFrame:
    spark = texts.sparkSession
    hashes, counts = words(pa.array([t for _, t in items], pa.large_string()), NOT_ALNUM)
    asked = [np.unique(x) for x in per_text(hashes, counts)]
    vocabulary = np.unique(hashes)
    if not len(vocabulary):
        return spark.createDataFrame([], RESULT)
    table = written(vectors(texts, vocabulary), f"{store}/vectors")
    whole = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, length = int(whole[0]), int(whole[1])
    if not length:
        return spark.createDataFrame([], RESULT)
    df = np.zeros(len(vocabulary), np.int64)
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        df[r.term] = r.df  # a row for each term of the block's items, no more
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    weight = np.zeros(len(vocabulary), np.int64)
    weight[rank] = [math.floor(1000 * math.log((2 * total + 2) / (2 * x + 1))) for x in df.tolist()]
    queries = []
    for number, own in enumerate(asked):
        places = np.sort(rank[np.searchsorted(vocabulary, own)])
        places = places[weight[places] > 0]
        if len(places):
            queries.append((number, places, weight[places]))
    shared = spark.sparkContext.broadcast((rank, queries))

    def walk(batches):
        rank, queries = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for block in _blocks(batches, s):
            tree = _tree(block, rank, total, length, s)
            if tree:
                best = [tree.search(t, w, b, s.top) for (_, t, w), b in zip(queries, best, strict=True)]
        numbers = np.repeat([q[0] for q in queries], [len(b[0]) for b in best]).astype(np.int32)
        if len(numbers):
            scores, ids = (np.concatenate([b[k] for b in best]) for k in (0, 1))
            ids = pa.array(ids, mask=ids == _LAST)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), ids, pa.array(scores)], ["item", "doc_id", "score"])

    lists = written(table.mapInArrow(walk, "item int, doc_id bigint, score bigint"), f"{store}/lists")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.top)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
