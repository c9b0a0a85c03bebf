"""Substring dedup by sliding sentence spans.

A text is cut into sentences at line ends and after words that end in . ! ? ; : or , (clauses count as sentences, as some
sentences have hundreds of words). At every sentence begins a run: the shortest one of `sentences` consecutive sentences
or more that has `words` words or more. Runs are hashed over their lower-cased words and joined globally. Of runs with
equal hashes the first stays, by (doc_id, row, place); the sentences that any other one covers are removed.

Two shuffles move about 30 bytes per sentence: one finds the repeated hashes, combining within each task, and one finds their
other places. A hash that a third of all documents hold is one row per task in the first; in the second, adaptive
execution splits it. Texts are shuffled once, to the list of their own removed runs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm.rows import numbered
from recordsieve.llm.text import buffers, mix, slices, words
from recordsieve.session import work_dir, written

_RATIO = 0xC6A4A7935BD1E995 | 1
_STOPS = np.isin(np.arange(256), list(b".!?;:,"))


@dataclass(frozen=True)
class Settings:
    sentences: int = 3
    words: int = 16


def _cut(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Word hashes, words per text, the words' byte places, and the first word of each sentence."""
    hashes, counts, begins, stops = words(column, spans=True)
    if not len(hashes):
        return hashes, counts, begins, stops, np.zeros(0, np.int64)
    data, starts = buffers(column)
    lines = starts[0] + np.flatnonzero((data[starts[0] : starts[-1]] == 10) | (data[starts[0] : starts[-1]] == 13))
    first = np.zeros(len(hashes), bool)
    first[1:] = _STOPS[data[stops[:-1] - 1]] | (np.searchsorted(lines, begins[1:]) > np.searchsorted(lines, stops[:-1]))
    ends = np.cumsum(counts)
    first[(ends - counts)[counts > 0]] = True
    return hashes, counts, begins, stops, np.flatnonzero(first)


def runs(column: pa.Array, s: Settings) -> tuple[np.ndarray, ...]:
    """For each run: its text, the number of its first sentence in the text, how many sentences, its words, its hash."""
    hashes, counts, _, _, first = _cut(column)
    n, k = len(hashes), len(first)
    ends = np.cumsum(counts)
    doc = np.searchsorted(ends, first, "right")
    number = np.arange(k) - np.searchsorted(first, ends - counts)[doc]
    bound = np.append(first, n)
    to = np.maximum(np.arange(k) + s.sentences, np.searchsorted(bound, first + s.words))
    fits = to <= np.searchsorted(first, ends)[doc]
    at, to = np.arange(k)[fits], to[fits]
    a, b = bound[at], bound[to]
    power = np.full(n + 1, _RATIO, np.uint64)
    back = np.full(n + 1, pow(_RATIO, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[:n])])
    found = mix((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return doc[at], number[at], to - at, b - a, found.astype(np.int64)


def _runs(docs: DataFrame, s: Settings) -> DataFrame:
    def find(batches):
        for batch in slices(batches, "text"):
            doc, number, count, _, found = runs(batch.column("text"), s)
            ids, rows = (batch.column(c).take(pa.array(doc)) for c in ("doc_id", "row"))
            place = (number << 20) | np.minimum(count, (1 << 20) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(found), ids, rows, pa.array(place)], ["run", "doc_id", "row", "place"])

    return docs.mapInArrow(find, "run bigint, doc_id bigint, row bigint, place bigint")


def span_dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text, n_sentences, n_removed, removed_words) for every row of `docs` (doc_id, text, ...).

    The text keeps the bytes of its other sentences as they were, with the blanks after them. NULL texts count as empty
    and come out empty; texts with fewer than `sentences` sentences or `words` words stay whole. A later copy of a whole
    text loses all that its runs cover. Rows are told apart by their number (see `rows.numbered`), not by their id: rows
    without an id come first in order, and rows that repeat one follow each other, each a document of its own. A run has
    at most 2^20 - 1 sentences, as it is the shortest one with `words` words. Other columns are not read. No rows give no
    rows.
    """
    s, store = settings, work_dir(docs.sparkSession, "spans")
    texts = numbered(docs.select("doc_id", "text"), "row").withColumn("text", F.coalesce("text", F.lit("")))
    seen = _runs(texts, s).groupBy("run").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "row", "place")).alias("first"))
    repeated = written(seen.where("n > 1").select("run", "first"), f"{store}/repeated")
    again = _runs(texts, s).join(repeated, "run").where("row <> first.row OR place <> first.place")
    removed = again.groupBy("row").agg(F.collect_set("place").alias("places"))
    removed = written(removed, f"{store}/removed")

    def cut(batches):
        for batch in slices(batches, "text"):
            column = batch.column("text")
            _, counts, begins, _, first = _cut(column)
            data, starts = buffers(column)
            ends = np.cumsum(counts)
            low, high = np.searchsorted(first, ends - counts), np.searchsorted(first, ends)
            length = np.diff(np.append(first, len(begins)))
            out, left, words_left = [], [], []
            for i, places in enumerate(batch.column("places")):
                whole = data[starts[i] : starts[i + 1]]
                gone = np.zeros(high[i] - low[i], bool)
                for place in np.asarray(places.values if places.is_valid else [], np.int64):
                    gone[place >> 20 : (place >> 20) + (place & ((1 << 20) - 1))] = True
                if gone.any():
                    cuts = np.append(begins[first[low[i] : high[i]]] - starts[i], len(whole))
                    cuts[0] = 0
                    kept = [whole[cuts[j] : cuts[j + 1]].tobytes() for j in np.flatnonzero(~gone)]
                    out.append(b"".join(kept).decode("utf-8", "replace"))
                else:
                    out.append(whole.tobytes().decode("utf-8", "replace"))
                left.append(int(gone.sum()))
                words_left.append(int(length[low[i] : high[i]][gone].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out, pa.string()), pa.array(high - low, pa.int64()), pa.array(left, pa.int64()), pa.array(words_left, pa.int64())],
                ["doc_id", "text", "n_sentences", "n_removed", "removed_words"],
            )

    return texts.join(removed, "row", "left").mapInArrow(
        cut, "doc_id bigint, text string, n_sentences bigint, n_removed bigint, removed_words bigint"
    )
