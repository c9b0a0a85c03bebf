"""Phrase collocations by Toivonen's method: a sample proposes, full passes count exactly until nothing is missing.

1. A sample of the documents is counted at a lowered threshold. The phrases (words included) that reach it are proposed.
2. A full pass counts every proposed phrase and the negative border: all phrases whose parts without the last and without
   the first word are both proposed. All words are counted. What reaches the threshold is frequent, for certain.
3. Frequent phrases that were not proposed are border failures: longer phrases that hold them have not been counted. The
   frequent phrases known so far become the next proposal, and an expansion pass counts the phrases that its border has
   and no earlier one had. The passes end when all that was found had been proposed; the result is then complete, as a
   frequent phrase's parts are frequent. It does not depend on the sample, which only decides how many passes there are.

Proposals go to the workers as a Bloom filter of bounded size (`most_bits`). A phrase that is in it by chance is counted,
which costs time and changes nothing. Whether an earlier pass counted a phrase is told by that pass's filter, so a phrase
is counted in one pass only.

A word is a 64-bit hash that its language is part of, and a phrase is a hash of its words' hashes. Passes shuffle a hash
and a count, 16 bytes, combined by slice and by task before, so a phrase in every document is a few rows per task.
Languages are not a key of any shuffle of counts. A last pass spells out what is frequent: the words of each phrase.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordsieve.llm.text import buffers, mix, random_words, slices, words
from recordsieve.operators.membership import bounded
from recordsieve.session import remove, work_dir, written

#: Ends of pieces, and ends of words: pieces' ends, blanks and tabs.
STOPS = b".,;:!?\n\x0b\x0c\r"
BREAKS = STOPS + b" \t"
WORDS = ["h1", "h2", "h3", "h4"]
SPELLED = "key bigint, h1 bigint, h2 bigint, h3 bigint, h4 bigint, lang string, word string, n bigint"
RESULT = "lang string, rank int, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"


@dataclass(frozen=True)
class Settings:
    least: int = 30
    longest: int = 4
    top: int = 2_000
    scale: int = 2_000_000
    #: A longer candidate takes in the phrases it holds if it has this percentage of their occurrences.
    percent: int = 80
    #: One document in `share` is in the sample; a phrase is proposed if the sample has it `proposed` times.
    share: int = 32
    proposed: int = 2
    #: Bits of a filter: 16 for each proposed phrase, `most_bits` at most (64 MB).
    most_bits: int = 1 << 29
    slice_bytes: int = 4 << 20
    #: Of the occurrences of a frequent phrase, one in so many is read to spell it out.
    spelled: int = 8
    #: Counts that a task holds back to combine them.
    held: int = 1 << 21
    parts: int = 64


_TURNS = random_words(8, 41) | np.uint64(1)


def _keys(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each phrase; `parts` has the hashes of its first words, of its second words, ..."""
    total = np.full(len(parts[0]), len(parts), np.uint64)
    for k, part in enumerate(parts):
        total += part * _TURNS[k]
    return mix(total)


class Filter:
    """A Bloom filter with two places for each key."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for place in _places(keys, self.mask):
            out &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _places(keys: np.ndarray, mask: np.uint64) -> list[np.ndarray]:
    return [keys & mask, ((keys >> np.uint64(32)) | (keys << np.uint64(32))) & mask]


def filter_of(phrases: DataFrame, s: Settings) -> Filter:
    """A filter of the phrases (key). Tasks set bits, a grouping joins them to words of 64, and these, at most
    most_bits / 64 rows, go to the driver."""
    n_bits = 1 << 16
    n = phrases.count()
    while n_bits < 16 * n and n_bits < s.most_bits:
        n_bits *= 2
    mask = np.uint64(n_bits - 1)

    def places(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            bits = np.unique(np.concatenate(_places(keys, mask)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((bits >> np.uint64(6)).astype(np.int64)),
                    pa.array((np.uint64(1) << (bits & np.uint64(63))).view(np.int64)),
                ],
                ["place", "bit"],
            )

    table = phrases.select("key").mapInArrow(places, "place bigint, bit bigint")
    table = table.groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(n_bits >> 6, np.uint64)
    bits[table["place"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return Filter(bits)


def _salt(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Hashes of all words with their language, whether the next one follows in the same piece, places, and texts."""
    column = batch.column("text")
    hashes, counts, begins, stops = words(column, BREAKS, spans=True)
    langs = batch.column("lang").to_pylist()
    salts = np.array([_salt(x) for x in langs], np.uint64)
    doc = np.repeat(np.arange(len(counts)), counts)
    hashes = mix(hashes + salts[doc])
    hashes[hashes == 0] = 1  # 0 stands for no word
    follows = np.zeros(len(hashes), bool)
    if len(hashes):
        data, starts = buffers(column)
        low = int(starts[0])
        is_stop = np.zeros(256, bool)
        is_stop[list(STOPS)] = True
        upto = np.concatenate([np.zeros(1, np.int32), np.cumsum(is_stop[data[low : int(starts[-1])]], dtype=np.int32)])
        follows[:-1] = (doc[1:] == doc[:-1]) & (upto[begins[1:] - low] == upto[stops[:-1] - low])
    return hashes, follows, begins, stops, doc


class _Sums:
    """Counts by key, held back to be combined; at most about twice `held` entries."""

    def __init__(self, held: int):
        self.held, self.keys, self.counts, self.size = held, [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > self.held:
            self._combine()
            if self.size > self.held // 2:
                yield from self.flush()

    def _combine(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        cuts = np.flatnonzero(np.concatenate([np.ones(1, bool), keys[1:] != keys[:-1]]))
        self.keys, self.counts = [keys[cuts]], [np.add.reduceat(counts, cuts)]
        self.size = len(cuts)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            self._combine()
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.keys[0].view(np.int64)), pa.array(self.counts[0])], ["key", "n"]
            )
        self.keys, self.counts, self.size = [], [], 0


def _counted(texts: DataFrame, now: Filter | None, before: list[Filter], s: Settings, words_too: bool) -> DataFrame:
    """(key, n) of words (where `words_too`) and phrases of (lang, text), with `now` as the proposal.

    Without `now` every phrase counts. Phrases that a filter of `before` would have counted are left out.
    """
    shared = texts.sparkSession.sparkContext.broadcast((now, before))

    def count(batches):
        now, before = shared.value
        sums = _Sums(s.held)
        for batch in slices(batches, "text", s.slice_bytes):
            hashes, follows, *_ = _words(batch)
            own = _keys([hashes])
            if words_too:
                yield from sums.add(*np.unique(own, return_counts=True))
            # Whether the phrase of the length so far that begins here is proposed, now and in earlier passes.
            inside = np.ones(len(hashes), bool)
            ok, was = inside if now is None else now.has(own), [f.has(own) for f in before]
            for size in range(2, s.longest + 1):
                starts = len(hashes) - size + 1
                if starts <= 0:
                    break
                inside = inside[:starts] & follows[size - 2 : size - 2 + starts]
                wanted = inside & ok[:starts] & ok[1 : starts + 1]
                olds = [inside & w[:starts] & w[1 : starts + 1] for w in was]
                need = np.flatnonzero(np.any([wanted, *olds], axis=0))
                keys = _keys([hashes[need + k] for k in range(size)])
                fresh = wanted[need] & ~np.any([np.zeros(len(need), bool), *(old[need] for old in olds)], axis=0)
                yield from sums.add(*np.unique(keys[fresh], return_counts=True))
                if size < s.longest:
                    ok = _spread(now, wanted, need, keys)
                    was = [_spread(f, old, need, keys) for f, old in zip(before, olds, strict=True)]
        yield from sums.flush()

    return texts.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def _spread(f: Filter | None, counted: np.ndarray, need: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Of every place, whether the phrase there was counted and is in the filter."""
    out = np.zeros(len(counted), bool)
    out[need] = counted[need] if f is None else counted[need] & f.has(keys)
    return out


_LOWER = {c: c + 32 for c in range(65, 91)}


def _spelled(texts: DataFrame, known: Filter, s: Settings, one_in: int, rest: Filter | None = None) -> DataFrame:
    """(key, h1, ..., h4, lang, word, n) of the words and phrases in the filter, lang and word of words only; and for
    each lang a row with key 0 and the number of all its words. With `rest`, only phrases that are in that filter too.

    Only one occurrence in `one_in` is looked at, by a hash of its place; a task gives a phrase once.
    """
    shared = texts.sparkSession.sparkContext.broadcast((known, rest))

    def spell(batches):
        (f, rest), seen, totals = shared.value, np.zeros(0, np.uint64), Counter()
        for batch in slices(batches, "text", s.slice_bytes):
            hashes, follows, begins, stops, doc = _words(batch)
            if not len(hashes):
                continue
            langs = batch.column("lang").to_pylist()
            for i, n in zip(*(x.tolist() for x in np.unique(doc, return_counts=True)), strict=True):
                totals[langs[i]] += n
            keys = _keys([hashes])
            ok = f.has(keys)
            at = np.flatnonzero(ok)
            data, _ = buffers(batch.column("text"))
            inside = np.ones(len(hashes), bool)
            found = []
            for size in range(1, s.longest + 1):
                if size > 1:
                    starts = len(hashes) - size + 1
                    if starts <= 0:
                        break
                    inside = inside[:starts] & follows[size - 2 : size - 2 + starts]
                    need = np.flatnonzero(inside & ok[:starts] & ok[1 : starts + 1])
                    keys = _keys([hashes[need + k] for k in range(size)])
                    hit = f.has(keys)
                    at, keys = need[hit], keys[hit]
                    ok = np.zeros(starts, bool)
                    ok[at] = True
                else:
                    keys = keys[at]
                if rest:
                    some = rest.has(keys)
                    keys, at = keys[some], at[some]
                if one_in > 1:
                    some = mix(keys ^ mix(at.astype(np.uint64) + np.uint64(batch.num_rows))) % np.uint64(one_in) == 0
                    keys, at = keys[some], at[some]
                keys, first = np.unique(keys, return_index=True)
                new = ~np.isin(keys, seen, assume_unique=True)
                keys, first = keys[new], at[first[new]]
                if len(keys):
                    found.append(keys)
                    names = places = None
                    if size == 1:
                        places = [langs[d] for d in doc[first].tolist()]
                        names = [
                            data[a:b].tobytes().decode().translate(_LOWER)
                            for a, b in zip(begins[first].tolist(), stops[first].tolist(), strict=True)
                        ]
                    yield _rows(keys, [hashes[first + k] for k in range(size)], places, names, None)
            seen = np.concatenate([seen, *found]) if len(seen) < s.held else np.concatenate([seen[:0], *found])
        if totals and not rest:
            yield _rows(np.zeros(len(totals), np.uint64), [], list(totals), None, list(totals.values()))

    rows = texts.mapInArrow(spell, SPELLED)
    return rows.groupBy("key", *WORDS, "lang", "word").agg(F.sum("n").alias("n"))


def _rows(keys: np.ndarray, parts: list[np.ndarray], langs: list | None, names: list | None, n: list | None) -> pa.RecordBatch:
    size = len(keys)
    none = pa.array(np.zeros(size, np.int64))
    columns = [pa.array(keys.view(np.int64)), *(pa.array(p.view(np.int64)) for p in parts)]
    columns += [none] * (len(WORDS) - len(parts))
    columns += [pa.array(x, pa.string()) if x is not None else pa.nulls(size, pa.string()) for x in (langs, names)]
    return pa.RecordBatch.from_arrays([*columns, none if n is None else pa.array(n, pa.int64())], ["key", *WORDS, "lang", "word", "n"])


def frequent_phrases(docs: DataFrame, settings: Settings, store: str) -> tuple[DataFrame, DataFrame]:
    """All words and phrases with their exact counts of at least `least`, as (h1, ..., h4, lang, word, n), lang and word of
    words only; and (lang, n), the number of all words of each language. `docs` has (doc_id, lang, text)."""
    s, spark = settings, docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), "doc_id")
    sample = texts.where(F.pmod(F.xxhash64("doc_id", F.lit(43)), F.lit(s.share)) == 0).select("lang", "text")
    texts = texts.select("lang", "text")
    proposed = written(_counted(sample, None, [], s, True).where(F.col("n") >= s.proposed), f"{store}/proposed")
    now, before, known = filter_of(proposed, s), [], None
    remove(spark, f"{store}/proposed")
    while True:
        turn = len(before)
        found = _counted(texts, now, before, s, turn == 0).where(F.col("n") >= s.least)
        found = written(found, f"{store}/pass-{turn}")
        known = found if known is None else known.unionAll(found)
        closed = not _missing(found, now)  # all that this pass found was proposed to it
        before = [*before, now]
        now = filter_of(known, s)
        if closed:
            break
    # A phrase has `least` occurrences or more, so few are not among one in `spelled`; another pass has those, if any.
    spelled = written(_spelled(texts, now, s, s.spelled), f"{store}/spelled")
    totals = spelled.where("key = 0 AND lang IS NOT NULL AND word IS NULL").select("lang", "n")
    rest = written(known.select("key").join(spelled.select("key"), "key", "left_anti"), f"{store}/rest")
    if not rest.isEmpty():
        spelled = spelled.unionAll(written(_spelled(texts, now, s, 1, filter_of(rest, s)), f"{store}/spelled-rest"))
    parts = spelled.where("h1 <> 0").groupBy("key").agg(F.min(F.struct(*WORDS, "lang", "word")).alias("x"))
    return parts.select("key", "x.*").join(known, "key").select(*WORDS, "lang", "word", "n"), totals


def _missing(phrases: DataFrame, now: Filter) -> bool:
    """Whether some phrase is not in the filter."""
    shared = phrases.sparkSession.sparkContext.broadcast(now)

    def outside(batches):
        f = shared.value
        for batch in batches:
            lost = int((~f.has(batch.column("key").to_numpy().view(np.uint64))).sum())
            if lost:
                yield pa.RecordBatch.from_arrays([pa.array([lost])], ["lost"])

    return not phrases.select("key").mapInArrow(outside, "lost bigint").isEmpty()


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two to `longest` words of each language.

    `docs` has (doc_id, lang, text, ...). NULL texts are empty, a NULL lang is `und`, a NULL doc_id only decides with the
    others which documents are sampled. Rows that repeat count as often as they are there. A text of any length is counted
    whole. Ties of score and count are ranked by the phrase's UTF-8 bytes. Other columns are not read. No rows, or no
    phrase that is frequent, give no rows.
    """
    s, spark = settings, docs.sparkSession
    store = work_dir(spark, "collocations")
    known, totals = frequent_phrases(docs, s, store)
    known = written(known, f"{store}/known")
    candidates = known.where("h2 <> 0").select(*WORDS, F.col("n").alias("a"))
    size = sum((F.col(h) != 0).cast("int") for h in WORDS)
    candidates = candidates.withColumn("size", size)

    def part(first: int, end: int):
        """The words first to end (exclusive), moved to the front."""
        columns = [F.col(WORDS[i]) if i < end else F.lit(0).cast("bigint") for i in range(first, first + len(WORDS))]
        return F.struct(*[c.alias(h) for c, h in zip(columns, WORDS, strict=True)])

    def listed(entries: list):
        return F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("x")

    # Each cut's parts, looked up: they are frequent, as the candidate is.
    cuts = [
        F.when(F.col("size") == n, F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), part(*ends).alias("p")))
        for n in range(2, s.longest + 1)
        for k in range(1, n)
        for side, ends in enumerate(((0, k), (k, n)))
    ]
    whole = [f"c{h}" for h in WORDS]
    parts = candidates.select(*[F.col(h).alias(c) for h, c in zip(WORDS, whole, strict=True)], "a", listed(cuts))
    parts = parts.select(*whole, "a", "x.k", "x.side", "x.p.*")
    counts = known.select(*WORDS, F.col("n").alias("f"))
    cut = parts.join(counts, WORDS).groupBy(*whole, "a", "k").agg(
        F.sum(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.sum(F.when(F.col("side") == 1, F.col("f"))).alias("r")
    )
    exact = F.expr(f"CAST((CAST(a AS DECIMAL(20,0)) * {s.scale}) div (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)")
    lowest = cut.withColumn("score", exact).groupBy(*whole, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    scored = written(lowest.select(*[F.col(f"c{h}").alias(h) for h in WORDS], "a", "x.score", "x.l", "x.r"), f"{store}/scored")

    # Candidates within a longer one that has most of their occurrences.
    inner = [
        F.when(F.col("size") == n, part(first, first + k))
        for n in range(3, s.longest + 1)
        for k in range(2, n)
        for first in range(n - k + 1)
    ]
    if inner:
        held = candidates.select("a", listed(inner)).select("x.*", F.col("a").alias("by"))
        longer = held.groupBy(*WORDS).agg(F.max("by").alias("by"))
        # In decimals, as 100 times a count may pass 64 bits.
        taken = F.expr(f"CAST(by AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * {s.percent}")
        scored = scored.join(longer, WORDS, "left").where(F.col("by").isNull() | ~taken)

    # The language, a word's spelling and the ranks. Languages are few, and a word table can be large: ordinary joins.
    spelling = known.where("h2 = 0").select(F.col("h1").alias("h"), "lang", "word")
    firsts = scored.join(spelling.select(F.col("h").alias("h1"), "lang"), "h1")
    # What can be in the result: scores and counts no less than the last one's; ties there are decided by the phrases.
    # First within parts of a language, so that no task gets more than a few lists of `top`.
    best = F.desc("score"), F.desc("a")
    for keys in (["lang", F.pmod("h1", F.lit(s.parts))], ["lang"]):
        place = F.rank().over(Window.partitionBy(*keys).orderBy(*best))
        firsts = firsts.withColumn("place", place).where(F.col("place") <= s.top).drop("place")
    likely = written(firsts, f"{store}/likely")
    for i, h in enumerate(WORDS):
        own = spelling.select(F.col("h").alias(h), F.col("word").alias(f"w{i}"))
        likely = likely.join(own, h, "left")
    phrase = F.concat_ws(" ", *[f"w{i}" for i in range(len(WORDS))])
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = likely.withColumn("phrase", phrase).withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= s.top)
    return ranked.join(bounded(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

