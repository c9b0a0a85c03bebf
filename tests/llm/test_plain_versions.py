"""Models and readers against plain versions of what they compute."""

import io
import math
import random
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from recordsieve.llm import decontaminate, ftrl, ngram_lm, toxicity, warc
from recordsieve.session import written

# --- language model ---


class KneserNey:
    """Interpolated modified Kneser-Ney bigrams over lists of words, each text ended by END and begun by START."""

    START, END = "<start>", "<end>"

    def __init__(self, texts):
        self.pairs, self.count = Counter(), Counter()
        for words in texts:
            whole = [self.START, *words, self.END]
            self.pairs.update(zip(whole[:-1], whole[1:], strict=True))
            self.count.update(whole[1:])
            self.count[self.START] += 1
        self.d = self.discounts(self.pairs.values())
        self.begins = defaultdict(Counter)
        for (u, _), c in self.pairs.items():
            self.begins[u][min(c, 3)] += 1
        self.kinds = Counter(w for _, w in self.pairs)
        self.low_d = self.discounts(self.kinds.values())
        self.total = sum(self.kinds.values())
        self.size = len(self.kinds)

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        found = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
        return [0, *(d if 0 < d < k else k / 2 for k, d in enumerate(found, 1))]

    def low(self, w):
        k = self.kinds[w]
        spare = sum(self.low_d[min(c, 3)] for c in self.kinds.values()) / self.total
        return max(k - self.low_d[min(k, 3)], 0) / self.total + spare / (self.size + 1)

    def p(self, u, w):
        if not self.count[u]:
            return self.low(w)
        c, n = self.pairs[u, w], self.count[u]
        taken = sum(self.d[k] * m for k, m in self.begins[u].items())
        return max(c - self.d[min(c, 3)], 0) / n + taken / n * self.low(w)

    def score(self, words):
        whole = [self.START, *words, self.END]
        return sum(math.log10(self.p(u, w)) for u, w in zip(whole[:-1], whole[1:], strict=True))


def test_language_model_against_a_plain_one(spark):
    dice = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    texts = [" ".join(dice.choices(vocabulary, weights, k=dice.randint(0, 40))) for _ in range(200)]
    train = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    plain = KneserNey([*(t.split() for t in texts), []])
    asked = [*texts[:50], "w1 new w2 new new w3", "new", "", " ".join(dice.choices(vocabulary, k=30))]
    table = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in ngram_lm.score(table, ngram_lm.train(train)).collect()}
    for i, text in enumerate(asked):
        assert got[i] == pytest.approx(plain.score(text.split()), rel=1e-9)
    for u in (plain.START, "w0", "w59"):
        assert sum(plain.p(u, w) for w in [*plain.kinds, "new"]) == pytest.approx(1)


# --- follow the regularised leader ---


def test_learner_against_a_plain_one():
    s = ftrl.Settings(bits=8, alpha=0.3, beta=1.0, l1=0.7, l2=0.2)
    dice = random.Random(4)
    learner, z, n = ftrl.Learner(s), defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    for _ in range(500):
        features, label = sorted(dice.sample(range(256), dice.randint(0, 20))), dice.randint(0, 1)
        learner.learn(np.array(features, np.uint32), label)
        own = [*features, 256]
        w = {i: weight(i) for i in own}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i in own:
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
    numbers, weights = learner.model()
    assert dict(zip(numbers.tolist(), weights, strict=True)) == pytest.approx({i: weight(i) for i in range(257) if weight(i)})


# --- archives ---


def archive(*records, lead=b""):
    return lead + b"".join(zstandard.ZstdCompressor().compress(r) for r in records)


def read(data, largest=1 << 20):
    return list(warc._rows(io.BytesIO(data).read, "a", False, largest))


def skippable(body, kind=0x184D2A5D):
    return struct.pack("<II", kind, len(body)) + body


GOOD = warc.record(5, "http://h/5", "<p>payload</p>", None, warc.Settings())


def test_good_records():
    again = warc.record(6, None, "<p>payload</p>", 5, warc.Settings())
    rows = read(archive(GOOD, again) + skippable(b"x" * 9, 0x184D2A51) + archive(GOOD))
    assert [(r["page_id"], r["record_type"], r["error"]) for r in rows] == [(5, "response", None), (6, "revisit", None), (5, "response", None)]


@pytest.mark.parametrize(
    "change, words",
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), "header"),
        (lambda r: r.replace(b"WARC-Date", b"WARC-Data"), "missing"),
        (lambda r: r.replace(b"WARC-Type:", b"WARC-Type"), "malformed header"),
        (lambda r: r[:-2], "Content-Length"),
        (lambda r: r + b"x", "Content-Length"),
        (lambda r: r.replace(b"payload</p>", b"PAYLOAD</p>"), "digest"),
        (lambda r: r.replace(b"HTTP/1.1", b"FTTP/1.1"), "digest|HTTP"),
        (lambda r: b"", "header"),
    ],
)
def test_damaged_records_are_told_and_the_next_one_is_read(change, words):
    rows = read(archive(change(GOOD), GOOD))
    assert any(w in rows[0]["error"] for w in words.split("|")) and rows[1]["error"] is None and len(rows) == 2


def test_damaged_frames():
    whole = archive(GOOD)
    for cut in (whole[:-3], whole[:6], skippable(b"x" * 50)[:20], whole + skippable(b"x" * 50, 0x184D2A51)[:30], whole + b"junk junk"):
        assert read(cut)[-1]["error"], cut
    assert "more than" in read(archive(b"\0" * 3_000_000))[0]["error"]


def test_dictionaries_are_bounded():
    bomb = zstandard.ZstdCompressor().compress(b"\0" * (warc.DICTIONARY_MOST + 1))
    assert len(bomb) < 10_000 and "unpacks" in read(skippable(bomb) + archive(GOOD))[0]["error"]
    claim = struct.pack("<II", 0x184D2A5D, 1 << 31) + b"x"
    assert "claims" in read(claim)[0]["error"]


def test_a_record_that_could_not_be_read_is_not_written():
    with pytest.raises(ValueError, match="more than a record"):
        warc.record(1, None, "x" * 10_000, None, warc.Settings(largest=8_000))


def test_all_labelled_rows_are_learned_from(spark):
    """Each feature is seen in one row only, so a row that is left out leaves its feature without a weight."""
    s = ftrl.Settings(bits=20, max_rows=7, passes=3, alpha=1.0, l1=0.0, l2=0.0)
    texts = [(k, f"{('good', 'bad')[k % 2]} w{k}") for k in range(40)]
    docs = spark.createDataFrame([*texts, (3, "aaa"), (41, None)], "id bigint, text string").repartition(3)
    rows = [(k, k % 2) for k, _ in texts]
    labels = spark.createDataFrame([*rows, (41, 1), (99, 1), (None, 1), (5, None)], "id bigint, label int")

    def learned():
        return ftrl.train(labels, docs, toxicity.features, s)

    numbers, weights = learned()
    w = dict(zip(numbers.tolist(), weights.tolist(), strict=True))
    hashes, _ = toxicity.features(pa.array([t.split()[1] for k, t in texts if k != 3]))
    own = [w.get(int(h >> np.uint64(64 - s.bits)), 0.0) for h in hashes]
    assert all((x > 0) == (k % 2 == 1) and x for x, k in zip(own, (k for k, _ in texts if k != 3), strict=True))
    again = learned()
    assert (again[0] == numbers).all() and (again[1] == weights).all()


# --- decontamination ---


def _shuffled_rows(df):
    """What the exchanges of a frame that has been collected have written."""
    plan, total = df._jdf.queryExecution().executedPlan().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "ShuffleQueryStage":
            total += node.shuffle().metrics().apply("shuffleRecordsWritten").value()
        todo += [node.plan()] if node.nodeName().endswith("QueryStage") else []
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_only_numbers_that_have_a_weight_are_shuffled(spark, tmp_path):
    rows = [(number, shard / 8 if number % 50 < shard else 0.0, 1.0 + shard) for number in range(1000) for shard in range(3)]
    models = written(spark.createDataFrame(rows, "number int, weight double, n double"), str(tmp_path / "models"))
    found = ftrl.averaged(models, str(tmp_path / "weighted"))
    plain = {k: sum(w * n for x, w, n in rows if x == k) / 6 for k in range(1000)}
    assert {r.number: r.weight for r in found.collect()} == {k: w for k, w in plain.items() if w}
    assert 0 < _shuffled_rows(found) <= 120  # of 3000: three shards' rows of the 40 numbers that have a weight


def test_the_space_does_not_depend_on_which_documents_are_there(spark):
    """Cosines change with document frequencies only, not with documents that happen to be drawn."""
    dice = random.Random(9)
    vocabulary = ["".join(dice.choices("abcdefghijklmnop", k=6)) for _ in range(800)]
    items = [(k, " ".join(dice.choices(vocabulary, k=40))) for k in range(6)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [" ".join([*dice.choices(vocabulary, k=90), *([items[k % 6][1]] if k < 6 else [])]) for k in range(60)]
    found = []
    for shift in (0, 777):  # the same texts under other ids
        docs = spark.createDataFrame([(k + shift, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
        rows = decontaminate.contaminated(docs, bench).collect()
        found.append(sorted((r.doc_id - shift, r.item_id, round(r.cosine, 4), r.lcs) for r in rows))
    assert found[0] == found[1] and {(k, k) for k in range(6)} <= {x[:2] for x in found[0]}


def test_paraphrases_and_answers(spark):
    dice = random.Random(6)
    vocabulary = ["".join(dice.choices("abcdefghijklmnop", k=6)) for _ in range(4000)]

    def text(n):
        return dice.choices(vocabulary, k=n)

    items = {k: text(40) for k in range(12)}
    docs, want = [(k, " ".join(text(200))) for k in range(300)], set()
    for k, item in items.items():
        host = 1000 + 10 * k
        kept = [w if dice.random() < 0.75 or i >= 30 else dice.choice(vocabulary) for i, w in enumerate(item)]
        no_answer = [w if i < 26 else dice.choice(vocabulary) for i, w in enumerate(item)]
        for add, middle, found in ((0, item, True), (1, kept, True), (2, no_answer, False), (3, item[:12], False)):
            docs.append((host + add, " ".join([*text(dice.randint(0, 90)), *middle, *text(60)])))
            if found:
                want.add((host + add, k))
    table = spark.createDataFrame([*docs, (None, " ".join(items[0])), (5000, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table, bench).collect()}
    assert (None, 0) in got
    got.discard((None, 0))
    assert got <= want and len(got) >= 0.9 * len(want)
    assert {(1000 + 10 * k, k) for k in items} <= got
