"""Token files, ranked search and collocations against plain versions."""

import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import samples  # noqa: E402

from recordsieve.llm import collocations, fp_search, token_orc  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd_rows():
    """The samples, a repeated row, rows without an id, and a repeated id with another text."""
    rows = samples.rows()
    extra = [(None, None, None, 1, "lost and found, lost and found", "u", 1, 2, 3), (None, "web", "en", 1, None, "u", 1, 2, 3)]
    return [*rows, rows[20], (rows[20][0], "web", "de", 1, "another text of the same id", "u", 1, 2, 3), *extra]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, samples.SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], samples.SCHEMA)


# --- token files ---


@pytest.fixture(scope="module")
def store(odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "store")
    return token_orc.write_tokens(odd, path, token_orc.Settings(PATH, by_piece=True, stripe_bytes=1 << 16, stride=1_000))


def encoded_rows(odd_rows):
    library = Tokenizer.from_file(PATH)
    out = [(r[0], [*library.encode(r[4] or "", add_special_tokens=False).ids, 2]) for r in odd_rows]
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0))


def test_tokens_read_back(spark, store, odd_rows):
    got = token_orc.digests(token_orc.read_tokens(spark, store)).collect()
    want = encoded_rows(odd_rows)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), crc(x)) for i, x in want)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in want]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


def test_tokens_by_range_and_id(spark, store, odd_rows):
    rows = sorted(token_orc.read_tokens(spark, store).collect(), key=lambda r: r.start)
    flat = [i for r in rows for i in r.ids]
    for begin, end in ((0, 10), (5_000, 33_000), (len(flat) - 3, len(flat) + 50), (len(flat), len(flat) + 1)):
        parts = sorted(token_orc.read_range(spark, store, begin, end).collect(), key=lambda r: r.start)
        assert [i for r in parts for i in r.ids] == flat[begin:end]
        assert not parts or parts[0].start == begin
    some = token_orc.read_tokens(spark, store, [samples.rows()[20][0], 12, -5])
    assert len(some.collect()) == 4
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan and "Format: ORC" in plan


def test_token_files_have_stripes_indexes_and_bloom_filters(spark, store):
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    found = Counter()
    for name in os.listdir(f"{store}/documents"):
        if name.endswith(".orc"):
            path = jvm.org.apache.hadoop.fs.Path(f"{store}/documents/{name}")
            reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(conf))
            rows = reader.rows()
            for stripe in reader.getStripes():
                for stream in rows.readStripeFooter(stripe).getStreamsList():
                    found[stream.getKind().toString(), stream.getColumn()] += 1
                found["stripes"] += 1
            rows.close()
    assert found["stripes"] >= 1 and found["BLOOM_FILTER_UTF8", 1] == found["stripes"]
    assert found["ROW_INDEX", 1] == found["stripes"] and ("BLOOM_FILTER_UTF8", 2) not in found


def test_pieces_and_whole_texts_encode_alike():
    dice = random.Random(8)
    mixed = ["".join(dice.choices("aB'1|<>.,_-=\u0301\u0338é ßΣ½²\x1c\x7f٣", k=dice.randint(1, 40))) for _ in range(3000)]
    texts = [*samples.texts(), *mixed, "it's 'S  <|endoftext|>a<|startoftext|>", "ΑΣ ΑΣΑ x\x85y\x1cz", "é ́x ᄀ ᅡ", "  a b"]
    column = pa.array(texts)
    one, two = (token_orc.encoded(column, token_orc.Settings(PATH, by_piece=b)) for b in (False, True))
    assert (one[0] == two[0]).all() and (one[1] == two[1]).all()
    few = token_orc.Pieces(PATH, most=10)  # forgets all the time
    assert (few.encode(column)[0] == one[0][np.delete(np.arange(len(one[0])), np.cumsum(one[1]) - 1)]).all()


def test_pieces_that_share_a_place_and_are_encoded_together(monkeypatch):
    """Any size of the table gives the same ids, and new pieces go to the tokenizer many at a time."""
    dice = random.Random(5)
    words = ["".join(dice.choices("abcdeéßж", k=dice.randint(1, 9))) for _ in range(3000)]
    texts = [" ".join(dice.choices([*words, "İx", "'s", "7", "--", "ǰq"], k=40)) for _ in range(200)]
    column = pa.array([*texts, *texts])
    want, sizes = token_orc._encode(PATH, [*texts, *texts])
    given = []
    encode = token_orc._encode
    monkeypatch.setattr(token_orc, "_encode", lambda path, texts: given.append(len(texts)) or encode(path, texts))
    for bits in (2, 20):
        memory = token_orc.Pieces(PATH, bits=bits)
        for _ in range(2):
            got = memory.encode(column)
            assert (got[0] == want).all() and (got[1] == sizes).all()
    assert sum(given) < 2000


def test_tokens_of_no_rows(spark, empty, tmp_path):
    assert token_orc.token_store(empty, str(tmp_path / "none"), token_orc.Settings(PATH)).count() == 0
    assert token_orc.read_range(spark, str(tmp_path / "none"), 0, 9).count() == 0


# --- ranked search ---

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(samples.lower(text))


def ranked(docs, items, top):
    """[(item_id, rank, doc_id, score)], scores first to last; ids of equal scores in order, NULL last."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        own = set(terms(text))
        weights = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in own}
        scores = []
        for i, c, n in held:
            m = 50 + (50 * n * total) // length
            score = sum(w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t, w in weights.items() if c[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, k, None if no else i, -s) for k, (s, no, i) in enumerate(sorted(scores)[:top], 1)]
    return out


ITEMS = [(1, "link3 step3 changed5 one"), (2, None), (3, "..."), (4, "Another text, of the SAME id; lost"), (1, "ä äb lost"), (None, "one two")]


@pytest.mark.parametrize("settings", [{}, {"documents": 37, "leaf": 2, "depth": 3}, {"entries": 50, "leaf": 4, "items": 2}])
def test_ranked_search(spark, odd, odd_rows, settings):
    dice = random.Random(5)
    words = [w for r in odd_rows if r[4] for w in r[4].split()[:200]]
    items = [*ITEMS, *((100 + k, " ".join(dice.choices(words, k=dice.randint(1, 60)))) for k in range(40))]
    table = spark.createDataFrame([(*i, 7, 8) for i in items], "item_id bigint, text string, rank int, doc_id int")
    for top in (3, 50):
        got = fp_search.search(odd, table, fp_search.Settings(top=top, **settings)).collect()
        assert Counter(map(tuple, got)) == Counter(ranked([(r[0], r[4]) for r in odd_rows], items, top))


def test_search_leaves_subtrees_out(monkeypatch):
    """Of many documents with one common term, few have the rare one: the rest is not scored."""
    dice = np.random.default_rng(1)
    n = 4000
    rare = dice.random(n) < 0.01
    sizes = 1 + rare.astype(int)
    flat = np.concatenate([[0, 1] if r else [0] for r in rare])
    tree = fp_search.Tree(np.arange(n), np.full(n, 100), sizes, flat, np.ones(len(flat), np.int64), fp_search.Settings(leaf=32))
    seen = []
    plain = fp_search.Tree.sums
    monkeypatch.setattr(fp_search.Tree, "sums", lambda self, k, t, width, m, a, b, *x: seen.append(b - a) or plain(self, k, t, width, m, a, b, *x))
    best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    scores, ids = tree.search(np.array([0, 1]), np.array([1, 1000]), best, 10)
    assert ids.tolist() == np.flatnonzero(rare)[:10].tolist() and sum(seen) < n / 10


def test_search_of_nothing(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert fp_search.search(empty, items).count() == 0
    assert fp_search.search(odd, items.where("false")).count() == 0
    assert fp_search.search(odd, items.where("item_id = 2")).count() == 0


# --- collocations ---


def mined(rows, s):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text), all phrases counted."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", samples.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, s.longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= s.least}
        for p, a in candidates.items():
            if any(
                len(q) > len(p) and 100 * b >= s.percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            ):
                continue
            cuts = [((s.scale * a) // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: s.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return out


def phrase_rows():
    dice = random.Random(9)
    words = ["New", "york", "times", "é", "a", "b", "C", "d"]
    rows = [(None, "x"), ("en", None), ("en", ""), ("de", " \t.,;\n"), ("und", "new york new york"), ("en", "new york times. " * 40)]
    rows += [("en" if k % 3 else None, " ".join(dice.choices(words, k=dice.randint(1, 30))) + dice.choice(". ! \n ,")) for k in range(150)]
    rows += [("de", "eins zwei\tdrei vier fünf; sechs eins zwei" + " x" * k) for k in range(12)] * 2
    return rows + [("en", " ".join(dice.choices(words, k=20_000)))]


@pytest.mark.parametrize(
    "options",
    [
        {"least": 6},
        {"least": 6, "share": 10**9},  # no sample: everything is found at the border
        {"least": 20, "share": 2, "proposed": 3, "top": 7, "slice_bytes": 200},
        {"least": 6, "share": 1, "proposed": 1, "longest": 3, "held": 50, "slice_bytes": 500},
        {"least": 6, "most_bits": 1 << 16, "share": 30, "spelled": 1000},
    ],
)
def test_collocations(spark, options):
    rows = phrase_rows()
    table = spark.createDataFrame([(k, *r, 1, "n") for k, r in enumerate(rows)], "doc_id long, lang string, text string, n int, phrase string")
    s = collocations.Settings(**options)
    got = collocations.collocations(table.repartition(3), s).collect()
    want = mined(rows, s)
    assert Counter(map(tuple, got)) == Counter(want) and len(want) > 10


def test_collocations_of_nothing(empty, spark):
    assert collocations.collocations(empty).count() == 0
    few = spark.createDataFrame([(None, None, "a b a b"), (1, "en", None)], "doc_id long, lang string, text string")
    assert collocations.collocations(few).count() == 0


def test_a_filter_has_what_was_put_in(spark):
    dice = np.random.default_rng(3)
    keys = dice.integers(0, 1 << 64, 5_000, dtype=np.uint64)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    f = collocations.filter_of(table, collocations.Settings())
    assert f.has(keys).all() and f.has(dice.integers(0, 1 << 64, 20_000, dtype=np.uint64)).mean() < 0.05
