"""Rows without ids or with repeated ones, and the pipeline's stages against plain versions."""

import os
import random
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import samples  # noqa: E402

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from recordsieve.llm import fingerprints, spans, toxicity  # noqa: E402
from recordsieve.llm.rows import fresh, numbered  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentences(dice, n, words=9):
    return ". ".join(" ".join("".join(dice.choices("abcdefgh", k=6)) for _ in range(words)) for _ in range(n)) + "."


# --- identity by row ---


@pytest.mark.parametrize("ids", [(None, None), (7, 7), (1, None), (None, 3)])
def test_spans_of_rows_without_or_with_equal_ids(spark, ids):
    dice = random.Random(1)
    p, x, y = (sentences(dice, 4) for _ in range(3))
    rows = [(ids[0], f"{p} {x}"), (ids[1], f"{y} {p}")]
    got = spans.span_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    texts = Counter(r.text.strip() for r in got)
    # The passage goes from one of them; what occurs once stays.
    assert texts in (Counter([f"{p} {x}", y]), Counter([x, f"{y} {p}"]))


def test_spans_of_equal_rows(spark):
    dice = random.Random(2)
    a, b = sentences(dice, 6), sentences(dice, 6)
    got = spans.span_dedup(spark.createDataFrame([(1, a), (1, a), (2, f"{b} {a}")], "doc_id bigint, text string")).collect()
    assert Counter(r.text.strip() for r in got) == Counter([a, "", b])


@pytest.mark.parametrize("ids", [[None] * 5, [4] * 5, [None, 2, 2, None, 9], [1, 2, 3, 4, 5]])
def test_fingerprints_keep_every_row(spark, ids):
    texts = [f"text {k} " + "abc " * k for k in range(5)]
    table = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id bigint, text string").coalesce(1)
    got = fingerprints.edited_fingerprints(table).collect()
    order = sorted(range(5), key=lambda k: (ids[k] is None, -(ids[k] or 0), k))
    want = Counter()
    for a, b in zip(order, order[1:] + order[:1], strict=True):
        k = len(texts[a]) // 3
        want[ids[a], samples.sha256(texts[a][: len(texts[a]) - k] + texts[b][:k])] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_row_numbers(spark, tmp_path):
    table = spark.range(1000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text", "1 AS row", "2 AS file_path")
    table.repartition(7).write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    name = fresh("row", read.columns)
    for df in (read, read.where("doc_id % 3 = 0"), table, read.unionAll(read)):
        found = numbered(df, name)
        assert found.columns == [*df.columns, "row_2"]
        once, again = ({r.row_2: r.doc_id for r in found.select(name, "doc_id").collect()} for _ in range(2))
        assert once == again and len(once) == df.count()


def test_classifiers_without_labels(spark):
    table = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "id bigint, label int")
    got = toxicity.toxicity(table, none, texts=table.selectExpr("doc_id AS id", "text")).collect()
    assert len(got) == 2 and all(r.score == 0.5 for r in got)


# --- the pipeline ---


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Tables with toxic documents, copies, benchmark passages and secrets; some ids are missing, some repeat."""
    dice = random.Random(5)
    vocabulary = ["".join(dice.choices("bcdfghjklmn", k=5)) for _ in range(3000)]

    def text(n):
        return " ".join(dice.choices(vocabulary, k=n))

    items = [text(30) for _ in range(5)]
    rows = [(i, f"{text(50)} you vile rotten fool fool {text(20)}" if i % 5 == 0 else text(70), i % 5 == 0) for i in range(600)]
    extra = [
        (None, text(60)), (None, text(60)), (10_000, text(60)), (10_000, text(60)),  # no copies of each other
        (None, None), (10_001, ""),
        *((10_010 + k, f"{text(30)} {item} {text(30)}") for k, item in enumerate(items)),
        (10_020, f"{text(30)} password = hunter2hunter2x {text(30)}"),
    ]
    base = text(100)
    extra += [(10_030, base), (10_031, base), (None, base), (10_032, " ".join([*base.split()[:-1], "other"]))]
    whole = [(i, t) for i, t, _ in rows] + extra
    docs = [(i, t, "en", f"src{k % 3}" if k % 7 else None, len(t or "")) for k, (i, t) in enumerate(whole)]
    root = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, int(bad)) for i, _, bad in rows if i < 500]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, whole, {i for i, _, bad in rows if bad}


def test_stages(spark, corpus, tmp_path):
    root, whole, bad = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    columns, before = docs.columns, Counter((r.doc_id, r.text) for r in docs.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secret_scan", "mixing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, root).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        kept[name] = Counter((r.doc_id, r.text) for r in rows)
        assert docs.columns[: len(columns)] == columns and (name == "mixing") == (len(docs.columns) > len(columns))
    # Toxic documents go, all others stay, whatever their ids are.
    assert kept["toxicity"] == Counter({k: n for k, n in before.items() if k[0] not in bad})
    # One document of each group of near copies, the one with the smallest id.
    texts = dict(enumerate(kept["toxicity"].elements()))
    groups = samples.near_components({k: t for k, (_, t) in texts.items()}, 5, 80)
    best = {}
    for k, (_, group) in groups.items():
        order = (texts[k][0] is None, texts[k][0] or 0)
        best[group] = min(best.get(group, (order, k)), (order, k))
    assert kept["near_dedup"] == Counter(texts[k] for _, k in best.values())
    assert sum(kept["toxicity"].values()) - sum(kept["near_dedup"].values()) == 3
    held = {10_010 + k for k in range(5)}
    assert kept["decontamination"] == Counter({k: n for k, n in kept["near_dedup"].items() if k[0] not in held})
    changed = kept["secret_scan"] - kept["decontamination"]
    assert {i for i, _ in changed} >= {10_020} and "hunter2" not in str(changed)
    assert sum(kept["secret_scan"].values()) == sum(kept["decontamination"].values())
    assert all(r.n_chars == len(r.text or "") for r in spark.read.parquet(str(tmp_path / "secret_scan")).collect())
    # The mix holds whole documents, each twice at most, in order of time, near its budget.
    mix = spark.read.parquet(str(tmp_path / "mixing"))
    sizes = {k: len(samples.WORD.findall(k[1] or "")) for k in kept["secret_scan"]}
    words = sum(sizes[r.doc_id, r.text] for r in mix.collect())
    budget = 1.5 * sum(n * sizes[k] for k, n in kept["secret_scan"].items())
    assert budget - 200 <= words <= budget
    assert all(n <= 2 * kept["secret_scan"][k] for k, n in kept["mixing"].items())


def test_run(spark, corpus):
    root, whole, bad = corpus
    rows = corpus_pipeline.run(spark, root).collect()
    assert rows and not {r.doc_id for r in rows} & bad and [*DOCS.split()[::2]] == list(rows[0].asDict())[:5]
