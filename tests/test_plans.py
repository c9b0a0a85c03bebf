"""The plans stay the ones meant for big data."""

import re

import pytest

from helpers import lines_df, lists, optimized_plan, physical_plan, sorted_rows
from recordsieve.catalog.queries import REGISTRY
from recordsieve.operators import membership
from recordsieve.operators.audit import staged_audit
from recordsieve.operators.cascade import judge
from recordsieve.operators.duplicates import drop_duplicates, possible_repeats
from recordsieve.operators.key_index import drop_seen, open_index, unseen_rows
from recordsieve.operators.membership import flag_members, word_list
from recordsieve.operators.project import rejected_values, staged
from recordsieve.plans.clean import clean
from recordsieve.session import written
from recordsieve.specs import COMMENTS

SF = "/root/testdata/sf0.001"
LINE = '{"subreddit":"robotics","author":"Ann"}'


def test_no_python_and_no_shuffle_for_kept_rows(spark):
    df = clean(lines_df(spark, [LINE]), COMMENTS, *lists(spark)).kept
    plan = physical_plan(df)
    assert not re.search("Python|Exchange hash|Exchange Round|SortMergeJoin", plan)
    assert plan.count("BroadcastHashJoin") == 2


def test_lines_are_parsed_once_for_keys_and_once_in_full(spark):
    plan = optimized_plan(clean(lines_df(spark, [LINE]), COMMENTS, *lists(spark)).kept)
    generates = [row for row in plan.splitlines() if "Generate" in row]
    assert len(generates) == 2
    # The look at quoted values reads one field in a lazy CASE arm, nothing else does.
    others = [row for row in plan.splitlines() if "from_json" in row and "Generate" not in row]
    assert all("(id,StringType" not in row for row in others)


def test_statistics_take_one_shuffle(spark):
    plan = physical_plan(clean(lines_df(spark, [LINE]), COMMENTS, *lists(spark)).cells)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


@pytest.mark.parametrize("name, join", [("topic_semi", "LeftSemi"), ("author_anti", "LeftAnti")])
def test_list_joins_are_broadcast(spark, name, join):
    plan = physical_plan(REGISTRY[name](spark, SF))
    assert re.search(f"BroadcastHashJoin .*{join}", plan)


def test_scans_are_pruned(spark):
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in physical_plan(REGISTRY["topic_semi"](spark, SF))
    assert "ReadSchema: struct<text:string>" in physical_plan(REGISTRY["dup_summary"](spark, SF))


def test_copies_are_combined_before_the_shuffle(spark):
    plan = physical_plan(REGISTRY["dedup_keep_first"](spark, SF))
    assert "partial_min_by" in plan and "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_list_beyond_the_bound_is_not_broadcast_by_us(spark, monkeypatch):
    monkeypatch.setattr(membership, "fits_broadcast", lambda words: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
        flagged = flag_members(df, "k", word_list(spark, ["A"]), "hit")
        assert "BroadcastHashJoin" not in physical_plan(flagged)
        assert sorted_rows(flagged) == [("a", True), ("a", True), ("b", False), (None, False)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bound_is_measured(spark):
    words = word_list(spark, ["aa", "bb", "cc"])
    assert membership.fits_broadcast(words)
    assert not membership.fits_broadcast(words, max_items=2)
    assert not membership.fits_broadcast(words, max_bytes=20)


def test_judged_rows_are_lean(spark):
    judged = judge(lines_df(spark, [LINE, "{", '{"subreddit":"x"}']), COMMENTS, *lists(spark))
    assert judged.columns == ["i", "subreddit", "reason", "record"]
    assert [r.record is None for r in judged.orderBy("i").collect()] == [False, True, True]


def test_generated_methods_are_small_enough_to_compile(spark, tmp_path, capsys):
    """The JIT leaves methods beyond 8,000 bytes interpreted. Of a run: judging, coercion, audit and output."""
    judged = judge(lines_df(spark, [LINE]), COMMENTS, *lists(spark), stripped=True)
    rows = written(staged(judged, COMMENTS), str(tmp_path / "staged"))
    for df in (staged(judged, COMMENTS), staged_audit(rows, COMMENTS), rows.select("out.*"), rejected_values(rows)):
        df.write.format("noop").mode("overwrite").save()
        df.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert all(n < 8_000 for n in sizes)


def test_generators_are_not_given_the_work(spark):
    """What a generator gets is interpreted: of a run, the coercions and the parse for keys are projections below one."""
    judged = judge(lines_df(spark, [LINE]), COMMENTS, *lists(spark), stripped=True)
    generates = [row for row in optimized_plan(staged(judged, COMMENTS)).splitlines() if "Generate" in row]
    assert len(generates) == 3
    assert not [row for row in generates if "struct(" in row or "xxhash64" in row]
    assert len([row for row in generates if "from_json" in row]) == 1  # of the lines that pass the lists


def test_rows_of_single_keys_do_not_move(spark):
    """Only possible repeats are aggregated; what is broadcast to find them has a bound."""
    df = spark.createDataFrame([(i, f"k{i % 50 if i < 100 else i}") for i in range(300)], "i int, key string")
    marked, mark = possible_repeats(df, "key")
    assert marked.where(mark).count() == 100 and df.columns == marked.columns[:-1]
    plan = physical_plan(drop_duplicates(df, "key", ["i"]))
    assert "Union" in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 2
    # With fewer slots than keys nothing is lost, only more moves.
    crowded, mark = possible_repeats(df, "key", slots=64)
    assert crowded.where(mark).count() >= 100 and crowded.count() == 300


def test_a_key_index_is_not_shuffled(spark, tmp_path):
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(20)], "i int, key string")
    first = drop_seen(df, "key", str(tmp_path / "index"), "one", ["i"], buckets=8)
    assert sorted_rows(first) == [(i, f"k{i}") for i in range(7)]
    name, buckets = open_index(spark, str(tmp_path / "index"), buckets=99)
    assert buckets == 8 and spark.table(name).count() == 7
    plan = physical_plan(unseen_rows(df, "key", spark.table(name), ["i"], "two"))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # The only exchange is that of the delivery.
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" not in plan
    more = spark.createDataFrame([(1, "k1"), (2, "new"), (3, None), (4, None)], "i int, key string")
    for _ in range(2):  # a delivery may be given again
        assert sorted_rows(drop_seen(more, "key", str(tmp_path / "index"), "two", ["i"])) == [(2, "new"), (3, None)]
    assert spark.table(name).count() == 9
