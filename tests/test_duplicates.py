"""Duplicates against brute force, including the way round the broadcast."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from helpers import physical_plan, sorted_rows
from recordsieve.operators.duplicates import (
    drop_duplicates, duplicate_rows, duplicate_summary, key_counts, rows_with_keys,
)
from recordsieve.plans.duplicate_check import check_duplicates
from recordsieve.sinks.tables import write_csv
from recordsieve.sources.files import read_csv

SAMPLES = {
    "letters": ["a", "b", "a", "c", "b", "b"],
    "nulls": ["a", None, None],
    "none": ["a", "b", None],
    # One key holds a third of the rows.
    "hot": ["hot"] * 400 + [f"k{random.Random(i).randrange(500)}" for i in range(800)] + [None] * 3,
}
WANT = {"letters": (6, 5, 2), "nulls": (3, 2, 0), "none": (3, 0, 0)}


def table(spark, keys):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string")


def brute(keys):
    n = collections.Counter(keys)
    return [(i, k) for i, k in enumerate(keys) if n[k] > 1]


@pytest.mark.parametrize("long_keys", [False, True])
@pytest.mark.parametrize("name", SAMPLES)
def test_reports(spark, name, long_keys):
    keys = SAMPLES[name]
    df = table(spark, keys)
    repeated = brute(keys)
    want = (len(keys), len(repeated), len({k for _, k in repeated if k is not None}))
    assert tuple(duplicate_summary(df, "k", long_keys).first()) == want == WANT.get(name, want)
    assert sorted_rows(duplicate_rows(df, "k", long_keys)) == sorted(repeated, key=repr)


@pytest.mark.parametrize("name", SAMPLES)
def test_without_broadcast_of_all_keys(spark, name, monkeypatch):
    monkeypatch.setattr("recordsieve.operators.duplicates.MAX_HOT_KEYS", 3)
    keys = SAMPLES[name]
    df = table(spark, keys)
    repeated = key_counts(df, "k").where("n > 1")
    if repeated.isEmpty():
        return
    got = rows_with_keys(df, repeated, F.col("k"), small=False)
    assert sorted_rows(got) == sorted(brute(keys), key=repr)


@pytest.mark.parametrize("name", SAMPLES)
def test_keep_first(spark, name):
    keys = SAMPLES[name]
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    got = drop_duplicates(table(spark, keys).repartition(8), "k", ["i"], long_keys=True)
    assert sorted_rows(got) == sorted(((i, k) for k, i in first.items()), key=repr)


def test_full_rows_are_not_shuffled(spark):
    plan = physical_plan(duplicate_rows(table(spark, SAMPLES["hot"]), "k"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_check_csv(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "found")
    df = spark.createDataFrame([("1e5", "x"), ("100000", "y"), ("NA", "z"), ("NA", "w\nw")], "id string, v string")
    write_csv(df, source, by=())
    assert tuple(check_duplicates(spark, source, out).first()) == (4, 2, 1)
    assert sorted_rows(read_csv(spark, out)) == [("NA", "w\nw"), ("NA", "z")]


def test_check_csv_without_duplicates_writes_nothing(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "found"
    write_csv(table(spark, ["a", "b"]).withColumnRenamed("k", "id"), str(source), by=())
    assert tuple(check_duplicates(spark, str(source), str(out)).first()) == (2, 0, 0)
    assert not out.exists()
