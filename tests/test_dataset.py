"""Whole runs over a tree of compressed files."""

import json

import pytest

from helpers import lists, pack, sorted_rows
from recordsieve.__main__ import main
from recordsieve.plans import dataset
from recordsieve.plans.dataset import run_dataset
from recordsieve.sources.files import read_csv
from recordsieve.specs import SPECS
from recordsieve.streaming.incremental import stream_dataset


def line(i, subreddit="Robotics", **more):
    return json.dumps({"id": str(i), "subreddit": subreddit, "author": "Ann", **more}) + "\n"


def kept_ids(spark, output):
    tables = (read_csv(spark, f"{output}/{kind}/csv") for kind in SPECS)
    return sorted(r.id for table in tables for r in table.select("id").collect())


def results(spark, output):
    totals = spark.read.parquet(f"{output}/stats/totals")
    manifest = spark.read.parquet(f"{output}/manifest")
    return (
        kept_ids(spark, output),
        sorted_rows(totals.selectExpr("kind", "CAST(base_name AS STRING)", "n_read", "n_written")),
        sorted_rows(manifest.selectExpr("kind", "CAST(base_name AS STRING)")),
    )


@pytest.fixture
def tree(tmp_path):
    pack(tmp_path / "in/comments/RC_1.zst", line(1) + line(2, "other") + "junk\n")
    pack(tmp_path / "in/submissions/RS_1.zst", line(3) + line(4, over_18=True))
    pack(tmp_path / "in/comments/RC_cut.zst", line(5), finish=False)
    return tmp_path


def test_run_rerun_and_new_files(spark, tree):
    root, out = str(tree / "in"), str(tree / "out")
    assert len(run_dataset(spark, root, out, *lists(spark))) == 2
    first = results(spark, out)
    assert first == (
        ["1", "3"],
        [("comments", "RC_1", 3, 1), ("submissions", "RS_1", 2, 1)],
        [("comments", "RC_1"), ("submissions", "RS_1")],
    )
    errors = spark.read.parquet(f"{out}/errors").collect()
    assert [(e.base_name, e.error.split(":")[0]) for e in errors] == [("RC_cut", "EOFError")]

    # Only the failed file is left; it fails again and changes nothing.
    run_dataset(spark, root, out, *lists(spark))
    assert results(spark, out) == first

    # A repaired and a new file are picked up, in rounds of bounded size.
    (tree / "in/comments/RC_cut.zst").write_bytes(b"")
    pack(tree / "in/comments/RC_cut.zst", line(5))
    pack(tree / "in/comments/RC_2.zst", line(6))
    assert len(run_dataset(spark, root, out, *lists(spark), max_batch_bytes=1)) == 2
    ids, _, done = results(spark, out)
    assert ids == ["1", "3", "5", "6"] and len(done) == 4


def test_crash_before_the_manifest(spark, tree, monkeypatch):
    root, out = str(tree / "in"), str(tree / "out")
    write = dataset.write_parquet

    def crash(df, path, *args, **options):
        if path.endswith("manifest"):
            raise RuntimeError("lost")
        write(df, path, *args, **options)

    monkeypatch.setattr(dataset, "write_parquet", crash)
    with pytest.raises(RuntimeError):
        run_dataset(spark, root, out, *lists(spark))
    monkeypatch.undo()
    run_dataset(spark, root, out, *lists(spark))
    ids, totals, _ = results(spark, out)
    assert ids == ["1", "3"] and [t[2:] for t in totals] == [(3, 1), (2, 1)]


def test_streaming_agrees(spark, tree):
    root, out, progress = (str(tree / n) for n in ("in", "out", "progress"))
    (tree / "in/comments/RC_cut.zst").write_bytes(b"")
    pack(tree / "in/comments/RC_cut.zst", line(5))
    stream_dataset(spark, root, out, progress, *lists(spark))
    pack(tree / "in/comments/RC_2.zst", line(6))
    for _ in range(2):
        stream_dataset(spark, root, out, progress, *lists(spark))
    assert kept_ids(spark, out) == ["1", "3", "5", "6"]
    totals = spark.read.parquet(f"{out}/stats/totals")
    assert totals.count() == 4 and totals.agg({"n_read": "sum"}).first()[0] == 7


def test_odd_file_names(spark, tmp_path):
    name = "RC 1+a%20=b"
    pack(tmp_path / f"in/comments/{name}.zst", line(1))
    run_dataset(spark, str(tmp_path / "in"), str(tmp_path / "out"), *lists(spark))
    stream_dataset(spark, str(tmp_path / "in"), str(tmp_path / "live"), str(tmp_path / "p"), *lists(spark))
    for out in ("out", "live"):
        totals = spark.read.parquet(str(tmp_path / out / "stats/totals"))
        assert [(r.base_name, r.n_written) for r in totals.collect()] == [(name, 1)]
        assert read_csv(spark, str(tmp_path / out / "comments/csv")).count() == 1


def test_given_files_as_a_job(spark, tree, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    (tree / "topics.txt").write_text("ROBOTICS\n")
    (tree / "bots.txt").write_text("\n")
    out = str(tree / "out")
    lists = [str(tree / "topics.txt"), str(tree / "bots.txt")]
    for _ in range(2):
        main(["files", "comments", out, *lists, str(tree / "in/comments/RC_1.zst")])
    got = read_csv(spark, f"{out}/comments/csv")
    assert [r.id for r in got.collect()] == ["1"]
    main(["duplicates", f"{out}/comments/csv", str(tree / "found"), "--id-column", "id"])
    assert not (tree / "found").exists()
