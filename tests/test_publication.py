"""Versions, the ledger that runs and streams share, files without lines, values that could not be converted."""

import json

import pytest

from helpers import lists, pack, sorted_rows
from recordsieve.operators.membership import word_list
from recordsieve.plans import ledger
from recordsieve.plans.dataset import pending_files, process_files, run_dataset, spread_lines
from recordsieve.plans.ledger import live
from recordsieve.session import subfolders
from recordsieve.sources.files import list_files, read_csv
from recordsieve.sources.zst import read_zst
from recordsieve.streaming.incremental import stream_dataset


def line(i, subreddit="Robotics", **more):
    return json.dumps({"id": str(i), "subreddit": subreddit, "author": "Ann", **more}) + "\n"


def totals(spark, out):
    return sorted_rows(live(spark, out, "stats/totals").select("base_name", "n_read", "n_written"))


def ids(spark, out, kind="comments"):
    direct = spark.read.schema("id string").parquet(f"{out}/{kind}/parquet")
    csv = read_csv(spark, f"{out}/{kind}/csv")
    found = sorted(r.id for r in live(spark, out, f"{kind}/parquet").collect())
    # Versions that have been replaced are gone, so plain readers see the same.
    assert found == sorted(r.id for r in direct.collect()) == sorted(r.id for r in csv.select("id").collect())
    return found


def test_cleaning_again_replaces_everything(spark, tmp_path):
    out = str(tmp_path / "out")
    files = [pack(tmp_path / f"in/comments/{n}.zst", text)[0] for n, text in (("007", line(1, score="x") + line(2)), ("b", line(3)))]
    pack(tmp_path / "in/comments/EMPTY.zst", "")
    run_dataset(spark, str(tmp_path / "in"), out, *lists(spark))
    assert totals(spark, out) == [("007", 2, 2), ("EMPTY", 0, 0), ("b", 1, 1)] and ids(spark, out) == ["1", "2", "3"]
    reasons = live(spark, out, "stats/by_reason").where("base_name = 'EMPTY'")
    assert reasons.count() == 8 and reasons.agg({"n": "sum"}).first()[0] == 0
    report = spark.read.text(f"{out}/stats/report").where("base_name = 'EMPTY'")
    assert "Total lines read: 0" in [r.value for r in report.collect()]
    # Under another list nothing of the first file is kept.
    process_files(spark, "comments", files[:1], out, word_list(spark, ["none"]), lists(spark)[1])
    assert totals(spark, out) == [("007", 2, 0), ("EMPTY", 0, 0), ("b", 1, 1)] and ids(spark, out) == ["3"]
    assert live(spark, out, "stats/null_audit").select("base_name").distinct().count() == 1
    assert live(spark, out, "rejected").count() == 0 == spark.read.text(f"{out}/rejected").count()
    assert pending_files(spark, str(tmp_path / "in"), out).count() == 0


def test_files_of_one_name(spark, tmp_path):
    out = str(tmp_path / "out")
    files = [pack(tmp_path / f"{d}/RC_9.zst", line(i))[0] for i, d in enumerate(("x", "y"))]
    for paths in (files, files[:1]):
        process_files(spark, "comments", paths, out, *lists(spark))
        assert ids(spark, out) == ["0", "1"] and totals(spark, out) == [("RC_9", 1, 1)] * 2


def test_a_run_that_broke_off_is_swept(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    pack(tmp_path / "in/comments/a.zst", line(1))
    with monkeypatch.context() as m:
        m.setattr("recordsieve.plans.dataset.write_csv", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_dataset(spark, root, out, *lists(spark))
    assert subfolders(spark, f"{out}/comments/parquet") and ledger.live_files(spark, out).count() == 0
    run_dataset(spark, root, out, *lists(spark))
    assert ids(spark, out) == ["1"] and len(subfolders(spark, f"{out}/comments/parquet")) == 1


def test_stream_and_runs_share_one_ledger(spark, tmp_path):
    root, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    pack(tmp_path / "in/comments/a.zst", line(1))
    pack(tmp_path / "in/comments/wide.zst", line(2), window_log=31)
    pack(tmp_path / "in/comments/cut.zst", line(3), finish=False)
    (tmp_path / "in/submissions").mkdir()
    stream_dataset(spark, root, out, progress, *lists(spark))
    assert ids(spark, out) == ["1", "2"]
    assert [r.base_name for r in pending_files(spark, root, out).collect()] == ["cut"]
    seen = spark.read.parquet(f"{out}/errors").count()
    # Calls go on; a file that failed is not read again as long as it is the same.
    pack(tmp_path / "in/comments/b.zst", line(4))
    stream_dataset(spark, root, out, progress, *lists(spark))
    assert ids(spark, out) == ["1", "2", "4"] and spark.read.parquet(f"{out}/errors").count() == seen
    # A run does what is new, and the stream then leaves that alone.
    pack(tmp_path / "in/comments/c.zst", line(5))
    (tmp_path / "in/comments/cut.zst").write_bytes(b"")
    pack(tmp_path / "in/comments/cut.zst", line(3) + line(6))
    assert len(run_dataset(spark, root, out, *lists(spark))) == 1
    entries = spark.read.parquet(f"{out}/manifest").count()
    stream_dataset(spark, root, out, progress, *lists(spark))
    assert run_dataset(spark, root, out, *lists(spark)) == []
    assert spark.read.parquet(f"{out}/manifest").count() == entries and ids(spark, out) == ["1", "2", "3", "4", "5", "6"]


def test_a_repaired_file_comes_through_the_stream(spark, tmp_path):
    root, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    pack(tmp_path / "in/comments/cut.zst", line(1), finish=False)
    stream_dataset(spark, root, out, progress, *lists(spark))
    (tmp_path / "in/comments/cut.zst").write_bytes(b"")
    pack(tmp_path / "in/comments/cut.zst", line(1) + line(2))
    stream_dataset(spark, root, out, progress, *lists(spark))
    assert ids(spark, out) == ["1", "2"] and list_files(spark, root).count() == 1


def test_no_value_is_lost(spark, tmp_path):
    out = str(tmp_path / "out")
    odd = {"score": 1.5, "ups": 2**70, "downs": "7", "stickied": "perhaps", "created_utc": 10**15, "gilded": None, "num_reports": "4x"}
    pack(tmp_path / "in/comments/a.zst", line(1, **odd) + line(2, score=3, stickied=True))
    run_dataset(spark, str(tmp_path / "in"), out, *lists(spark))
    got = {(r.id, r["col"]): r.value for r in live(spark, out, "rejected").collect()}
    assert got == {
        ("1", "score"): "1.5", ("1", "ups"): str(2**70), ("1", "stickied"): "perhaps",
        ("1", "created_utc"): str(10**15), ("1", "num_reports"): "4x",
    }
    audit = {r["col"]: (r.nulls_before, r.nulls_after) for r in live(spark, out, "stats/null_audit").collect()}
    assert len(audit) == 44 and audit["gilded"] == (2, 2) and audit["downs"] == (1, 1) and audit["body"] == (2, 0)
    rises = {c: after - before for c, (before, after) in audit.items() if after > before}
    assert rises == {c: 1 for _, c in got}


def test_lines_are_spread_in_blocks(spark, tmp_path):
    file = pack(tmp_path / "a.zst", "".join(f"line {i}\n" for i in range(10_000)))
    blocks = read_zst(spark, [file], blocks=True)
    spread = spread_lines(blocks, 8)
    assert spread.rdd.getNumPartitions() == 8 and blocks.count() == 10
    assert sorted(r.line_no for r in spread.collect()) == list(range(1, 10_001))
