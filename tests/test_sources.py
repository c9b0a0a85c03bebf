"""Compressed files, listings and lists."""

import pytest

from helpers import pack, sorted_rows
from recordsieve.sources.files import list_files, read_text_lines, read_word_list
from recordsieve.sources.zst import _Reader, read_zst


def read(spark, *files):
    rows = read_zst(spark, files).orderBy("path", "line_no").collect()
    return [r.line for r in rows if r.error is None], [r.error for r in rows if r.error]


@pytest.mark.parametrize("window_log", [None, 27, 31])
def test_windows(spark, tmp_path, window_log):
    lines = [f"line {i} é" for i in range(20000)]
    got, errors = read(spark, pack(tmp_path / "a.zst", "\n".join(lines), window_log))
    assert got == lines and errors == []


def test_frames_line_ends_and_blanks(spark, tmp_path):
    pack(tmp_path / "a.zst", "one\r\ntwo\rthr")
    f = pack(tmp_path / "a.zst", "ee \n\n\t four　\n")
    got, errors = read(spark, f)
    assert got == ["one", "two", "three", "", "four"] and errors == []
    numbers = read_zst(spark, [f]).select("line_no").collect()
    assert sorted(n.line_no for n in numbers) == [1, 2, 3, 4, 5]


def test_bad_utf8_is_replaced(spark, tmp_path):
    got, errors = read(spark, pack(tmp_path / "a.zst", b"a\xffb\nc\n"))
    assert got == ["a�b", "c"] and errors == []


def test_split_inside_a_character(spark, tmp_path):
    text = "é" * 300_000 + "\n" + "ü" * 10
    got, _ = read(spark, pack(tmp_path / "a.zst", text))
    assert got == text.split("\n")


def test_unreadable_files_do_not_stop_others(spark, tmp_path):
    cut = pack(tmp_path / "cut.zst", "x\n" * 10, finish=False)
    (tmp_path / "junk.zst").write_bytes(b"not zstd at all")
    good = pack(tmp_path / "good.zst", "fine\n")
    (tmp_path / "void.zst").write_bytes(b"")
    rows = read_zst(
        spark,
        [cut, good, (str(tmp_path / "junk.zst"), 15), (str(tmp_path / "gone.zst"), 1), (str(tmp_path / "void.zst"), 0)],
    ).collect()
    failed = {r.path.rsplit("/", 1)[1] for r in rows if r.error}
    assert failed == {"cut.zst", "junk.zst", "gone.zst"}
    assert [r.line for r in rows if r.path.endswith("good.zst")] == ["fine"]


def test_big_files_get_their_own_task():
    reader = _Reader({"files": '[["a", 5], ["b", 50], ["c", 4], ["d", 200]]', "packBytes": "60"})
    assert [p.paths for p in reader.partitions()] == [["d"], ["b", "a", "c"]]


def test_jvm_reader_agrees(spark, tmp_path):
    f, size = pack(tmp_path / "a.zst", "one\r\ntwo\rthree\n", 27)
    native = [r.line for r in read_text_lines(spark, f).collect()]
    assert native == ["one", "two", "three"] == read(spark, (f, size))[0]


def test_listing(spark, tmp_path, caplog):
    pack(tmp_path / "comments" / "RC_1.zst", "x")
    (tmp_path / "comments" / "notes.txt").write_text("no")
    found = list_files(spark, str(tmp_path))
    assert [(r.kind, r.base_name) for r in found.collect()] == [("comments", "RC_1")]
    assert "submissions" in caplog.text


def test_word_list(spark, tmp_path):
    (tmp_path / "w.txt").write_text("Beta\n\n  alpha \r\nBETA\n　\ngamma")
    assert sorted_rows(read_word_list(spark, str(tmp_path / "w.txt"))) == [("alpha",), ("beta",), ("gamma",)]
