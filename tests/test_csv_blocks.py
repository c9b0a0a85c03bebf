"""CSV files divided anywhere, against the reader of whole files."""

import csv
import io
import random

import pytest

from helpers import sorted_rows
from recordsieve.sources.csv_blocks import block_records, read_csv_blocks
from recordsieve.sources.files import read_csv

NASTY = ["a,b", 'say "hi"', "line\nbreak", "cr\rhere", "both\r\n", '"', '""', "\n\n\n", "", "é😀", "x" * 300, '",\n"', "#x", " pad "]


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1000, 10**6])
def test_records_of_blocks(tmp_path, block):
    dice = random.Random(block)
    rows = [["id", "v"], *([str(i), dice.choice(NASTY)] for i in range(120))]
    path = tmp_path / "a.csv"
    data = text_of(rows, dice.choice(["\n", "\r\n"])).encode()
    path.write_bytes(data if dice.random() < 0.5 else data.rstrip(b"\r\n"))
    data = path.read_bytes()
    got, quotes = [], 0
    for at in range(0, len(data), block):
        got += block_records(str(path), len(data), at, min(at + block, len(data)), quotes % 2 == 1)
        quotes += data[at : at + block].count(b'"')
    assert [next(csv.reader(io.StringIO(r.decode(), newline=""))) for r in got] == rows


def test_as_whole_files(spark, tmp_path):
    dice = random.Random(3)
    for name in ("a", "b"):
        rows = [["id", "v", "w"], *([f"{name}{i}", dice.choice(NASTY), dice.choice(NASTY)] for i in range(500))]
        (tmp_path / f"{name}.csv").write_text(text_of(rows), newline="")
    (tmp_path / "void.csv").write_text("")
    found = read_csv_blocks(spark, str(tmp_path), block_bytes=500)
    assert found.columns == ["id", "v", "w"] and found.rdd.getNumPartitions() > 20
    whole = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted_rows(found) == sorted_rows(whole) and found.count() == 1000


def test_no_files(spark, tmp_path):
    assert read_csv_blocks(spark, str(tmp_path), "id string").count() == 0
    assert read_csv_blocks(spark, str(tmp_path)).count() == 0
