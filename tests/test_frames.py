"""Big files over many tasks, lines across seams, bounded reads."""

import gzip
import json
import pickle
import random

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import pack
from recordsieve.sources import frames, zst
from recordsieve.sources.zst import block_lines, read_zst, span_bytes


def whole(data: bytes) -> list[str]:
    return [line for batch in zst.line_batches(zst.text_chunks(iter([data]))) for line in batch]


def parts(path, bounds) -> list[str]:
    out = []
    for at, end in bounds:
        out += [line for batch in zst.line_batches(zst.text_chunks(span_bytes(str(path), at, end))) for line in batch]
    return out


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.binary(max_size=12) | st.sampled_from([b"\r", b"\n", b"\r\n", b"a\r", b"\nb", "é".encode()[:1], "é".encode()[1:]]), min_size=1, max_size=8),
    st.data(),
)
def test_any_seams(tmp_path_factory, contents, data):
    folder = tmp_path_factory.mktemp("seams")
    packed = [zstandard.ZstdCompressor().compress(c) for c in contents]
    skip = (0x184D2A53).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"xyz"
    (folder / "a.zst").write_bytes(skip + b"".join(p + skip for p in packed))
    with open(folder / "a.zst", "rb") as f:
        f.size = lambda: (folder / "a.zst").stat().st_size
        places = None
        size = (folder / "a.zst").stat().st_size

        class Sized:
            read, seek = f.read, f.seek

            def size(self):
                return size

        places = frames.starts(Sized())
    assert len(places) == len(contents)
    chosen = [0, *sorted(data.draw(st.sets(st.sampled_from(places)))), size]
    bounds = [(a, b if b < size else None) for a, b in zip(chosen[:-1], chosen[1:], strict=True) if a < b]
    want = whole(b"".join(contents))
    assert parts(folder / "a.zst", bounds) == want
    # Plain text is divided at any byte.
    text = b"".join(contents)
    (folder / "a.txt").write_bytes(text)
    if text and not frames.is_frame(text[:4]) and not text.startswith(frames.GZIP):
        cuts = [0, *sorted(data.draw(st.sets(st.integers(1, len(text))))), len(text)]
        bounds = [(a, b if b < len(text) else None) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
        assert parts(folder / "a.txt", bounds) == want


def multi_frame(path, n=200, seed=4):
    dice = random.Random(seed)
    lines = ["".join(dice.choices("abcdef é", k=dice.choice([0, 5, 80, 3000]))) for _ in range(5000)]
    data = "\r\n".join(lines).encode()
    cuts = [0, *sorted(dice.sample(range(len(data)), n - 1)), len(data)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        file = pack(path, data[a:b])
    return file, [line.strip() for line in lines]


def test_one_file_feeds_many_tasks(spark, tmp_path):
    file, lines = multi_frame(tmp_path / "a.zst")
    found = read_zst(spark, [file], split_bytes=file[1] // 10)
    assert found.rdd.getNumPartitions() >= 9
    rows = found.orderBy("part", "line_no").collect()
    assert [r.line for r in rows] == lines and not any(r.error for r in rows)
    numbers = {}
    for r in rows:
        assert r.line_no == numbers.get(r.part, 0) + 1
        numbers[r.part] = r.line_no


def test_many_small_parts_share_a_task(spark, tmp_path):
    """Tasks follow the bytes and the slots, not the number of parts, and a task carries its own parts only."""
    file, lines = multi_frame(tmp_path / "a.zst", 2000)
    found = read_zst(spark, [file], split_bytes=1)
    assert found.select("part").distinct().count() > 1000
    assert found.rdd.getNumPartitions() <= 5 * spark.sparkContext.defaultParallelism
    assert [r.line for r in found.orderBy("part", "line_no").collect()] == lines
    reader = zst._Reader({"files": "[]", "parts": json.dumps([["a", i, i + 1, 1] for i in range(9999)]), "packBytes": "400"})
    packs = reader.partitions()
    assert len(packs) == 100 and [x for p in packs for x in p.parts] == [("a", i, i + 1) for i in range(9999)]
    assert len(pickle.dumps(reader)) < 1000


def test_blocks_hold_the_same_lines(spark, tmp_path):
    file, lines = multi_frame(tmp_path / "a.zst", 3)
    broken = pack(tmp_path / "cut.zst", "x\n" * 10, finish=False)
    blocks = read_zst(spark, [file, broken], blocks=True)
    rows = block_lines(blocks).collect()
    assert [r.line for r in sorted((r for r in rows if r.error is None and r.path == file[0]), key=lambda r: r.line_no)] == lines
    assert [r.path for r in rows if r.error] == [broken[0]] and blocks.count() < 20
    assert set(block_lines(blocks).columns) == set(read_zst(spark, [file]).columns)


@pytest.mark.parametrize("damage", ["cut", "junk inside"])
def test_damage_in_a_later_part_is_reported(spark, tmp_path, damage):
    (path, size), _ = multi_frame(tmp_path / "a.zst")
    data = bytearray((tmp_path / "a.zst").read_bytes())
    data = data[:-5] if damage == "cut" else data[: size // 2] + b"junk" * 20 + data[size // 2 + 80 :]
    (tmp_path / "a.zst").write_bytes(data)
    rows = read_zst(spark, [(path, len(data))], split_bytes=1000).collect()
    assert {r.path for r in rows if r.error} == {path}


def test_a_step_is_bounded(tmp_path):
    """A small file that unpacks to 200 MB comes in chunks of a block."""
    path = tmp_path / "bomb.zst"
    path.write_bytes(zstandard.ZstdCompressor().compress(b"\0" * 200_000_000))
    assert path.stat().st_size < 30_000
    sizes = [len(c) for c in span_bytes(str(path))]
    assert sum(sizes) == 200_000_000 and max(sizes) <= frames.BLOCK_MOST


def test_gzip_and_plain_text(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"one\r\ntw") + gzip.compress(b"o\n"))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(b"one\n" * 1000)[:-20])
    (tmp_path / "b c%20.txt").write_bytes(b" x \r\n\ny")
    files = [(str(p), p.stat().st_size) for p in tmp_path.iterdir()]
    rows = read_zst(spark, files).collect()
    good = sorted((r.path.rsplit("/", 1)[1], r.line_no, r.line) for r in rows if r.line is not None and "cut" not in r.path)
    assert good == [("a.gz", 1, "one"), ("a.gz", 2, "two"), ("b c%20.txt", 1, "x"), ("b c%20.txt", 2, ""), ("b c%20.txt", 3, "y")]
    assert [r.path.rsplit("/", 1)[1] for r in rows if r.error] == ["cut.gz"]
    bomb = tmp_path / "bomb.gz"
    bomb.write_bytes(gzip.compress(b"\0" * 50_000_000))
    assert max(len(c) for c in span_bytes(str(bomb))) <= zst.READ_BYTES


def test_places_with_blanks_and_percent_signs(monkeypatch):
    asked = []

    class System:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            return "store", {"s3": "bucket/", "hdfs": "/"}[uri.split(":")[0]]

    monkeypatch.setattr("pyarrow.fs.FileSystem", System)
    assert zst._place("s3a://bucket/a b%20c.zst") == ("store", "bucket/a b%20c.zst")
    assert zst._place("hdfs://host:9000/x/y z.zst") == ("store", "/x/y z.zst")
    assert asked == ["s3://bucket/", "hdfs://host:9000/"]
    assert zst._place("file:/a b%20.zst")[1] == "/a b%20.zst"
