"""Zstandard WARC archives: a dictionary in a leading skippable frame, then one frame per record.

Each task writes one archive into the shared folder, under a name of its own that it takes on when the file is whole; only
archives of tasks that succeeded are listed. Archives are read as a stream, one record in memory at a time.
"""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha1
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm.text import slices
from recordsieve.session import work_dir, written

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = (
    "archive string, page_id bigint, record_type string, target_uri string, date string, payload_bytes bigint,"
    " payload_digest string, refers_to bigint, payload binary, error string"
)


@dataclass(frozen=True)
class Settings:
    #: Payloads of fewer bytes are never replaced by a revisit.
    least: int = 0
    level: int = 6
    dictionary: int = 32 << 10
    #: Bytes of the first payloads of each archive that its dictionary is trained from.
    sample: int = 4 << 20
    date: str = "2024-01-01T00:00:00Z"
    #: A record that claims or holds more is refused, when it is written and when it is read.
    largest: int = 1 << 30


#: A leading frame that claims or unpacks to more is no dictionary. What a step unpacks is bounded by its bytes.
DICTIONARY_MOST = 16 << 20
STEP = 1 << 11


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, html: str, keeper: int | None, s: Settings) -> bytes:
    """The bytes of a response, or of a revisit of page `keeper`."""
    payload = html.encode("utf-8", "replace")
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if keeper is not None else http + payload
    if len(block) + 4096 > s.largest:
        raise ValueError(f"page {page_id} has {len(payload)} bytes, more than a record may have")
    own = "" if page_id is None else page_id
    lines = [
        ("WARC-Type", "response" if keeper is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{own}>"),
        ("WARC-Date", s.date),
        ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{own}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if keeper is not None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{keeper}>")]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading frame; the dictionary in it is itself compressed."""
    import zstandard

    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def write_archives(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write (page_id, url, html) under `folder`; returns the archives that were written: (archive, records).

    Of pages with equal payloads of at least `least` bytes, the one with the largest page_id becomes a response and the
    others revisit it; all shorter ones are responses. A NULL html is an empty payload, a NULL url becomes the page's own
    name. Rows that repeat the largest page_id are all responses; rows without page_id are responses unless a page with
    an id has their payload. Other columns are not read.

    Digests are grouped with partial aggregation, so a payload of a third of all pages is one row per task. Only digests
    that repeat are joined back; Spark broadcasts them if they are few and splits a hot one otherwise.
    """
    s = settings
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("digest", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    groups = own.where(F.octet_length("html") >= s.least).groupBy("digest")
    groups = groups.agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    repeated = written(groups.select(F.col("digest").alias("same"), "keeper"), f"{work_dir(pages.sparkSession, 'warc')}/same")
    joined = own.join(repeated, (F.col("digest") == F.col("same")) & (F.octet_length("html") >= s.least), "left")
    keeper = F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper"))

    def pack(batches):
        import zstandard
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        path = f"{base}/{uuid.uuid4().hex}.warc.zst"
        out = packer = None
        n = 0
        for batch in slices(batches, "html", s.sample):
            rows = [*zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "keeper")), strict=True)]
            if out is None and rows:
                out = system.open_output_stream(f"{path}.part", compression=None)
                samples = [r[2].encode("utf-8", "replace") for r in rows]
                try:
                    found = zstandard.train_dictionary(s.dictionary, samples)
                    out.write(dictionary_frame(found.as_bytes()))
                except zstandard.ZstdError:  # too few or too small samples
                    found = None
                packer = zstandard.ZstdCompressor(level=s.level, dict_data=found, write_checksum=True)
            for row in rows:
                out.write(packer.compress(record(*row, s)))
            n += len(rows)
        if out is not None:
            out.close()
            system.move(f"{path}.part", path)
            root = folder.rstrip("/")
            yield pa.RecordBatch.from_pydict({"archive": [f"{root}/{path.rsplit('/', 1)[1]}"], "records": [n]})

    rows = joined.select("page_id", "url", "html", keeper.alias("keeper"))
    return written(rows.mapInArrow(pack, "archive string, records bigint"), f"{work_dir(pages.sparkSession, 'warc')}/list")


def frames(read, largest: int) -> Iterator[bytes]:
    """The records of an archive; `read(n)` gives its next n bytes at most. Raises ValueError where it is malformed."""
    import zstandard

    size = 1 << 20
    rest = read(8)
    dictionary = None
    if len(rest) == 8 and struct.unpack("<I", rest[:4])[0] == SKIPPABLE:
        length = struct.unpack("<I", rest[4:])[0]
        if length > DICTIONARY_MOST:
            raise ValueError(f"the dictionary frame claims {length} bytes")
        body = b""
        while len(body) < length and (part := read(length - len(body))):
            body += part
        if len(body) < length:
            raise ValueError("the dictionary frame is cut short")
        if body[:4] == FRAME:
            body = zstandard.ZstdDecompressor().stream_reader(body).read(DICTIONARY_MOST + 1)
            if len(body) > DICTIONARY_MOST:
                raise ValueError(f"the dictionary unpacks to more than {DICTIONARY_MOST} bytes")
        dictionary, rest = zstandard.ZstdCompressionDict(body), b""
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while rest or (rest := read(size)):
        while len(rest) < 8 and (part := read(size)):
            rest += part
        kind = struct.unpack("<I", rest[:4])[0] if len(rest) >= 8 else 0
        if kind & 0xFFFFFFF0 == 0x184D2A50:  # any other skippable frame
            length = 8 + struct.unpack("<I", rest[4:8])[0]
            while len(rest) < length and (part := read(size)):
                rest += part
            if len(rest) < length:
                raise ValueError("a skippable frame is cut short")
            rest = rest[length:]
            continue
        frame, parts, total = unpacker.decompressobj(), [], 0
        while not frame.eof:
            if not rest and not (rest := read(size)):
                raise ValueError("a frame is cut short")
            for at in range(0, len(rest), STEP):  # a little at a time, so that a bomb is noticed
                parts.append(frame.decompress(rest[at : at + STEP]))
                total += len(parts[-1])
                if total > largest:
                    raise ValueError(f"a record has more than {largest} bytes")
                if frame.eof:
                    rest = frame.unused_data + rest[at + STEP :]
                    break
            else:
                rest = b""
        yield b"".join(parts)


def _headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise ValueError(f"malformed header line {line[:80]!r}")
        out[name.decode("ascii").lower()] = value.strip().decode("utf-8")
    return out


def _length(headers: dict[str, str]) -> int:
    value = headers.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise ValueError(f"Content-Length is {value!r}")
    return int(value)


def _page(name: str) -> int | None:
    if not (name.startswith("<urn:page:") and name.endswith(">")):
        raise ValueError(f"unknown record name {name!r}")
    return int(name[10:-1]) if name[10:-1] else None


def parse(data: bytes) -> dict:
    """A record's fields, after its headers, lengths and digests are checked; ValueError tells what is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (VERSION, b"WARC/1.0"):
        raise ValueError("no WARC header")
    headers = _headers(lines)
    if missing := {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys():
        raise ValueError(f"missing {', '.join(sorted(missing))}")
    size = _length(headers)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, Content-Length is {size}")
    block = rest[:size]
    if (want := headers.get("warc-block-digest")) and want != f"sha1:{base32_sha1(block)}":
        raise ValueError("the block differs from its digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP header")
    length, kind = _length(_headers(lines)), headers["warc-type"]
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != length:
            raise ValueError(f"the payload has {len(payload)} bytes, HTTP Content-Length is {length}")
        if digest != base32_sha1(payload):
            raise ValueError("the payload differs from its digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in headers or len(digest) != 32:
        raise ValueError(f"malformed record of type {kind!r}")
    return {
        "page_id": _page(headers["warc-record-id"]),
        "record_type": kind,
        "target_uri": headers.get("warc-target-uri"),
        "date": headers["warc-date"],
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": _page(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def read_archives(archives: DataFrame, payloads: bool = True, strict: bool = True, largest: int = Settings.largest) -> DataFrame:
    """The records of all archives of a DataFrame (archive): see READ; one task reads one archive at a time.

    A revisit has the length and digest of the payload it stands for, but no payload. With `strict`, anything malformed
    fails the job. Otherwise it becomes a row with `error`: a bad record is skipped, a bad frame ends its archive.
    """
    names = [x.split()[0] for x in READ.split(", ")]

    def unpack(batches):
        from pyarrow import fs

        schema = pa.schema(
            [(n, pa.int64() if n in ("page_id", "payload_bytes", "refers_to") else pa.binary() if n == "payload" else pa.string()) for n in names]
        )
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                held, size = [], 0
                system, path = fs.FileSystem.from_uri(archive)
                with system.open_input_stream(path, compression=None) as source:
                    for row in _rows(source.read, archive, strict, largest):
                        size += len(row.get("payload") or b"")
                        held.append(row if payloads else row | {"payload": None})
                        if size > 8 << 20 or len(held) >= 4096:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(n, "archive").mapInArrow(unpack, READ)


def _rows(read, archive: str, strict: bool, largest: int) -> Iterator[dict]:
    import zstandard

    try:
        for data in frames(read, largest):
            try:
                yield {"archive": archive, "error": None} | parse(data)
            except ValueError as e:
                if strict:
                    raise
                yield {"archive": archive, "error": str(e)}
    except (ValueError, zstandard.ZstdError) as e:
        if strict:
            raise ValueError(f"{archive}: {e}") from e
        yield {"archive": archive, "error": str(e)}
