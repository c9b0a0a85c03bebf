"""Document fingerprints: MinHash over word shingles, band join, Jaccard check; and fingerprints of edited texts.

A fingerprint is the low 16 bits of the minimum of each of `n_hash` universal hash functions over the text's shingles,
in hexadecimal. Two fingerprints are as alike as the share of their minima that agree, an estimate of the Jaccard
similarity of the shingle sets (standard deviation 0.044 at 0.5 with 128 functions).
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm import near_dups
from recordsieve.llm.rows import numbered
from recordsieve.llm.text import minima, shingles, slices, words
from recordsieve.session import work_dir, written


@dataclass(frozen=True)
class Settings:
    width: int = 5
    n_hash: int = 128
    seed: int = 31


def fingerprints(column: pa.Array, s: Settings) -> np.ndarray:
    """uint16[texts, n_hash]; texts without words have 65535 throughout."""
    return (minima(*shingles(*words(column), s.width), s.n_hash, s.seed) & np.uint32(0xFFFF)).astype(np.uint16)


def _hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints.astype(">u2")]


def similar(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents whose signatures share a band and whose Jaccard similarity,
    checked on the full sets, reaches `percent`; one row per document with its class. See `near_dups`."""
    return near_dups.near_duplicates(docs, near_dups.Settings(width=width, percent=percent))


def fingerprint(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_chars, fingerprint) for every row of `docs` (doc_id, text, ...); NULL texts count as empty."""
    s = settings

    def apply(batches):
        for batch in slices(batches, "text"):
            prints = _hex(fingerprints(batch.column("text"), s))
            sizes = [len(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        apply, "doc_id bigint, n_chars bigint, fingerprint string"
    )


def edited_fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each document beside its edited text: one row per row of `docs` (doc_id, text, ...).

    The edited text has its last third (rounded down, in code points) replaced by the beginning of the next document in
    descending doc_id; the last is followed by the first. Result: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. NULL texts count as empty; a single document is its own next. Rows without
    an id come last, and rows that repeat one follow each other in the order of their numbers (see `rows.numbered`); each
    is a document of its own. Other columns are not read.

    Documents are dealt out by ranges of doc_id (one shuffle of the texts, of even ranges whatever the ids are), and each
    task walks its own range. The one document that follows a range's last is sent along with that range.
    """
    s, spark = settings, docs.sparkSession
    texts = numbered(docs.select("doc_id", "text"), "row").withColumn("text", F.coalesce("text", F.lit("")))
    ids = texts.select("doc_id", "row")
    n = max(texts.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n) if x is not None})
    bounds = F.array(*[F.lit(x).cast("bigint") for x in cuts]) if cuts else F.array().cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda x: x < F.col("doc_id")))
    first = F.max(F.struct("doc_id", (-F.col("row")).alias("back")))  # NULL is the least
    top = {r.part: -r.back for r in ids.groupBy(part.alias("part")).agg(first["back"].alias("back")).collect()}
    order = sorted(top, reverse=True)
    follows = [(part, top[order[(i + 1) % len(order)]]) for i, part in enumerate(order)]  # a row per range
    extra = spark.createDataFrame(follows, "part int, row bigint")
    guests = written(
        texts.join(F.broadcast(extra), "row").select("part", "doc_id", "row", "text", F.lit(1).alias("guest")),
        f"{work_dir(spark, 'fingerprints')}/guests",
    )
    dealt = texts.select(part.alias("part"), "doc_id", "row", "text", F.lit(0).alias("guest")).unionByName(guests)
    dealt = dealt.repartition(n, "part").sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "row")

    def rows(batches):
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        held = None
        for batch in slices(batches, "text"):
            table = [*zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest")), strict=True)]
            print_own = fingerprints(batch.column("text"), s)
            if held:
                table, print_own = [held[0], *table], np.concatenate([held[1], print_own])
            held = table[-1], print_own[-1:]
            at = [i for i in range(len(table) - 1) if not table[i][3]]
            edited = []
            for i in at:
                text, after = table[i][2], table[i + 1][2]
                k = len(text) // 3
                edited.append(text[: len(text) - k] + after[:k])
            if not at:
                continue
            where = np.array(at)
            new = fingerprints(pa.array(edited, pa.large_string()), s)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([table[i][1] for i in at], pa.int64()),
                    pa.array([len(table[i][2]) for i in at], pa.int64()),
                    pa.array([sha256(x.encode()).hexdigest() for x in edited]),
                    pa.array(_hex(print_own[where])),
                    pa.array(_hex(new)),
                    pa.array((print_own[where] == new).mean(axis=1)),
                    pa.array((print_own[where] == print_own[where + 1]).mean(axis=1)),
                ],
                names,
            )

    return dealt.mapInArrow(
        rows,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
