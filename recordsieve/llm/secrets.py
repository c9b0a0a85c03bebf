"""Secret scans with built-in functions only: fixed formats, and character Markov models compared by likelihood ratio.

A text is scanned once per kind. What a pattern finds comes out as the strings found and the lengths of the gaps between
them; places are their running sums, made per document in rows, so a text with very many finds stays linear. Only
documents with finds take part in that.

The models are first-order character chains of random strings and of ordinary identifiers. They are trained from labelled
examples: random strings are what the fixed formats find, and digests of document ids in base64 and hex; ordinary
identifiers are the other long words. Both come from all documents. A run of `shortest` characters or more is a secret if its mean log-likelihood ratio per character reaches `margin`. The ratios are
a literal of at most 67 * 67 numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordsieve.session import work_dir, written

# The formats, in the order in which spans are listed. Runs are maximal, so a run's least length can stand
# in the pattern for the last two.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


@dataclass(frozen=True)
class Settings:
    shortest: int = 20
    margin: float = 1.0
    smoothing: float = 0.5


def _patterns(s: Settings) -> dict[str, str]:
    return dict(zip(KINDS, (ASSIGN, ACCESS, HEX, f"[A-Za-z0-9+/_=-]{{{s.shortest},}}"), strict=True))


def _found(pattern: str) -> Column:
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(0))


def _value(found: Column) -> Column:
    return F.regexp_extract(found, ASSIGN, 1)


def train(docs: DataFrame, s: Settings) -> list[float]:
    """Log-likelihood ratios, random over ordinary, of every character after every other, row by row of ALPHABET.

    Rows without a doc_id are left out.
    """
    texts = docs.where("doc_id IS NOT NULL")
    ids = texts.select("doc_id").distinct()
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    made = ids.select(F.explode(F.array(F.base64(F.unhex(digest)), digest)).alias("word"), F.lit(1).alias("random"))
    values = F.concat(F.transform(_found(ASSIGN), _value), _found(ACCESS), _found(HEX))
    labelled = texts.select(F.explode(values).alias("word"), F.lit(1).alias("random")).where(
        F.length("word") >= ASSIGN_LEAST
    )
    plain = F.filter(
        F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=-]{8,}"), F.lit(0)),
        lambda w: ~F.rlike(w, F.lit(r"[0-9a-f]{16}|AKIA|[0-9].*[0-9].*[0-9]")),
    )
    ordinary = texts.select(F.explode(plain).alias("word"), F.lit(0).alias("random"))
    words = made.unionAll(labelled).unionAll(ordinary)
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))
    rows = (
        words.where("length(word) > 1").select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count()
    ).collect()  # at most 2 * 67 * 67 and a few rows more
    size = len(ALPHABET)
    counts = [[[s.smoothing] * size for _ in range(size)] for _ in range(2)]
    for r in rows:
        a, b = ALPHABET.find(r.pair[0]), ALPHABET.find(r.pair[1])
        if a >= 0 and b >= 0:
            counts[r.random][a][b] += r["count"]
    chance = [[[c / sum(row) for c in row] for row in table] for table in counts]
    return [math.log(chance[1][a][b] / chance[0][a][b]) for a in range(size) for b in range(size)]


def likelihood_ratio(word: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per character pair of a word over ALPHABET."""
    table = F.split(F.lit(",".join(f"{r:.5f}" for r in ratios)), ",").cast("array<double>")
    code = lambda i: F.instr(F.lit(ALPHABET), word.substr(i, F.lit(1)))
    steps = F.transform(
        F.sequence(F.lit(1), F.length(word) - 1),
        lambda i: F.element_at(table, (code(i) - 1) * len(ALPHABET) + code(i + 1)),
    )
    return F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / (F.length(word) - 1)


def spans(docs: DataFrame, settings: Settings = Settings(), keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of `docs` as (row, doc_id, kept_0, ...), and their spans as (row, kind, kind_no, start, end)."""
    s, store = settings, work_dir(docs.sparkSession, "secrets")
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)])
    ratios = train(named.select("doc_id", "text"), s)
    patterns = _patterns(s)
    columns = []
    for kind, pattern in patterns.items():
        gaps = F.transform(F.split("text", pattern, -1), lambda x: F.length(x))
        columns += [
            F.when(F.size(f"{kind}_found") > 0, gaps).otherwise(F.array().cast("array<int>")).alias(f"{kind}_gaps"),
            F.col(f"{kind}_found"),
        ]
    found = named.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", "text", *[f"kept_{i}" for i in range(len(keep))], *[_found(p).alias(f"{k}_found") for k, p in patterns.items()]
    )
    # Written, so that row numbers stay. The text goes along only where it is asked for.
    table = written(found.select("row", "doc_id", *[f"kept_{i}" for i in range(len(keep))], *columns), f"{store}/found")
    parts = None
    for number, kind in enumerate(KINDS):
        some = table.where(F.size(f"{kind}_found") > 0).select(
            "row", F.lit(kind).alias("kind"), F.lit(number).alias("kind_no"),
            F.posexplode(F.arrays_zip(F.col(f"{kind}_gaps").alias("gap"), F.col(f"{kind}_found").alias("found"))).alias("i", "x"),
        )
        some = some.select("row", "kind", "kind_no", "i", F.col("x.gap").alias("gap"), F.col("x.found").alias("found"))
        parts = some if parts is None else parts.unionAll(some)
    order = Window.partitionBy("row", "kind_no").orderBy("i")
    whole = F.col("gap") + F.coalesce(F.length("found"), F.lit(0))
    end = F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("end", end).where("found IS NOT NULL").withColumn("start", F.col("end") - F.length("found"))
    good = (
        F.when(F.col("kind") == "assign", F.length(_value(F.col("found"))) >= ASSIGN_LEAST)
        .when(F.col("kind") == "markov", likelihood_ratio(F.col("found"), ratios) >= s.margin)
        .otherwise(True)
    )
    return table, placed.where(good).select("row", "kind", "kind_no", "start", "end")


def secrets(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) for every row of `docs` (doc_id, text, ...).

    Spans are kind:start:end in code points, end exclusive, by start and then by the order of KINDS, joined by commas;
    `base_sha256` is the digest of those of the first three kinds. NULL and empty texts have none: counts 0, an empty
    string and its digest. Other columns are not read.
    """
    table, found = spans(docs, settings)
    text = F.concat_ws(":", "kind", "start", "end")
    lists = found.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS],
        F.array_sort(F.collect_list(F.struct("start", "kind_no", text.alias("text")))).alias("all"),
    )
    joined = lambda x: F.array_join(F.transform(x, lambda y: y["text"]), ",")
    lists = lists.withColumn("base", joined(F.filter("all", lambda x: x["kind_no"] < 3))).withColumn("spans", joined(F.col("all")))
    out = table.select("row", "doc_id").join(lists, "row", "left")
    return out.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redacted(docs: DataFrame, settings: Settings = Settings(), mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of `docs`, with `mark` in the place of each secret of `text`; overlapping ones share a mark.

    A NULL text stays NULL. Texts without secrets stay as they are.
    """
    names = docs.columns
    table, found = spans(docs, settings, tuple(names))
    lists = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    # Each span first ends at the furthest end so far; a span that begins before that adds nothing new.
    text = F.col(f"kept_{names.index('text')}")
    step = lambda a, x: F.struct(
        F.concat(
            a["done"],
            F.when(x["start"] >= a["at"], F.concat(text.substr(a["at"] + 1, x["start"] - a["at"]), F.lit(mark))).otherwise(""),
        ).alias("done"),
        F.greatest(a["at"], x["end"]).alias("at"),
    )
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))
    last = lambda a: F.concat(a["done"], text.substr(a["at"].cast("int") + 1, F.length(text)))
    cuts = F.transform("cuts", lambda x: F.struct(x["start"].cast("bigint").alias("start"), x["end"].cast("bigint").alias("end")))
    new = F.when(F.col("cuts").isNull(), text).otherwise(F.aggregate(cuts, start, step, last))
    rows = table.join(lists, "row", "left")
    return rows.select(*[(new if c == "text" else F.col(f"kept_{i}")).alias(c) for i, c in enumerate(names)])
