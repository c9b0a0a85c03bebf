"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled (by a hash of their id) and queued. A document's virtual finish time is the
number of words queued up to and with it, divided by the source's target. A source whose target exceeds its size is
queued again from the start. The mix is all copies by virtual finish time, cut off at the total budget.

Running sums need no task to see a whole source: a source is cut into buckets of about `rows` documents by the same hash,
bucket sums are added up in a small table, and each bucket then runs its own sum. The cut is found likewise: sums of
ranges of finish times, then the order within the one range where the budget ends. It is one value to compare with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordsieve.llm.rows import fresh, numbered
from recordsieve.operators.membership import bounded
from recordsieve.session import work_dir, written


@dataclass(frozen=True)
class Settings:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: int = 2
    rows: int = 5_000
    seed: int = 29


def targets(sizes: DataFrame, s: Settings) -> DataFrame:
    """(source, source_size, rank, target) of (source, source_size), a row per source.

    Sources weigh `weights` in turn by name (NULL last) and share `share` times all sizes. What a source cannot use above
    `most` times its size goes to the others by weight: sources are filled up in the order of size over weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in s.weights])
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(weights, F.expr(f"pmod(rank - 1, {len(s.weights)}) + 1").cast("int"))
    )
    ranked = ranked.withColumn("most", F.col("source_size") * F.lit(float(s.most)))
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    everything = Window.partitionBy(F.lit(0))
    filled = ranked.select(
        "*",
        (
            (F.lit(s.share) * F.sum("source_size").over(everything)
             - F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
        ).alias("level"),
        F.row_number().over(order).alias("turn"),
    )
    free = F.when(F.col("level") * F.col("weight") < F.col("most"), F.struct("turn", "level"))
    filled = filled.withColumn("free", F.min(free).over(everything))
    target = F.when(F.col("turn") < F.col("free.turn"), F.col("most")).otherwise(
        F.coalesce(F.least("most", F.col("free.level") * F.col("weight")), F.col("most"))
    )
    return filled.select("source", "source_size", "rank", target.alias("target"))


def queued(docs: DataFrame, settings: Settings = Settings(), row: str = "doc_id") -> DataFrame:
    """All rows of (doc_id, source, text, ...) as doc_id, row, size, source_size, target, copies.

    `copies` has the finish times of the copies that are taken; `row` is the column `row`, to find the document by. Only
    these thin rows are queued: texts are read for their sizes, and neither written nor shuffled.
    """
    s, spark = settings, docs.sparkSession
    store = work_dir(spark, "mixing")
    size = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    thin = docs.select(
        "doc_id", F.col(row).alias("row"), "source",
        F.when(F.col("text").isNull(), 0).otherwise(size).cast("bigint").alias("size"),
        F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(s.seed)), 33).alias("turn"),
    )
    thin = written(thin, f"{store}/sizes")
    sums = thin.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    shares = targets(sums.select("source", "source_size"), s)
    table = written(
        shares.join(sums.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s"),
        f"{store}/targets",
    ).withColumnRenamed("source", "s")
    rows = thin.join(table, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "bucket", F.shiftright(F.col("turn") * F.ceil(F.col("n") / s.rows).cast("bigint"), 31)
    )
    own = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        own.select("rank", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")), f"{store}/offsets"
    )
    order = Window.partitionBy("rank", "bucket").orderBy("turn", "doc_id", "size", "row")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    queue = rows.withColumn("upto", upto).join(offsets, ["rank", "bucket"]).withColumn("upto", F.col("upto") + F.col("offset"))
    copies = F.transform(
        F.sequence(F.lit(0), F.lit(s.most - 1)),
        lambda e: F.struct(
            ((e * F.col("source_size") + F.col("upto")) / F.col("target")).alias("finish"),
            F.col("rank"), F.col("turn"), F.col("doc_id"), F.col("size"), e.alias("copy"),
        ),
    )
    copies = F.when((F.col("size") > 0) & (F.col("target") > 0), copies)
    queue = written(
        queue.select("doc_id", "row", "size", "source_size", "target", copies.alias("copies")), f"{store}/queue"
    )
    last = _cut(queue, s)
    chosen = F.filter("copies", lambda c: F.lit(False) if last is None else c <= last)
    chosen = F.coalesce(F.transform(chosen, lambda c: c["finish"]), F.array().cast("array<double>"))
    return queue.select("doc_id", "row", "size", "source_size", "target", chosen.alias("copies"))


def _cut(queue: DataFrame, s: Settings):
    """The last copy within the budget, as a column to compare copies with; None if there is none."""
    total = queue.agg(F.sum("size").alias("words"), F.count("*").alias("n")).first()
    if not total.words:
        return None
    budget, ranges = s.share * total.words, max(1, -(-total.n * s.most // s.rows))
    one = queue.select(F.explode("copies").alias("c")).withColumn("range", F.floor(F.col("c.finish") * ranges))
    sums = one.groupBy("range").agg(F.sum("c.size").alias("words"))
    order = Window.orderBy("range")
    edge = sums.select("range", F.sum("words").over(order).alias("upto"), "words").where(F.col("upto") > budget)
    edge = edge.orderBy("range").first()
    if edge is None:  # everything fits
        return _literal(one.agg(F.max("c").alias("c")).first().c, one)
    upto = F.sum("c.size").over(Window.partitionBy("range").orderBy("c").rowsBetween(Window.unboundedPreceding, 0))
    within = one.where(F.col("range") == edge.range).select("c", upto.alias("upto"))
    room = budget - (edge.upto - edge.words)
    last = within.where(F.col("upto") <= room).agg(F.max("c").alias("c")).first().c
    if last is None:
        last = one.where(F.col("range") < edge.range).agg(F.max("c").alias("c")).first().c
    return None if last is None else _literal(last, one)


def _literal(row, one: DataFrame):
    kind = one.schema["c"].dataType
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])


def mixed(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of `docs` (doc_id, source, text, ...).

    `size` is the number of words (NULL text: 0), `taken` the words the mix takes, repeats counted. Documents without
    words are in no mix. A NULL source is a source of its own. Rows that repeat a doc_id queue one after the other. A copy
    is taken whole or not at all, so a source misses its target by less than a document. Other columns are not read.
    """
    rows = queued(docs, settings)
    return rows.select("doc_id", "size", "source_size", "target", (F.size("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The mix itself: one row for each copy taken, all columns of `docs` and the time, range-sorted by it.

    The time is the last column, virtual_finish (virtual_finish_2 and so on if `docs` has one of that name). Rows are
    found again by their number: the list of copies is broadcast if it is proven small, else joined. The documents taken
    are then shuffled once, to their ranges.
    """
    names = docs.columns
    row, time = fresh("row", names), fresh("virtual_finish", names)
    whole = numbered(docs, row)
    copies = queued(whole, settings, row).where(F.size("copies") > 0)
    taken = written(copies.select(F.col("row").alias(row), F.col("copies").alias(time)), work_dir(docs.sparkSession, "mix"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = whole.join(bounded(taken), row).withColumn(time, F.explode(time))
    return rows.repartitionByRange(n, time, row).sortWithinPartitions(time, row).select(*names, time)
