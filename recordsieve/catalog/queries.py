"""One query per operator, over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsieve.catalog import bindings as b
from recordsieve.functions import coerce as to
from recordsieve.functions import text, truth
from recordsieve.operators import stats
from recordsieve.operators.audit import null_audit as audit_nulls
from recordsieve.operators.cascade import judge
from recordsieve.operators.duplicates import (
    drop_duplicates, duplicate_rows, duplicate_summary,
)
from recordsieve.operators.key_index import drop_seen
from recordsieve.operators.membership import drop_members, keep_members, word_list
from recordsieve.operators.parse import parse_records as parse
from recordsieve.operators.parse import parse_status
from recordsieve.plans.clean import clean
from recordsieve.plans.dataset import pending_files, process_files, run_dataset
from recordsieve.plans.duplicate_check import check_duplicates
from recordsieve.plans.ledger import live
from recordsieve.session import work_dir
from recordsieve.sinks.tables import write_csv, write_parquet, write_report
from recordsieve.sources.csv_blocks import read_csv_blocks
from recordsieve.sources.files import clean_words, list_files, read_csv
from recordsieve.sources.zst import read_zst
from recordsieve.specs import COMMENTS, DELETED_AUTHOR, SUBMISSIONS
from recordsieve.streaming.incremental import stream_dataset

#: What the writer of test files appends to their names.
FAMILY = "-[0-9a-f]+$"

REGISTRY = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def _event_lists(spark):
    return word_list(spark, b.TOPICS_EVENTS), word_list(spark, b.BOTS_EVENTS)


def _document_lists(spark):
    return word_list(spark, b.TOPICS_DOCUMENTS), word_list(spark, ["FR"])


def _clean_documents(spark, sf_dir):
    return clean(b.document_lines(spark, sf_dir), SUBMISSIONS, *_document_lists(spark), by=("doc_id",))


def _clean_events(spark, sf_dir, by=("kind",), store=None):
    lines = b.comment_lines(spark, sf_dir).withColumn("kind", F.lit("comments"))
    return clean(lines, COMMENTS, *_event_lists(spark), by=by, store=store)


# --- lists, names, predicates ---


@query
def lookup_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "conversations")
    messy = F.concat(F.lit("\t  "), F.upper("role"), F.lit("\u3000\r"))
    raw = rows.select(F.explode(F.array(messy, F.lit(" \t"))).alias("value"))
    return clean_words(raw, "value")


@query
def base_name(spark, sf_dir):
    pages = b.table(spark, sf_dir, "pages")
    return pages.selectExpr(
        "page_id",
        text.base_name("concat(url, '.tar.zst')") + " AS base_name",
        text.base_name("url") + " AS bare_name",
    )


@query
def topic_semi(spark, sf_dir):
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "source")
    topics = word_list(spark, b.TOPICS_DOCUMENTS)
    return keep_members(documents, text.key_of("source"), topics)


@query
def author_anti(spark, sf_dir):
    rows = b.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    bots = word_list(spark, ["System", DELETED_AUTHOR])
    return drop_members(rows, text.key_of("role"), bots)


@query
def pred_not_null(spark, sf_dir):
    rows = b.labelled(spark, sf_dir)
    return rows.where(f"{truth.present('quality')} OR {truth.present('toxic')}").select("doc_id")


@query
def pred_truthy(spark, sf_dir):
    return b.labelled(spark, sf_dir).where(truth.truthy("CAST(toxic AS STRING)")).select("doc_id")


# --- parse and cascade ---


@query
def parse_records(spark, sf_dir):
    parsed = parse(b.comment_lines(spark, sf_dir), ["id", "subreddit"])
    return parse_status(parsed).select(
        "event_id", "parse_status", F.lower("record.subreddit").alias("subreddit")
    )


def _reasons(judged, *keys):
    return judged.selectExpr(*keys, text.fill("reason", "kept") + " AS reason")


@query
def reason_cascade(spark, sf_dir):
    return _reasons(_clean_documents(spark, sf_dir).judged, "doc_id")


@query
def reason_cascade_comments(spark, sf_dir):
    return _reasons(_clean_events(spark, sf_dir).judged, "event_id")


@query
def reason_cascade_submissions(spark, sf_dir):
    lines = b.submission_lines(spark, sf_dir)
    return _reasons(judge(lines, SUBMISSIONS, *_event_lists(spark)), "event_id")


# --- statistics ---


@query
def stats_totals(spark, sf_dir):
    return stats.totals(_clean_events(spark, sf_dir).cells, ("kind",))


@query
def stats_by_reason(spark, sf_dir):
    lines = b.submission_lines(spark, sf_dir).withColumn("kind", F.lit("submissions"))
    cleaned = clean(lines, SUBMISSIONS, *_event_lists(spark), by=("kind",))
    return stats.by_reason(cleaned.cells, SUBMISSIONS.reasons, ("kind",))


@query
def stats_by_group(spark, sf_dir):
    return stats.by_group(_clean_events(spark, sf_dir).cells, ("kind",))


@query
def stats_report(spark, sf_dir):
    """Written as text files, read back line by line."""
    cells = _clean_events(spark, sf_dir).cells
    path = work_dir(spark, "report")
    write_report(stats.report_lines(cells, COMMENTS.reasons, ("kind",)), path, ("kind",))
    return spark.read.text(path).select("kind", F.col("value").alias("line"))


# --- coercions ---


@query
def flatten_text(spark, sf_dir):
    return b.table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", text.flatten_text("text") + " AS body"
    )


@query
def coerce_boolean(spark, sf_dir):
    raw = (
        F.when(F.col("toxic") == 1, F.lit("true"))
        .when(F.col("toxic") == 0, F.lit("0.0"))
        .otherwise("yes")
    )
    rows = b.labelled(spark, sf_dir).withColumn("raw", raw)
    return rows.selectExpr("doc_id", to.to_boolean("raw") + " AS over_18")


@query
def coerce_numeric(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    damaged = F.col("event_id") % 10 == 0
    whole = F.when(damaged, F.lit("1d")).otherwise(F.concat(F.lit(" "), F.col("user_id"), F.lit(".0 ")))
    real = F.when(damaged, F.lit("nan")).otherwise(F.col("value").cast("string"))
    return events.select("event_id", whole.alias("whole"), real.alias("real")).selectExpr(
        "event_id", to.to_bigint("whole") + " AS score", to.to_double("real") + " AS upvote_ratio"
    )


@query
def epoch_ts(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")
    raw = F.when(F.col("o_orderkey") % 10 == 0, F.lit("abc")).otherwise(F.concat(seconds, F.lit(".25")))
    created = f"CAST({to.to_timestamp('raw')} AS TIMESTAMP_NTZ) AS created"
    return orders.withColumn("raw", raw).selectExpr("o_orderkey", created)


@query
def json_text(spark, sf_dir):
    """From the nested field of lines that parse; bad lines have none."""
    parsed = parse(b.comment_lines(spark, sf_dir), ["gildings"])
    return parsed.selectExpr("event_id", to.to_json_text("record.gildings") + " AS props_json")


@query
def fill_defaults(spark, sf_dir):
    grade = F.when(F.col("quality") == 1, F.lit("good")).when(F.col("quality") == 0, F.lit("bad"))
    toxic = F.when(F.col("toxic") == 1, F.lit("toxic"))
    rows = b.labelled(spark, sf_dir).select("doc_id", grade.alias("grade"), toxic.alias("toxic"))
    return rows.selectExpr(
        "doc_id", text.fill("grade", "none") + " AS distinguished", text.fill("toxic") + " AS category"
    )


@query
def null_audit(spark, sf_dir):
    raw = F.when(F.col("event_id") % 10 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
    events = b.table(spark, sf_dir, "events").select(raw.alias("raw"))
    score = audit_nulls(events, {"score": ("raw", to.to_bigint("raw"))})
    flags = b.labelled(spark, sf_dir).select(F.col("quality").cast("string"))
    quality = audit_nulls(flags, {"quality": ("quality", to.to_boolean("quality"))})
    return score.unionByName(quality)


@query
def null_audit_kept(spark, sf_dir):
    """The audit of a whole cleaning run, all coerced columns."""
    return _clean_events(spark, sf_dir).audit


@query
def clean_submissions(spark, sf_dir):
    kept = _clean_documents(spark, sf_dir).kept
    return kept.select(
        "id", "subreddit", "author", "title", "selftext", "score", "distinguished",
        "is_original_content", "created_utc", "media", "permalink", "subreddit_id",
    ).withColumn("created_utc", F.col("created_utc").cast("timestamp_ntz"))


@query
def clean_comments(spark, sf_dir):
    lists = word_list(spark, ["LONG"]), word_list(spark, ["System"])
    kept = clean(b.conversation_lines(spark, sf_dir), COMMENTS, *lists).kept
    return kept.select("link_id", "subreddit", "author", "body", "score", "distinguished", "all_awardings")


# --- duplicates ---


@query
def dup_rows(spark, sf_dir):
    rows = duplicate_rows(b.table(spark, sf_dir, "documents"), "text", long_keys=True)
    return rows.select("doc_id", "source")


@query
def dup_summary(spark, sf_dir):
    return duplicate_summary(b.table(spark, sf_dir, "documents"), "text", long_keys=True)


@query
def dup_null_keys(spark, sf_dir):
    return duplicate_summary(b.labelled(spark, sf_dir), "quality")


@query
def dup_null_rows(spark, sf_dir):
    """Rows with a NULL key are duplicates of each other."""
    return duplicate_rows(b.labelled(spark, sf_dir), "quality").select("doc_id", "quality")


@query
def dedup_keep_first(spark, sf_dir):
    documents = b.table(spark, sf_dir, "documents")
    return drop_duplicates(
        documents, "text", ["doc_id"], long_keys=True, columns=["doc_id", "source", "lang"]
    )


@query
def dup_csv(spark, sf_dir):
    """Documents written as CSV, checked by file, the duplicate file read back."""
    source, found = work_dir(spark, "documents-csv"), work_dir(spark, "duplicates-csv")
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    write_csv(documents, source, by=())
    check_duplicates(spark, source, found, "text")
    return read_csv(spark, found, "doc_id bigint, text string, source string")


# --- sources, sinks, whole runs ---


def _named(lines, kind):
    return lines.select(F.lit(kind).alias("kind"), F.col("event_type").alias("name"), "line")


def _files(spark, root, *kinds):
    rows = list_files(spark, root).where(F.col("kind").isin(*kinds))
    return [(f.path, f.size) for f in rows.collect()]


@query
def zst_scan(spark, sf_dir):
    root = work_dir(spark, "zst-scan")
    b.write_zst(_named(b.comment_lines(spark, sf_dir), "comments"), root)
    lines = read_zst(spark, _files(spark, root, "comments"))
    parsed = parse(lines, ["id", "subreddit", "author"], stripped=True)
    good = parsed.where(F.col("record").isNotNull())
    return good.select(
        F.col("record.id").cast("bigint").alias("event_id"),
        F.lower("record.subreddit").alias("event_type"),
        F.lower("record.author").alias("author"),
    )


@query
def dataset_scan(spark, sf_dir):
    """Lines per kind and file family of a two-kind tree."""
    root = work_dir(spark, "dataset-scan")
    both = [
        _named(b.comment_lines(spark, sf_dir), "comments"),
        _named(b.submission_lines(spark, sf_dir), "submissions"),
    ]
    b.write_zst(reduce(DataFrame.unionByName, both), root)
    files = list_files(spark, root)
    lines = read_zst(spark, [(f.path, f.size) for f in files.collect()])
    named = lines.join(F.broadcast(files.select("kind", "base_name", "path")), "path")
    family = F.regexp_replace("base_name", FAMILY, "")
    return named.groupBy("kind", family.alias("name")).agg(F.count("line").alias("n"))


@query
def csv_round_trip(spark, sf_dir):
    path = work_dir(spark, "csv")
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    write_csv(documents, path, by=("source",))
    rows = read_csv(spark, path, "doc_id bigint, text string, lang string, source string")
    return rows.select("doc_id", "text", "lang", "source")


@query
def parquet_sink(spark, sf_dir):
    """Written twice: a rerun replaces its partitions."""
    path = work_dir(spark, "parquet")
    kept = _clean_events(spark, sf_dir, ("kind", "event_type")).kept
    kept = kept.withColumnRenamed("event_type", "base_name")
    write_parquet(kept, path)
    write_parquet(kept, path)
    rows = spark.read.schema(kept.schema).parquet(path)
    return rows.select(F.col("id").cast("bigint").alias("event_id"), "kind", "base_name", "author", "score", "gildings")


def _run(spark, sf_dir, broken=()):
    root, output = work_dir(spark, "dumps"), work_dir(spark, "output")
    b.write_zst(_named(b.comment_lines(spark, sf_dir), "comments"), root, broken)
    run_dataset(spark, root, output, *_event_lists(spark))
    return root, output


@query
def dataset_run(spark, sf_dir):
    """A whole run over compressed files, run again with nothing left to do."""
    root, output = _run(spark, sf_dir)
    run_dataset(spark, root, output, *_event_lists(spark))
    kept = read_csv(spark, f"{output}/comments/csv")
    return kept.select(
        F.col("id").cast("bigint").alias("event_id"), "author", "subreddit",
        F.col("score").cast("bigint").alias("score"),
    )


@query
def file_errors(spark, sf_dir):
    """Files that break off publish nothing and are reported, the others go on."""
    _, output = _run(spark, sf_dir, broken=("error",))
    family = F.regexp_replace("base_name", FAMILY, "").alias("name")
    done = live(spark, output, "stats/totals").groupBy(family).agg(F.sum("n_read").alias("n_read"))
    failed = spark.read.parquet(f"{output}/errors").select(family, F.lit(0).cast("bigint").alias("n_read"))
    return done.unionByName(failed.distinct())


@query
def incremental_files(spark, sf_dir):
    """Two deliveries of files, three calls: each file is processed once."""
    root, output, checkpoint = (work_dir(spark, n) for n in ("arrivals", "output", "progress"))
    lines = b.comment_lines(spark, sf_dir)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for delivery in (0, 1, None):
        if delivery is not None:
            lines.where(half == delivery).select("line").write.mode("append").text(f"{root}/comments")
        stream_dataset(spark, root, output, checkpoint, *_event_lists(spark), pattern="*.txt", csv=False)
    groups = spark.read.parquet(f"{output}/stats/by_group")
    return groups.groupBy("subreddit").agg(
        F.sum("n_all").alias("n_all"), F.sum("n_topic").alias("n_topic"), F.sum("n_kept").alias("n_kept")
    )


@query
def zst_frames(spark, sf_dir):
    """Files of many frames, divided among tasks at their frames, lines across the seams."""
    root = work_dir(spark, "zst-frames")
    b.write_zst(_named(b.comment_lines(spark, sf_dir), "comments"), root, frame_rows=100)
    files = _files(spark, root, "comments")
    parsed = parse(read_zst(spark, files, split_bytes=8_192), ["id", "subreddit", "author"], stripped=True)
    return parsed.where(F.col("record").isNotNull()).select(
        F.col("record.id").cast("bigint").alias("event_id"),
        F.lower("record.subreddit").alias("event_type"),
        F.lower("record.author").alias("author"),
    )


def _family(rows):
    return rows.withColumn("name", F.regexp_replace("base_name", FAMILY, ""))


@query
def reclean_replaces(spark, sf_dir):
    """All files cleaned, then cleaned again with a list under which most keep nothing: no result of the first is left."""
    root, output = _run(spark, sf_dir)
    paths = [p for p, _ in _files(spark, root, "comments")]
    process_files(spark, "comments", paths, output, word_list(spark, ["CLICK"]), _event_lists(spark)[1])
    everything = {
        "parquet": live(spark, output, "comments/parquet").withColumn("n", F.lit(1)),
        "csv": live(spark, output, "comments/csv", read_csv(spark, f"{output}/comments/csv")).withColumn("n", F.lit(1)),
        "totals": live(spark, output, "stats/totals").withColumn("n", F.col("n_written")),
        "audit": live(spark, output, "stats/null_audit").where("col = 'score'").withColumn("n", F.col("nulls_after")),
        "rejected": live(spark, output, "rejected").withColumn("n", F.lit(1)),
    }
    parts = [
        _family(rows).groupBy("name").agg(F.sum("n").cast("bigint").alias("n")).select(F.lit(what).alias("what"), "name", "n")
        for what, rows in everything.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def rejected_values(spark, sf_dir):
    """Raw values that could not be converted, as a run has set them aside while writing."""
    _, output = _run(spark, sf_dir)
    found = live(spark, output, "rejected")
    return found.select(F.col("id").cast("bigint").alias("event_id"), "col", "value")


@query
def incremental_errors(spark, sf_dir):
    """Two deliveries with files that break off and files with a window of 2^31: the good ones are published, later
    calls go on, and a run over the tree finds only the bad ones left."""
    root, output, checkpoint = (work_dir(spark, n) for n in ("arrivals", "output", "progress"))
    lines, lists = b.comment_lines(spark, sf_dir), _event_lists(spark)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for delivery in (0, 1, None):
        if delivery is not None:
            b.write_zst(_named(lines.where(half == delivery), "comments"), root, broken=("error",), wide=("click",))
        stream_dataset(spark, root, output, checkpoint, *lists, csv=False)
    left = pending_files(spark, root, output)
    done = _family(live(spark, output, "stats/totals")).groupBy("name").agg(F.sum("n_read").alias("n_read"))
    return done.unionByName(_family(left).select("name", F.lit(0).cast("bigint").alias("n_read")).distinct())


@query
def dedup_incremental(spark, sf_dir):
    """Documents in two deliveries, the second one twice: it drops what the first has, and nothing for its own sake."""
    documents, index = b.table(spark, sf_dir, "documents"), work_dir(spark, "key-index")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = None
    for delivery in (0, 1, 1):
        rows = documents.where(F.col("doc_id") % 2 == delivery).select("doc_id", "source", "text")
        found = drop_seen(rows, "text", index, f"delivery-{delivery}", ["doc_id"], buckets)
        found = found.select("doc_id", "source", F.lit(delivery).alias("delivery"))
        out = found if out is None else out.unionAll(found)
    return out


@query
def dup_named_key(spark, sf_dir):
    """Keys and lists in columns whose names the operators use themselves."""
    rows = b.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("key"), F.col("source").alias("item"), F.lit(1).alias("n"), F.lit(2).alias("repeated_key")
    )
    found = duplicate_rows(rows, "key", long_keys=True)
    return keep_members(found, text.key_of("item"), word_list(spark, b.TOPICS_DOCUMENTS)).select("doc_id", "item", "n")


@query
def json_typed(spark, sf_dir):
    """A nested field that is a string, in words that read like numbers, arrays or booleans, keeps its quotes."""
    variants = [F.lit(v) for v in ('"0"', '"12"', '"[x"', '"false"', '""', "0", '[1, "b"]', '{"a": 1, "a": 2}', '"{}"', '"plain"')]
    field = F.element_at(F.array(*variants), (F.col("event_id") % len(variants) + 1).cast("int"))
    lines = b.comment_lines(spark, sf_dir)
    whole = F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(',"awarders": '), field, F.lit("}"))
    lines = lines.withColumn("line", F.when(F.col("line").endswith("}"), whole).otherwise(F.col("line")))
    kept = clean(lines, COMMENTS, *_event_lists(spark)).kept
    return kept.select(F.col("id").cast("bigint").alias("event_id"), "awarders")


def _comparable(kept):
    """Timestamps without a zone, as the other side has them."""
    names = [name for name, dtype in kept.dtypes if dtype == "timestamp"]
    return kept.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


@query
def clean_comments_all(spark, sf_dir):
    """All 49 columns."""
    return _comparable(_clean_events(spark, sf_dir, by=()).kept)


@query
def clean_submissions_all(spark, sf_dir):
    """All 46 columns."""
    return _comparable(clean(b.document_lines(spark, sf_dir), SUBMISSIONS, *_document_lists(spark)).kept)


@query
def csv_split(spark, sf_dir):
    """Documents, line ends and quotes included, as CSV files that are each read by many tasks."""
    path = work_dir(spark, "csv-split")
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    write_csv(documents, path, by=())
    return read_csv_blocks(spark, path, "doc_id bigint, text string, lang string, source string", block_bytes=1 << 18)
