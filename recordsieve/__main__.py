"""Jobs for spark-submit.

    clean ROOT OUTPUT TOPICS BOTS     all new files under ROOT/{comments,submissions}
    files KIND OUTPUT TOPICS BOTS PATH...        the given files of one kind
    stream ROOT OUTPUT TOPICS BOTS CHECKPOINT    what arrived since the last call
    duplicates CSV OUTPUT [--id-column ID]       report repeated ids of a CSV output
    deduplicate CSV OUTPUT [--id-column ID]      write the CSV again, one row per id
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from recordsieve.plans.dataset import MAX_BATCH_BYTES, process_files, run_dataset
from recordsieve.plans.duplicate_check import check_duplicates, remove_duplicates
from recordsieve.sources.files import read_word_list
from recordsieve.specs import SPECS
from recordsieve.streaming.incremental import stream_dataset


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("recordsieve", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    clean, stream = jobs.add_parser("clean"), jobs.add_parser("stream")
    for job in (clean, stream):
        job.add_argument("root")
    files = jobs.add_parser("files")
    files.add_argument("kind", choices=SPECS)
    for job in (clean, stream, files):
        for name in ("output", "topics", "bots"):
            job.add_argument(name)
        job.add_argument("--no-csv", action="store_true", help="write Parquet only")
        job.add_argument("--null-text", default="", help="what a missing text becomes")
    clean.add_argument("--max-batch-bytes", type=int, default=MAX_BATCH_BYTES)
    stream.add_argument("checkpoint")
    stream.add_argument("--max-files", type=int)
    files.add_argument("paths", nargs="+")
    for name in ("duplicates", "deduplicate"):
        job = jobs.add_parser(name)
        job.add_argument("csv")
        job.add_argument("output")
        job.add_argument("--id-column", default="id")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("recordsieve").getOrCreate()
    if args.job in ("duplicates", "deduplicate"):
        run = check_duplicates if args.job == "duplicates" else remove_duplicates
        run(spark, args.csv, args.output, args.id_column).show()
        return
    lists = read_word_list(spark, args.topics), read_word_list(spark, args.bots)
    options = {"csv": not args.no_csv, "null_text": args.null_text}
    if args.job == "clean":
        run_dataset(spark, args.root, args.output, *lists, max_batch_bytes=args.max_batch_bytes, **options)
    elif args.job == "stream":
        stream_dataset(spark, args.root, args.output, args.checkpoint, *lists, max_files=args.max_files, **options)
    else:
        process_files(spark, args.kind, args.paths, args.output, *lists, **options)


if __name__ == "__main__":
    main()
