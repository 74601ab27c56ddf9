"""The batch job (inventory CMP-5): read, clean, label, report, write and train.

    spark-submit --py-files moodloom.zip moodloom/plans/job.py \\
        --input tweets/*.csv --text-column text --output labeled --train

``--source FORMAT PATH COLUMN`` adds sources of other formats or columns; it may be repeated.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from moodloom.functions import rules
from moodloom.operators.classifier import train_and_evaluate
from moodloom.operators.cleaning import clean_tweets
from moodloom.operators.explore import cleaning_funnel, sentiment_distribution, top_keywords
from moodloom.operators.labeling import label_sentiment
from moodloom.sources.readers import TEXT, input_bytes, merge_sources, read_source, read_text
from moodloom.sources.sinks import metric_lines, preview, write_labeled, write_plain_csv
from moodloom.sources.staging import stage

# Input per partition: small enough to aggregate in memory next to other tasks.
PARTITION_BYTES = 128 * 1024 * 1024
# Beyond this many partitions they grow instead, because a shuffle has one block per pair of tasks.
MAX_PARTITIONS = 50_000


def parser() -> argparse.ArgumentParser:
    job = argparse.ArgumentParser(description="Sentiment of a text collection, on Spark.")
    job.add_argument("--input", nargs="+", default=[], help="CSV paths or globs with a header row")
    job.add_argument("--text-column", default="text", help="text column of --input")
    job.add_argument(
        "--source",
        nargs=3,
        action="append",
        default=[],
        metavar=("FORMAT", "PATH", "COLUMN"),
        help="one more source: csv, json or parquet",
    )
    job.add_argument(
        "--single-line",
        action="store_true",
        help="no CSV field has a line feed, so that large files may be split",
    )
    job.add_argument(
        "--same-header",
        action="store_true",
        help="CSV files under one path share their header, so that not every file is looked at first",
    )
    job.add_argument("--lexicon", help="Parquet table: word, polarity and/or intensity; the built-in one has about 70 English words, which leave most texts Neutral")
    job.add_argument("--positive-threshold", type=float, default=rules.POSITIVE_ABOVE)
    job.add_argument("--negative-threshold", type=float, default=rules.NEGATIVE_BELOW)
    job.add_argument("--output", help="where to write the labeled texts, replacing what is there")
    job.add_argument("--output-format", choices=("csv", "parquet"), default="csv")
    job.add_argument("--plain-output", help="where to write the labeled texts as CSV without a header, if nothing is there yet")
    job.add_argument("--train", action="store_true", help="fit and evaluate the classifier")
    job.add_argument("--num-features", type=int, default=rules.HASHED_FEATURES)
    job.add_argument("--model-output", help="where to save the fitted classifier")
    job.add_argument("--funnel", action="store_true", help="print the rows per cleaning stage")
    job.add_argument("--keywords", type=int, default=0, metavar="K", help="print the top K keywords")
    job.add_argument("--preview", type=int, default=0, metavar="N", help="print N labeled rows")
    job.add_argument("--schema", action="store_true", help="print the schemas of the sources and of the labeled texts")
    return job


def read_sources(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    sources = [("csv", args.input, args.text_column)] if args.input else []
    frames = []
    for fmt, path, column in [*sources, *args.source]:
        if args.schema:
            print(f"{fmt} {path}:")
            read_source(spark, path, fmt, multi_line=not args.single_line, per_file=not args.same_header).printSchema()
        frames.append(
            read_text(spark, path, fmt, column, multi_line=not args.single_line, per_file=not args.same_header)
        )
    return merge_sources(*frames)


def size_shuffles(spark: SparkSession, args: argparse.Namespace) -> None:
    """Enough shuffle partitions for the input; AQE merges them where they come out small."""
    size = input_bytes(spark, [*args.input, *(path for _, path, _ in args.source)])
    wanted = min(size // PARTITION_BYTES + 1, MAX_PARTITIONS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
    if size > MAX_PARTITIONS * PARTITION_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size // MAX_PARTITIONS)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, float]:
    """The job on an open session; returns the metrics, empty without ``--train``."""
    size_shuffles(spark, args)
    raw = read_sources(spark, args)
    if args.funnel:
        preview(cleaning_funnel(raw, TEXT))
    labeled = label_sentiment(
        clean_tweets(raw, TEXT),
        lexicon=spark.read.parquet(args.lexicon) if args.lexicon else None,
        positive_threshold=args.positive_threshold,
        negative_threshold=args.negative_threshold,
    )
    # Written once in a columnar form; every report, sink and fit below reads that.
    if args.output and args.output_format == "parquet":
        write_labeled(labeled, args.output, "parquet")
        labeled = spark.read.schema(labeled.schema).parquet(args.output)
    else:
        labeled = stage(labeled, "labeled")
    if args.schema:
        labeled.printSchema()
    preview(sentiment_distribution(labeled))
    if args.preview:
        preview(labeled, args.preview)
    if args.keywords:
        preview(top_keywords(labeled, k=args.keywords), args.keywords)
    if args.output and args.output_format == "csv":
        write_labeled(labeled, args.output)
    if args.plain_output:
        write_plain_csv(labeled, args.plain_output)
    if not args.train:
        return {}
    model, metrics = train_and_evaluate(labeled, num_features=args.num_features, staged=True)
    print(*metric_lines(metrics), sep="\n")
    if args.model_output:
        model.write().overwrite().save(args.model_output)
    return metrics


def main(argv: Sequence[str] | None = None) -> None:
    job = parser()
    args = job.parse_args(argv)
    if not args.input and not args.source:
        job.error("name at least one --input or --source")
    spark = SparkSession.builder.appName("Text sentiment").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
