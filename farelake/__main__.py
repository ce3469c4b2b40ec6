"""Command line of the jobs: ``spark-submit farelake/__main__.py JOB --help``."""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

from farelake import plans
from farelake.functions import dataset_name, month_path
from farelake.functions.months import COLORS
from farelake.operators.clean import PICKUP
from farelake.session import get_session
from farelake.sinks import FileWarehouse, JdbcWarehouse, Warehouse
from farelake.streaming import KafkaTopic
from farelake.streaming.topic import DEFAULT_BOOTSTRAP, DEFAULT_TOPIC


def _month(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="farelake")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *bases: str, publishes: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for base in bases:
            sub.add_argument(f"--{base}", required=True)
        sub.add_argument("--color", choices=COLORS, default="yellow")
        if publishes:
            sub.add_argument("--jdbc_url")
            sub.add_argument("--jdbc_user")
            sub.add_argument("--jdbc_password", default=os.environ.get("JDBC_PASSWORD"))
            sub.add_argument("--warehouse_base", help="Parquet tables instead of a database")
        return sub

    def with_topic(sub: argparse.ArgumentParser) -> argparse.ArgumentParser:
        sub.add_argument("--bootstrap", default=DEFAULT_BOOTSTRAP)
        sub.add_argument("--topic", default=DEFAULT_TOPIC)
        sub.add_argument("--startingOffsets", default="earliest")
        sub.add_argument("--endingOffsets", default="latest")
        sub.add_argument("--num_partitions", type=int, help="the first so many; default all")
        sub.add_argument("--min_tasks", type=int, help="split partitions into so many reads")
        sub.add_argument("--failOnDataLoss", action=argparse.BooleanOptionalAction, default=True)
        return sub

    def with_input(sub: argparse.ArgumentParser) -> argparse.ArgumentParser:
        sub.add_argument("--input", help="raw month; or give raw_base, year and month")
        sub.add_argument("--raw_base")
        sub.add_argument("--year", type=int)
        sub.add_argument("--month", type=int)
        return sub

    bronze = with_input(job("bronze", "one raw month to Bronze", "bronze_base"))
    bronze_all = job("bronze-all", "all raw months to Bronze", "raw_base", "bronze_base")
    silver = job("silver", "Bronze to Silver", "bronze_base", "silver_base")
    silver.add_argument("--pickup", default=PICKUP, help="column that dates a trip")
    compact = job("compact", "small files of Silver into larger ones", "silver_base")
    compact.add_argument("--target_mb", type=int, default=128, help="size a file is meant to have")
    gold = job("gold", "Silver to Gold and the warehouse", "silver_base", "gold_base", publishes=True)
    with_topic(job("topic-to-bronze", "all messages of a topic to Bronze", "bronze_base"))
    publish = with_topic(with_input(job("publish", "a raw month onto a topic")))
    publish.add_argument("--limit", type=int, help="only the first so many rows")
    dq = job("dq", "quality of a layer", publishes=True)
    dq.add_argument("--layer", choices=("silver", "bronze"), default="silver")
    dq.add_argument("--silver_base")
    dq.add_argument("--bronze_base")
    job("evaluate", "totals over Gold", "gold_base", publishes=True)
    job("zones", "zone CSV into the warehouse", "input", publishes=True)
    layers = ("bronze_base", "silver_base", "gold_base")
    batch = with_input(job("batch", "raw month to Gold", *layers, publishes=True))
    batch.add_argument("--pickup", default=PICKUP, help="column that dates a trip")
    states = with_input(
        job("states", "raw month to Gold by its state, without Silver", *layers[::2], publishes=True)
    )
    states.add_argument("--pickup", default=PICKUP, help="column that dates a trip")
    chain = with_topic(
        with_input(job("topic-batch", "raw month over a topic to Gold", *layers, publishes=True))
    )
    chain.add_argument("--limit", type=int, help="only the first so many rows")
    follow = with_topic(
        job("topic-follow", "what a topic has got since the last run to Gold", *layers, publishes=True)
    )
    follow.add_argument("--checkpoint", required=True, help="folder that remembers what was read")
    for sub in (gold, batch, chain, follow, states):
        sub.add_argument("--undated", type=_month, help="YYYY-MM to publish the null month under")
    for sub in (bronze, bronze_all, silver, publish, batch):
        sub.add_argument("--skip_corrupt", action="store_true", help="skip broken files")
    batch.add_argument("--rebuild", action="store_true", help="all months, not only those touched")
    job("evaluation", "dq, then evaluate", "silver_base", "gold_base", publishes=True)
    return parser


def _warehouse(args: argparse.Namespace) -> Warehouse:
    if args.warehouse_base:
        return FileWarehouse(args.warehouse_base)
    if not (args.jdbc_url and args.jdbc_user and args.jdbc_password):
        raise SystemExit("give --jdbc_url, --jdbc_user and --jdbc_password, or --warehouse_base")
    return JdbcWarehouse(args.jdbc_url, args.jdbc_user, args.jdbc_password)


def _topic(args: argparse.Namespace) -> KafkaTopic:
    return KafkaTopic(
        args.bootstrap,
        args.topic,
        args.num_partitions,
        args.startingOffsets,
        args.endingOffsets,
        args.failOnDataLoss,
        args.min_tasks,
    )


def _input(args: argparse.Namespace) -> str:
    if args.input:
        return args.input
    if not (args.raw_base and args.year and args.month):
        raise SystemExit("give --input, or --raw_base, --year and --month")
    return month_path(args.raw_base, args.color, args.year, args.month)


def run(spark: SparkSession, args: argparse.Namespace) -> object:
    """Run the job the arguments name; returns what the job returns."""
    dataset = dataset_name(args.color)
    match args.job:
        case "bronze":
            return plans.ingest_bronze(
                spark, _input(args), args.bronze_base, dataset, args.skip_corrupt
            )
        case "bronze-all":
            return plans.ingest_bronze_months(
                spark, args.raw_base, args.bronze_base, dataset, args.skip_corrupt
            )
        case "silver":
            return plans.build_silver(
                spark, args.bronze_base, args.silver_base, dataset, args.pickup, args.skip_corrupt
            )
        case "gold":
            return plans.build_gold(
                spark, args.silver_base, args.gold_base, _warehouse(args), dataset, args.undated
            )
        case "topic-to-bronze":
            return plans.ingest_topic(spark, _topic(args), args.bronze_base, f"{dataset}_topic")
        case "publish":
            return plans.publish_topic(
                spark, _input(args), _topic(args), args.limit, args.skip_corrupt
            )
        case "dq":
            score = {"silver": plans.score_silver, "bronze": plans.score_bronze}[args.layer]
            base = {"silver": args.silver_base, "bronze": args.bronze_base}[args.layer]
            if not base:
                raise SystemExit(f"give --{args.layer}_base")
            return score(spark, base, _warehouse(args), dataset)
        case "evaluate":
            return plans.evaluate_gold(spark, args.gold_base, _warehouse(args))
        case "zones":
            return plans.load_zone_lookup(spark, args.input, _warehouse(args))
        case "batch":
            return plans.run_batch(
                spark,
                _input(args),
                args.bronze_base,
                args.silver_base,
                args.gold_base,
                _warehouse(args),
                dataset,
                args.pickup,
                args.undated,
                args.skip_corrupt,
                args.rebuild,
            )
        case "topic-batch":
            return plans.run_topic_batch(
                spark,
                _input(args),
                _topic(args),
                args.bronze_base,
                args.silver_base,
                args.gold_base,
                _warehouse(args),
                f"{dataset}_topic",
                args.limit,
                args.undated,
            )
        case "compact":
            return plans.compact_silver(spark, args.silver_base, dataset, args.target_mb << 20)
        case "states":
            return plans.run_states(
                spark,
                _input(args),
                args.bronze_base,
                args.gold_base,
                _warehouse(args),
                dataset,
                args.pickup,
                args.undated,
            )
        case "topic-follow":
            return plans.follow_topic(
                spark,
                _topic(args),
                args.bronze_base,
                args.silver_base,
                args.gold_base,
                _warehouse(args),
                args.checkpoint,
                f"{dataset}_topic",
                args.undated,
            )
        case "evaluation":
            return plans.run_evaluation(
                spark, args.silver_base, args.gold_base, _warehouse(args), dataset
            )


def main(argv: list[str] | None = None) -> None:
    """Parse, run, report."""
    args = _parser().parse_args(argv)
    print(f"{args.job}: {run(get_session(f'farelake-{args.job}'), args) or 'done'}")


if __name__ == "__main__":
    main()
