"""Jobs: ``python -m lendspark <job>``, or this file as the application of spark-submit.

Storage credentials come from the Spark configuration of the deployment, and the database
user, password and driver from its keys ``spark.lendspark.jdbc.user``, ``.password`` and
``.driver``.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from lendspark.operators.enrich import bureau_credits
from lendspark.operators.split import split_csv
from lendspark.plans.training import read_prior_loans, write_training_snapshot
from lendspark.session import build_session
from lendspark.sources.keyed import BUCKETS, KeyedTable, write_keyed
from lendspark.sources.listing import exists
from lendspark.sources.relational import JdbcSource
from lendspark.sources.streams import BrokerSource, read_broker
from lendspark.streaming import commits, state
from lendspark.streaming.ingest import TRIGGER, LakeTables, start_ingest
from lendspark.streaming.progress import watch


def _bureau_table(spark: SparkSession, path: str) -> DataFrame | KeyedTable:
    """A bureau table as the layout job leaves it, or plain Parquet."""
    return KeyedTable.at(spark, path) if exists(spark, f"{path.rstrip('/')}.layout") else spark.read.parquet(path)


def _whole(spark: SparkSession, path: str) -> DataFrame:
    table = _bureau_table(spark, path)
    return table.read(spark) if isinstance(table, KeyedTable) else table


def _layout(spark: SparkSession, args: argparse.Namespace) -> None:
    """A bureau table in buckets of its key, so that ingest batches read few files."""
    write_keyed(spark.read.parquet(args.input), args.out, args.key, args.buckets)


def _compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Committed batches of the lake as one more run by year, month and day."""
    print(commits.compact(spark, LakeTables.under(args.lake)))


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Change topic to the two lake tables until stopped."""
    query = start_ingest(
        read_broker(
            spark,
            BrokerSource(
                args.servers, args.topic, args.starting_offsets, args.max_offsets,
                args.fail_on_data_loss == "true",
            ),
        ),
        _bureau_table(spark, args.bki),
        _bureau_table(spark, args.balance),
        LakeTables.under(args.lake),
        {"processingTime": args.every},
    )
    watch(query)


def _training(spark: SparkSession, args: argparse.Namespace) -> None:
    """Training snapshot of the latest version of every application that is not deleted.

    Brings the kept state up to date with the batches landed since the last run first.
    """
    tables = LakeTables.under(args.lake)
    state.refresh(spark, tables)
    applications = state.current(spark, tables.state)
    # The landed credits repeat with every version of an application; take them afresh.
    credits = bureau_credits(
        applications, _whole(spark, args.bki), _whole(spark, args.balance)
    )
    keys = {name: f"spark.lendspark.jdbc.{name}" for name in ("user", "password", "driver")}
    configured = {name: spark.conf.get(key, None) for name, key in keys.items()}
    prior = JdbcSource(args.jdbc_url, {name: v for name, v in configured.items() if v is not None})
    target = write_training_snapshot(
        applications,
        credits,
        lambda: read_prior_loans(spark, prior, 0, args.largest_loan_id, args.slices),
        args.out,
        datetime.now(timezone.utc),
        require_prior=args.require_prior == "true",
    )
    print(target)


def _split(spark: SparkSession, args: argparse.Namespace) -> None:
    """CSV table to training and simulation parts."""
    split_csv(
        spark, args.input, args.out, args.label, args.ids.split(","), args.ratio, args.seed, args.schema or None
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lendspark")
    jobs = top.add_subparsers(required=True)

    def job(name, run, **options):
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.set_defaults(run=run)
        for option, default in options.items():
            flag = "--" + option.replace("_", "-")
            if default is None:
                sub.add_argument(flag, required=True)
            elif default in ("true", "false"):
                sub.add_argument(flag, default=default, choices=("true", "false"))
            else:
                sub.add_argument(flag, default=default, type=type(default))

    job(
        "ingest", _ingest, servers=None, topic=None, bki=None, balance=None, lake=None, every=TRIGGER,
        starting_offsets="latest", max_offsets=50, fail_on_data_loss="true",
    )
    job(
        "training", _training, lake=None, bki=None, balance=None, jdbc_url=None, out=None,
        largest_loan_id=1_000_000_000, slices=64, require_prior="false",
    )
    job("split", _split, input=None, out=None, label=None, ids=None, ratio=0.9, seed=42, schema="")
    job("layout", _layout, input=None, out=None, key=None, buckets=BUCKETS)
    job("compact", _compact, lake=None)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
