"""Parquet lake tables partitioned by year, month and day."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DATE_PARTS = ("year", "month", "day")


def with_date_parts(df: DataFrame, day: Column | str) -> DataFrame:
    """Partition columns of a date."""
    day = F.col(day) if isinstance(day, str) else day
    return df.withColumns(
        {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = DATE_PARTS,
    mode: str = "append",
    rebalance: bool = True,
) -> None:
    """Partitioned Parquet write.

    The rebalance hint gathers small slices of a partition into few files and lets AQE
    split a partition value that holds far more rows than the others. Rows of a single
    partition value do not need it, nor the shuffle it costs.
    """
    if rebalance:
        df = df.hint("rebalance", *by)
    df.write.mode(mode).partitionBy(*by).parquet(path)


def scan_all(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """All partitions; ``skip_corrupt`` drops unreadable files instead of failing.

    Files are unioned by column name. Without a schema the file footers are merged, which
    is a pass over all of them; with one, columns a file lacks are simply null. Only
    ``*.parquet`` files count, and a root with no readable row is an error when files may
    be skipped.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet").option(
        "ignoreCorruptFiles", skip_corrupt
    )
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    df = reader.parquet(path)
    if skip_corrupt and df.isEmpty():
        raise ValueError(f"no readable data in {path}")
    return df


def scan_date(df: DataFrame, day: str | date) -> DataFrame:
    """Rows of one day, pruned to its partition."""
    if isinstance(day, str):
        day = datetime.strptime(day, "%Y-%m-%d").date()
    return df.where(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    )


def latest_date(df: DataFrame) -> date:
    """Newest partition. Compares numbers, so month 10 is after month 9."""
    newest = df.agg(F.max(F.struct(*DATE_PARTS)).alias("p")).first().p
    if newest is None:
        raise ValueError("table has no partitions")
    return date(newest.year, newest.month, newest.day)


def scan_latest(df: DataFrame) -> DataFrame:
    """Rows of the newest partition, found first so that the scan prunes to it."""
    return scan_date(df, latest_date(df))


def list_partitions(df: DataFrame) -> DataFrame:
    """Distinct partitions, newest first."""
    return (
        df.select(*DATE_PARTS)
        .distinct()
        .orderBy(*(F.col(c).desc() for c in DATE_PARTS))
    )


def file_inventory(df: DataFrame) -> DataFrame:
    """One row per data file with its size, row count and the date its path names."""
    path = F.col("file_path")
    part = {c: F.regexp_extract(path, rf"/{c}=(\d+)/", 1).try_cast("int") for c in DATE_PARTS}
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("file_path")
        .agg(F.max("file_size").alias("file_size"), F.count(F.lit(1)).alias("rows"))
        .select(
            "file_path",
            "file_size",
            "rows",
            *(part[c].alias(c) for c in DATE_PARTS),
            F.format_string(
                "year=%d/month=%d/day=%d", *(part[c] for c in DATE_PARTS)
            ).alias("partition_path"),
        )
    )


def snapshot_name(at: Column) -> Column:
    """Name of a snapshot written at a time."""
    return F.concat(F.lit("data_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit(".parquet"))


def write_snapshot(
    df: DataFrame, folder: str, at: datetime, compression: str = "snappy"
) -> str:
    """Unpartitioned snapshot; the folder of files takes the snapshot's name."""
    target = f"{folder.rstrip('/')}/data_{at:%Y%m%d_%H%M%S}.parquet"
    df.write.mode("overwrite").option("compression", compression).parquet(target)
    return target


def union_frames(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Rows of all frames, matched by column name; columns a frame lacks are null."""
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
