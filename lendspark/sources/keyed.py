"""Tables kept in hash buckets of a key, so that a few keys read a few files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lendspark.operators.joins import PUSHED_KEYS, narrowed
from lendspark.sources.text import read_json, write_json

BUCKET = "key_bucket"
BUCKETS = 256
"""Default number of buckets; a bucket should stay within a few gigabytes."""


def bucket_of(df: DataFrame, key: str, buckets: int) -> Column:
    """Bucket of a row; the same for equal whole numbers of any width. Null has the first."""
    value = F.col(key)
    if isinstance(df.schema[key].dataType, IntegralType):
        value = value.cast("bigint")
    return F.when(value.isNull(), 0).otherwise(F.pmod(F.xxhash64(value), F.lit(buckets))).cast("int")


@dataclass(frozen=True)
class KeyedTable:
    """A table written by ``write_keyed``."""

    path: str
    key: str
    buckets: int

    @staticmethod
    def at(spark: SparkSession, path: str) -> KeyedTable:
        facts = read_json(spark, f"{path.rstrip('/')}.layout", "key STRING, buckets INT").first()
        return KeyedTable(path.rstrip("/"), facts.key, facts.buckets)

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table."""
        return spark.read.parquet(self.path).drop(BUCKET)

    def of_keys(self, rows: DataFrame, key: str, pushed_keys: int = PUSHED_KEYS) -> DataFrame:
        """Rows whose key occurs in column ``key`` of ``rows``.

        The keys' buckets become literals, which prune the table's folders. A few keys
        become literals too, which the files' bloom filters and statistics meet; more keys
        join the rows of their buckets. At most ``pushed_keys`` keys and the bucket numbers
        reach the driver. Null matches nothing.
        """
        spark = rows.sparkSession
        keys = rows.select(F.col(key).alias(self.key)).where(F.col(key).isNotNull()).distinct()
        placed = keys.withColumn(BUCKET, bucket_of(keys, self.key, self.buckets))
        some = placed.limit(pushed_keys + 1).collect()
        table = spark.read.parquet(self.path)
        if len(some) <= pushed_keys:
            touched = sorted({r[BUCKET] for r in some})
            chosen = table.where(F.col(BUCKET).isin(touched) & F.col(self.key).isin([r[self.key] for r in some]))
        else:
            touched = sorted(r[BUCKET] for r in placed.select(BUCKET).distinct().collect())
            if len(touched) < self.buckets:
                table = table.where(F.col(BUCKET).isin(touched))
            chosen = table.join(keys, self.key, "left_semi")
        return chosen.drop(BUCKET)


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> KeyedTable:
    """Write a table in buckets of ``key``, sorted by it inside each file, with bloom filters of it.

    The rebalance hint splits a bucket that one key fills into several files.
    """
    path = path.rstrip("/")
    placed = df.withColumn(BUCKET, bucket_of(df, key, buckets)).hint("rebalance", BUCKET)
    writer = placed.sortWithinPartitions(BUCKET, key).write.mode("overwrite").partitionBy(BUCKET)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)
    layout = df.sparkSession.range(1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets"))
    write_json(layout.coalesce(1), f"{path}.layout")
    return KeyedTable(path, key, buckets)


def rows_of(table: DataFrame | KeyedTable, rows: DataFrame, key: str) -> DataFrame:
    """Rows of a table, laid out by ``key`` or not, whose key occurs in ``rows``."""
    if isinstance(table, KeyedTable) and table.key == key:
        return table.of_keys(rows, key)
    if isinstance(table, KeyedTable):
        table = table.read(rows.sparkSession)
    return narrowed(table, rows, key)
