"""The current state of every application, kept up to date from landed batches.

The state lies in hash buckets of the key. A refresh reads the batches committed since the
last one, rewrites the buckets that they touch, and then writes a manifest that says which
version of each bucket counts. Deleted keys stay as tombstones, so that an older event that
arrives late cannot revive them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.operators.cdc import KEPT_OPERATIONS, event_key
from lendspark.sources.lake import union_frames
from lendspark.sources.listing import exists, names_in
from lendspark.streaming.commits import KEYS, TABLES, committed
from lendspark.streaming.ingest import LakeTables

BUCKETS = 256
ORDER = ("cdc_timestamp_ms", "kafka_offset", "kafka_partition")
POSITION = ("kafka_topic", "kafka_partition", "kafka_offset")
MANIFEST_DDL = "bucket INT, version BIGINT, buckets INT"
COVERED_DDL = "query_id STRING, batch_id BIGINT"


def _version(spark: SparkSession, path: str) -> int:
    """Newest finished version of a state; 0 without one."""
    found = (name.partition("=")[2] for name in names_in(spark, f"{path}/manifest"))
    return max((int(n) for n in found if n.isdigit()), default=0)


def _bucket_versions(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    if not version:
        return {}
    rows = spark.read.schema(MANIFEST_DDL).parquet(f"{path}/manifest/version={version}").collect()
    return {r.bucket: r.version for r in rows}


def _covered(spark: SparkSession, path: str, version: int) -> DataFrame:
    if not version:
        return spark.createDataFrame([], COVERED_DDL)
    # Every version lists the batches that it took in.
    paths = [f"{path}/covered/version={v}" for v in range(1, version + 1)]
    return spark.read.schema(COVERED_DDL).parquet(*(p for p in paths if exists(spark, p)))


def _buckets(spark: SparkSession, path: str, versions: dict[int, int], chosen=None) -> DataFrame | None:
    paths = [
        f"{path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items()) if chosen is None or b in chosen
    ]
    if not paths:
        return None
    return spark.read.option("mergeSchema", True).parquet(*paths)


def folded(events: DataFrame) -> DataFrame:
    """The last event of every key, deletes included. Events without a key stay, each by itself.

    Rows carry ``state_key`` and, without a key, their position in the topic.
    """
    if "state_key" not in events.columns:
        events = events.withColumn("state_key", event_key())
    fields = [c for c in events.columns if c != "state_key"]
    unkeyed = F.when(F.col("state_key").isNull(), F.struct(*POSITION))
    latest = events.groupBy("state_key", unkeyed.alias("unkeyed")).agg(
        F.max_by(F.struct(*fields), F.struct(*ORDER)).alias("row")
    )
    return latest.select("state_key", "row.*")


def merge(spark: SparkSession, path: str, events: DataFrame, batches: list, buckets: int = BUCKETS) -> int:
    """A new version of the state at ``path`` that takes in ``events`` of the named batches.

    Reads and writes only the buckets that the events touch. The manifest is written last, so
    a failed merge leaves the state as it was, and the next one replaces its files.
    """
    path = path.rstrip("/")
    version = _version(spark, path)
    versions = _bucket_versions(spark, path, version)
    if versions:
        buckets = spark.read.schema(MANIFEST_DDL).parquet(f"{path}/manifest/version={version}").first().buckets
    place = F.coalesce(F.pmod(F.xxhash64("state_key"), F.lit(buckets)), F.lit(0))
    place = F.when(F.col("state_key").isNull(), F.pmod(F.xxhash64(*POSITION), F.lit(buckets))).otherwise(place)
    changes = folded(events).withColumn("bucket", place.cast("int"))
    touched = sorted(r.bucket for r in changes.select("bucket").distinct().collect())
    old = _buckets(spark, path, versions, set(touched))
    if old is not None:
        changes = union_frames(changes.drop("bucket"), old)
        changes = folded(changes).withColumn("bucket", place.cast("int"))
    version += 1
    data = f"{path}/data/version={version}"
    changes.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
    versions |= {b: version for b in touched}
    covered = spark.createDataFrame([(b.query_id, b.batch_id) for b in batches], COVERED_DDL)
    covered.coalesce(1).write.mode("overwrite").parquet(f"{path}/covered/version={version}")
    lines = spark.createDataFrame([(b, v, buckets) for b, v in sorted(versions.items())], MANIFEST_DDL)
    lines.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")
    return version


def refresh(spark: SparkSession, tables: LakeTables, buckets: int = BUCKETS) -> int:
    """Take the batches committed since the last refresh into the state; its version.

    Landed rows bring creates, reads and updates, landed tombstones the deletes.
    """
    version = _version(spark, tables.state)
    fresh = committed(spark, tables).join(_covered(spark, tables.state, version), list(KEYS), "left_anti")
    batches = fresh.orderBy("at", *KEYS).select(*KEYS).collect()
    if not batches:
        return version
    events = None
    for name in (t for t in TABLES if t != "bureau_credits"):
        root = getattr(tables, name)
        folders = [f"{root}/query_id={b.query_id}/batch_id={b.batch_id}" for b in batches]
        folders = [p for p in folders if names_in(spark, p)]
        if folders:
            rows = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*folders).drop(*KEYS)
            events = rows if events is None else union_frames(events, rows)
    if events is None:
        return version
    return merge(spark, tables.state, events, batches, buckets)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The latest row of every application that is not deleted."""
    path = path.rstrip("/")
    rows = _buckets(spark, path, _bucket_versions(spark, path, _version(spark, path)))
    if rows is None:
        raise ValueError(f"no state at {path}")
    return rows.where(F.col("cdc_operation").isin(*KEPT_OPERATIONS)).drop("state_key")
