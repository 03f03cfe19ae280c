"""Change stream to the two lake tables, safe to replay."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lendspark.functions.columns import share_of
from lendspark.functions.lookup import quality_score
from lendspark.operators.cdc import (
    EVENT_COLUMNS,
    KEPT_OPERATIONS,
    RECORD_COLUMNS,
    heads,
    keep_row_events,
    parse_events,
    with_heads,
)
from lendspark.operators.enrich import lookup_counts, repeated_credits, with_outcome
from lendspark.operators.joins import key_counts
from lendspark.sources.keyed import KeyedTable, rows_of
from lendspark.sources.lake import DATE_PARTS, with_date_parts, write_partitioned

log = logging.getLogger(__name__)

# Trigger interval and the columns of the two batch previews.
TRIGGER = "120 seconds"
APPLICATION_PREVIEW = [
    "reco_id_curr", "target", "income", "bureau_count", "bureau_api_status",
    "bureau_api_response_time_ms",
]
CREDIT_PREVIEW = [
    "reco_id_curr", "reco_bureau_id", "credit_sum", "credit_currency", "credit_status",
    "days_credit",
]
PREVIEW_ROWS = 5

# Records of a batch that a task takes, as they lie in the exchange.
BATCH_TASK_BYTES = "16m"
# Credits that a task lands; there are many for each record.
CREDIT_TASK_ROWS = 4_000_000
# Applications of a batch whose counts, 16 bytes each, every executor may hold.
BROADCAST_KEYS = 1_000_000


@dataclass(frozen=True)
class LakeTables:
    """Roots of the landed tables, what is made of them, and the checkpoint."""

    applications: str
    bureau_credits: str
    checkpoint: str
    progress: str
    deletes: str
    compacted: str
    state: str

    @staticmethod
    def under(root: str) -> LakeTables:
        root = root.rstrip("/")
        names = ("applications", "bureau_credits", "checkpoint", "progress", "deletes", "compacted", "state")
        return LakeTables(*(f"{root}/{name}" for name in names))


@dataclass(frozen=True)
class BatchReport:
    """What one batch landed."""

    batch_id: int
    applications: int
    credits: int

    @property
    def ratio(self) -> float:
        return self.credits / self.applications if self.applications else 0.0


def _stamped(df: DataFrame, at: Column) -> DataFrame:
    stamped = df.withColumns({"processing_timestamp": at, "processing_date": at.cast("date")})
    return with_date_parts(stamped, "processing_date")


def land_applications(enriched: DataFrame, at: Column) -> DataFrame:
    """Enriched applications as rows of the landed table."""
    return _stamped(enriched, at).withColumn(
        "data_quality_score", quality_score(F.col("bureau_api_status"))
    )


def land_credits(credits: DataFrame, at: Column) -> DataFrame:
    """Credits as rows of the landed table."""
    return _stamped(credits, at)


def preview(df: DataFrame, columns: list[str], rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first few rows of some columns."""
    return df.select(*(c for c in columns if c in df.columns)).limit(rows)


def _write(df: DataFrame, path: str) -> None:
    """Replace one batch folder. A batch has one processing date."""
    write_partitioned(df, path, mode="overwrite", rebalance=False)


def _write_at(df: DataFrame, path: str, at: Column) -> None:
    """``_write`` of rows that are all stamped ``at``, straight into the folder of that day.

    A partitioned write would work out the folder of each row, and copy the row without its
    date parts.
    """
    stamp = with_date_parts(df.sparkSession.range(1).select(at.cast("date").alias("date")), "date")
    day = stamp.select(*DATE_PARTS).first()
    if None in day:
        return _write(df, path)
    # Nothing of an earlier run stays, not even of another day.
    _write(df.limit(0), path)
    folder = "/".join(f"{part}={n}" for part, n in zip(DATE_PARTS, day, strict=True))
    df.drop(*DATE_PARTS).write.mode("overwrite").parquet(f"{path}/{folder}")


def _write_progress(
    spark: SparkSession, path: str, at: Column, input_rows: int, landed: tuple[int, int] | None
) -> None:
    """The batch's own line of the progress table; written last, so it marks a finished batch."""
    applications, credits = landed or (0, 0)
    counts = {"input_rows": input_rows, "applications": applications, "credits": credits}
    line = spark.range(1).select(at.alias("at"), *(F.lit(n).cast("long").alias(c) for c, n in counts.items()))
    line.coalesce(1).write.mode("overwrite").parquet(path)


@contextmanager
def sized_caches(spark: SparkSession) -> Iterator[None]:
    """Frames persisted inside get as many partitions as their size asks for, not the shuffle's number."""
    settings = {
        "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": BATCH_TASK_BYTES,
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def spread(records: DataFrame) -> DataFrame:
    """Broker records dealt out by their place in the topic.

    As they come, a topic partition or a file's row group is one task, however large.
    """
    return records.repartition("topic", "partition", "offset")


def of_batch(
    batch: DataFrame, bki: DataFrame | KeyedTable, balance: DataFrame | KeyedTable
) -> tuple[DataFrame, DataFrame]:
    """Both bureau tables narrowed to the applications of a batch.

    Tables laid out by their key, applications' ids and credits' ids, are read in the
    buckets that the batch touches.
    """
    known = rows_of(bki, batch, "reco_id_curr").persist(StorageLevel.MEMORY_AND_DISK)
    return known, rows_of(balance, known, "reco_bureau_id").persist(StorageLevel.MEMORY_AND_DISK)


def land_batch(
    batch: DataFrame,
    folder: str,
    bki: DataFrame | KeyedTable,
    balance: DataFrame | KeyedTable,
    tables: LakeTables,
    at: Column,
    keys: DataFrame | None = None,
) -> tuple[int, int] | None:
    """Land row events in ``folder`` of both tables; their row counts, or None if empty.

    Running it again replaces what it wrote. Each bureau table is read once, in the part
    that the batch needs. The batch is read twice, for its keys and for its rows; ``keys``,
    if given, are the same events for the former, without the fields of their row images. The
    rows stay in place while the lookups' counts are few enough to go to every executor.
    """
    counts = key_counts(batch if keys is None else keys, "reco_id_curr")
    held = [counts]
    try:
        with sized_caches(batch.sparkSession):
            counts.persist(StorageLevel.MEMORY_AND_DISK)
            n_keys, n_events = counts.agg(F.count(F.lit(1)), F.sum("rows")).first()
            if not n_events:
                return None
            known, months = of_batch(counts, bki, balance)
            held += [known, months]
            found = lookup_counts(known, months).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(found)
        few = n_keys <= BROADCAST_KEYS
        due = counts.join(found, "reco_id_curr").agg(F.sum(F.col("rows") * F.col("found"))).first()[0] or 0
        tasks = max(1, -(-due // CREDIT_TASK_ROWS))
        credits = land_credits(repeated_credits(counts, known, months, tasks, broadcast=few), at)
        credits_folder = f"{tables.bureau_credits}/{folder}"
        if due:
            _write_at(credits, credits_folder, at)
        else:
            _write(credits, credits_folder)
        # Parquet footers tell how many rows there are; a batch may have none.
        n_credits = batch.sparkSession.read.schema(credits.schema).parquet(credits_folder).count()
        outcome = with_outcome(batch, F.broadcast(found) if few else found, F.unix_millis(at))
        applications = land_applications(outcome, at)
        _write_at(applications, f"{tables.applications}/{folder}", at)
        return n_events, n_credits
    finally:
        for frame in held:
            frame.unpersist()


def tombstones(events: DataFrame) -> DataFrame:
    """Key and event columns of the deletes, without a row image."""
    gone = F.col("cdc_operation").isNotNull() & ~F.col("cdc_operation").isin(*KEPT_OPERATIONS)
    return events.where(gone).select("reco_id_curr", *EVENT_COLUMNS)


def land_tombstones(events: DataFrame, folder: str, tables: LakeTables, at: Column) -> None:
    """Land the deletes of a batch; running it again replaces them."""
    _write_at(_stamped(tombstones(events), at), f"{tables.deletes}/{folder}", at)


def start_ingest(
    records: DataFrame,
    bki: DataFrame | KeyedTable,
    balance: DataFrame | KeyedTable,
    tables: LakeTables,
    trigger: dict | None = None,
    at: Column | None = None,
    on_batch: Callable[[BatchReport], None] | None = None,
) -> StreamingQuery:
    """Parse, enrich and land broker records.

    Each batch owns the folder ``<table>/query_id=<id>/batch_id=<n>``, so a replay after a
    failure, even on another day, leaves no duplicates. Its line of the progress table
    commits it, see ``streaming.commits``. ``trigger`` takes the keywords of
    ``DataStreamWriter.trigger``. ``at`` is a constant processing time; by default each
    batch takes the time of its start, the same for all tables.

    A batch is cached as its records with their heads; row images, wide and mostly empty, are
    parsed once, where they are landed, and those of other events not at all.
    """
    def land(taken: DataFrame, batch_id: int) -> None:
        query_id = taken.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        folder = f"query_id={query_id}/batch_id={batch_id}"
        started = F.lit(datetime.now(timezone.utc)) if at is None else at
        with sized_caches(taken.sparkSession):
            batch = with_heads(spread(taken)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            deleted = F.count(F.when(~F.col("cdc_operation").isin(*KEPT_OPERATIONS), 1))
            input_rows, n_deleted = batch.agg(F.count(F.lit(1)), deleted).first()
            kept = keep_row_events(batch)
            rows = parse_events(kept.select(*RECORD_COLUMNS))
            landed = land_batch(rows, folder, bki, balance, tables, started, kept)
            if n_deleted:
                land_tombstones(heads(batch), folder, tables, started)
        finally:
            batch.unpersist()
        if input_rows:
            _write_progress(batch.sparkSession, f"{tables.progress}/{folder}", started, input_rows, landed)
        if landed is None:
            return
        report = BatchReport(batch_id, *landed)
        log.info("%s: %.2f credits per application", report, report.ratio)
        if on_batch is not None:
            on_batch(report)

    return (
        records.writeStream.foreachBatch(land)
        .option("checkpointLocation", tables.checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .start()
    )


def batch_summary(applications: DataFrame, credits: DataFrame) -> DataFrame:
    """Landed rows per batch and credits per application, from the landed tables."""
    keys = ("query_id", "batch_id")
    apps = applications.groupBy(*keys).agg(F.count(F.lit(1)).alias("applications"))
    rows = credits.groupBy(*keys).agg(F.count(F.lit(1)).alias("credits"))
    found = F.coalesce("credits", F.lit(0))
    return apps.join(rows, list(keys), "left").select(
        *keys,
        "applications",
        found.alias("credits"),
        share_of(found.cast("double"), F.col("applications")).alias("credits_per_application"),
    )
