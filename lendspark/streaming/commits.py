"""What readers of the landed tables see: finished batches, and their compacted runs.

A batch writes its folder of every table and then its line of the progress table. The line
commits it: a batch without one is invisible. Compaction rewrites committed batches into a run
laid out by year, month and day, and then a line of the manifest that names them; readers
take manifested runs, and the folders of the committed batches that no run holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendspark.sources.lake import DATE_PARTS, union_frames, write_partitioned
from lendspark.sources.listing import exists, names_in
from lendspark.streaming.ingest import LakeTables
from lendspark.streaming.progress import PROGRESS_DDL, progress_rows

TABLES = ("applications", "bureau_credits", "deletes")
KEYS = ("query_id", "batch_id")
# Rows that a task of a compaction takes, whatever they are in bytes once compressed.
TASK_ROWS = 500_000
MANIFEST_DDL = "run BIGINT, query_id STRING, batch_id BIGINT"


def _manifest(tables: LakeTables) -> str:
    return f"{tables.compacted}/manifest"


def _run(tables: LakeTables, name: str, run: int) -> str:
    return f"{tables.compacted}/{name}/run={run}"


def committed(spark: SparkSession, tables: LakeTables) -> DataFrame:
    """Batches that all tables have finished, with their row counts."""
    if not exists(spark, tables.progress):
        return spark.createDataFrame([], PROGRESS_DDL)
    return progress_rows(spark, tables.progress)


def compacted(spark: SparkSession, tables: LakeTables) -> DataFrame:
    """(run, query_id, batch_id) of the batches that compacted runs hold."""
    if not exists(spark, _manifest(tables)):
        return spark.createDataFrame([], MANIFEST_DDL)
    return spark.read.schema(MANIFEST_DDL).parquet(_manifest(tables))


def open_batches(spark: SparkSession, tables: LakeTables) -> DataFrame:
    """Committed batches that no run holds; regular compaction keeps them few."""
    return committed(spark, tables).join(compacted(spark, tables), list(KEYS), "left_anti")


def _folders(spark: SparkSession, root: str, batches: list) -> list[str]:
    paths = (f"{root}/query_id={b.query_id}/batch_id={b.batch_id}" for b in batches)
    return [p for p in paths if exists(spark, p)]


def scan_committed(
    spark: SparkSession, tables: LakeTables, name: str, schema: StructType | str | None = None
) -> DataFrame:
    """Rows of a landed table (``applications``, ``bureau_credits`` or ``deletes``) in committed batches.

    Only folders that the progress table and the manifest name are listed and read. Without
    a schema it is taken from the newest folder's files, not merged from all of them; a
    table without a row has no columns then. Fields that only older folders have need a schema.
    """
    root = getattr(tables, name)
    runs = sorted(r.run for r in compacted(spark, tables).select("run").distinct().collect())
    batches = open_batches(spark, tables).orderBy("at", *KEYS).select(*KEYS).collect()
    parts = [
        (f"{tables.compacted}/{name}", [p for p in (_run(tables, name, r) for r in runs) if exists(spark, p)]),
        (root, _folders(spark, root, batches)),
    ]
    parts = [(base, folders) for base, folders in parts if folders]
    if not parts:
        return spark.createDataFrame([], schema or StructType([]))
    if schema is None:
        schema = StructType()
        for base, folders in reversed(parts):
            # The newest folder with a row; a folder without one holds no file.
            newest = next((f for f in reversed(folders) if names_in(spark, f)), None)
            fields = spark.read.option("basePath", base).parquet(newest).schema.fields if newest else []
            known = set(schema.names)
            schema = StructType([*schema.fields, *(f for f in fields if f.name not in known)])
    frames = []
    for base, folders in parts:
        frame = spark.read.option("basePath", base).schema(schema).parquet(*folders)
        frames.append(frame.drop("run", *KEYS))
    return union_frames(*frames)


def _ranges(rows: DataFrame, task_rows: int) -> DataFrame:
    """Rows in ranges of their day and key, so that few files a day hold about ``task_rows`` each.

    The footers tell the number of rows. By bytes alone a task would take very many rows of
    a few bytes, and sort them by day in memory.
    """
    order = [c for c in (*DATE_PARTS, "reco_id_curr", "reco_bureau_id", "kafka_offset") if c in rows.columns]
    return rows.repartitionByRange(max(1, -(-rows.count() // task_rows)), *order)


def compact(spark: SparkSession, tables: LakeTables, task_rows: int = TASK_ROWS) -> int | None:
    """Rewrite the open batches as one more run by year, month and day; its number, None without any.

    Repeating it after a failure replaces the unfinished run. The batches' own folders stay
    for readers that began before.
    """
    batches = open_batches(spark, tables).orderBy("at", *KEYS).select(*KEYS).collect()
    if not batches:
        return None
    last = compacted(spark, tables).agg(F.max("run")).first()[0]
    run = 1 if last is None else last + 1
    for name in TABLES:
        folders = [f for f in _folders(spark, getattr(tables, name), batches) if names_in(spark, f)]
        if folders:
            rows = spark.read.option("basePath", getattr(tables, name)).option("mergeSchema", True)
            ranged = _ranges(rows.parquet(*folders).drop(*KEYS), task_rows)
            write_partitioned(ranged, _run(tables, name, run), mode="overwrite", rebalance=False)
    lines = spark.createDataFrame([(run, b.query_id, b.batch_id) for b in batches], MANIFEST_DDL)
    # One file per run: it appears whole or not at all.
    lines.coalesce(1).write.mode("overwrite").parquet(f"{_manifest(tables)}/part={run}")
    return run
