"""Progress of streaming queries as rows."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS_DDL = (
    "query_id STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT, applications BIGINT, "
    "credits BIGINT"
)


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every batch with input that the ingest finished, from its progress table.

    The table keeps all batches of all restarts. Before the first one it does not exist,
    and reading it fails.
    """
    return spark.read.schema(PROGRESS_DDL).parquet(path)


def watch(query: StreamingQuery, report=print, every_seconds: float = 10.0) -> None:
    """Report new batches while the query runs; an interrupt stops the query."""
    last = None
    try:
        while query.isActive:
            query.awaitTermination(every_seconds)
            progress = query.lastProgress
            if progress and progress["numInputRows"] > 0 and progress["batchId"] != last:
                last = progress["batchId"]
                report(f"batch {last}: {progress['numInputRows']} rows at {time.ctime()}")
    except KeyboardInterrupt:
        query.stop()
