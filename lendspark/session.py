"""Spark session set-up and the shared folder that jobs may write to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "lendspark", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with the settings the jobs rely on.

    Shuffle width, executor sizes and storage credentials are deployment matters: pass
    them in ``conf`` or on the submit command line.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Salted joins need one more exchange than the plain plan would; let AQE still
        # split what is left.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the session's warehouse, which is shared as well. The
    default warehouse of a cluster's driver lies on its own disk, though, and is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"executors do not share {warehouse}: name a shared folder in spark.checkpoint.dir")
    return f"{warehouse}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; keeps a folder that is already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
