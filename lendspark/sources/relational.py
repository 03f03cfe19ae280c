"""Relational sources: partitioned JDBC scans, views for SQL text, optional sources."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

T = TypeVar("T")


@dataclass(frozen=True)
class JdbcSource:
    """A database and how to split scans of it. Secrets come from the deployment."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def reader(self, spark: SparkSession):
        return (
            spark.read.format("jdbc")
            .option("url", self.url)
            .option("fetchsize", self.fetch_size)
            .options(**self.properties)
        )

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        """One statement, one connection: for results the database keeps small."""
        return self.reader(spark).option("query", sql).load()

    def table(
        self,
        spark: SparkSession,
        table: str,
        partition_column: str,
        lower: int,
        upper: int,
        partitions: int,
    ) -> DataFrame:
        """A whole table in parallel slices of an integer key.

        The bounds only place the slices; rows outside them are still read.
        """
        return (
            self.reader(spark)
            .option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
            .load()
        )


def run_sql(spark: SparkSession, sql: str, args=None, **tables: DataFrame) -> DataFrame:
    """SQL text over frames named ``{table}`` in it; ``args`` binds ``:name`` markers."""
    return spark.sql(sql, args=args, **tables)


# Conditions of Spark and classes of Java that say a source is not there.
ABSENT_CONDITIONS = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "DATA_SOURCE_NOT_FOUND")
ABSENT_CLASSES = ("java.sql.SQLException", "java.io.IOException", "java.lang.ClassNotFoundException")
# SQL states of this class mean that a login was refused.
REFUSED_LOGIN = "28"


def _is_absent(problem: Exception) -> bool:
    if isinstance(problem, PySparkException):
        return problem.getCondition() in ABSENT_CONDITIONS
    if not isinstance(problem, Py4JJavaError):
        return isinstance(problem, OSError)
    cause = problem.java_exception
    while cause is not None:
        kind = cause.getClass()
        while kind is not None:
            if kind.getName() == "java.sql.SQLException" and (cause.getSQLState() or "").startswith(REFUSED_LOGIN):
                return False
            if kind.getName() in ABSENT_CLASSES:
                return True
            kind = kind.getSuperclass()
        cause = cause.getCause()
    return False


def optional_source(load: Callable[[], T], name: str) -> T | None:
    """What ``load`` returns, or None with a warning when its source is not there.

    Missing paths and tables, a missing driver and a failed connection count as not there;
    a refused login and any other error are raised. Loading a relation reads its schema,
    not its data, so failures while data is read later are not hidden either.
    """
    try:
        return load()
    except (PySparkException, Py4JJavaError, OSError) as problem:
        if not _is_absent(problem):
            raise
        log.warning("continuing without %s: %s", name, problem)
        return None
