"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with its check where SQL can express it."""
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return df.select(
        *(
            F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n)
            for n, t in df.dtypes
        )
    )
