"""Column-list helpers: tolerant projection, unique names, selection by type."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The requested columns that exist, in requested order, each once."""
    present = set(df.columns)
    return df.select(*(c for c in dict.fromkeys(names) if c in present))


def keep_first_names(df: DataFrame) -> DataFrame:
    """Drop columns whose name an earlier column already has."""
    positions = {}
    for i, name in enumerate(df.columns):
        positions.setdefault(name, i)
    numbered = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return numbered.select(*(F.col(f"c{i}").alias(name) for name, i in positions.items()))


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def non_null_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """One row: how many values each column has."""
    return df.agg(*(F.count(F.col(c)).alias(c) for c in names))


def try_double(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Decimals that travel as text become doubles; text that is no number becomes null."""
    present = set(df.columns)
    return df.withColumns({c: F.col(c).try_cast("double") for c in names if c in present})


def share_of(part: Column, whole: Column) -> Column:
    """Ratio that is 0 for an empty whole."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
