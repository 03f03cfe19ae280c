"""Bureau queries: credits with balances, lookup, search, summary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.columns import select_existing
from lendspark.operators.joins import narrowed
from lendspark.operators.ordering import page
from lendspark.sources.schemas import CREDIT_COLUMNS, CREDIT_SCHEMA

# Status that counts as active, page size limits and default.
ACTIVE = "Active"
PAGE_DEFAULT, PAGE_MAX = 100, 1000


def credit_balances(bki: DataFrame, balance: DataFrame) -> DataFrame:
    """Credits with each of their monthly balances; credits without any drop out."""
    return bki.join(balance, "reco_bureau_id", "inner").select(
        *select_existing(bki, CREDIT_COLUMNS).columns, "months_balance", "stat_for_bureau"
    )


def answer_schema(credits: DataFrame) -> DataFrame:
    """Fixed answer columns and types; both ids must be present, columns may be absent."""
    present = set(credits.columns)
    return credits.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CREDIT_SCHEMA
        )
    ).where(F.col("reco_id_curr").isNotNull() & F.col("reco_bureau_id").isNotNull())


def answer_order(df: DataFrame) -> list[Column]:
    """Ids ascending with nulls last, newest balance first with nulls first.

    The remaining columns break ties so that pages never overlap.
    """
    lead = [
        F.col("reco_id_curr").asc_nulls_last(),
        F.col("reco_bureau_id").asc_nulls_last(),
        F.col("months_balance").desc_nulls_first(),
    ]
    named = {"reco_id_curr", "reco_bureau_id", "months_balance"}
    return lead + [F.col(c).asc_nulls_last() for c in df.columns if c not in named]


def lookup(bki: DataFrame, balance: DataFrame, reco_id_curr: int) -> DataFrame:
    """Credits and balances of one application. The ids reach the scans of both tables."""
    credits = bki.where(F.col("reco_id_curr") == F.lit(reco_id_curr))
    rows = credit_balances(credits, narrowed(balance, credits, "reco_bureau_id"))
    return rows.orderBy(*answer_order(rows))


@dataclass(frozen=True)
class Search:
    """Optional filters; an unset one, or an empty text, filters nothing."""

    reco_id_curr: int | None = None
    credit_status: str | None = None
    credit_type: str | None = None
    min_credit_sum: float | None = None
    max_credit_sum: float | None = None
    has_overdue: bool | None = None

    def predicate(self) -> Column:
        overdue = F.col("credit_day_overdue")
        wanted = F.lit(True)
        if self.reco_id_curr is not None:
            wanted &= F.col("reco_id_curr") == F.lit(self.reco_id_curr)
        for name in ("credit_status", "credit_type"):
            if getattr(self, name):
                wanted &= F.col(name) == F.lit(getattr(self, name))
        if self.min_credit_sum is not None:
            wanted &= F.col("credit_sum") >= F.lit(self.min_credit_sum)
        if self.max_credit_sum is not None:
            wanted &= F.col("credit_sum") <= F.lit(self.max_credit_sum)
        if self.has_overdue is not None:
            wanted &= (overdue > 0) if self.has_overdue else ((overdue == 0) | overdue.isNull())
        return wanted


def search(bki: DataFrame, balance: DataFrame, filters: Search) -> DataFrame:
    """All matches, unordered; every filter is on ``bki`` and applies before the join."""
    return credit_balances(bki.where(filters.predicate()), balance)


def search_page(
    bki: DataFrame,
    balance: DataFrame,
    filters: Search,
    limit: int = PAGE_DEFAULT,
    offset: int = 0,
) -> DataFrame:
    """One page of the matches in answer order."""
    if not 1 <= limit <= PAGE_MAX:
        raise ValueError(f"limit must lie in 1..{PAGE_MAX}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    rows = search(bki, balance, filters)
    return page(rows, answer_order(rows), limit, offset)


def summary(bki: DataFrame) -> DataFrame:
    """Totals per application over its credits, with or without balances.

    Rows fold to one per (application, credit) first: that turns the three distinct
    counts into plain counts, and spreads an application with very many rows.
    """
    overdue = F.col("credit_day_overdue")
    per_credit = bki.groupBy("reco_id_curr", "reco_bureau_id").agg(
        F.max((F.col("credit_status") == ACTIVE).cast("int")).alias("active"),
        F.max((overdue > 0).cast("int")).alias("late"),
        F.sum("credit_sum").alias("credit_sum"),
        F.sum("credit_sum_debt").alias("debt"),
        F.sum("credit_sum_overdue").alias("overdue"),
        F.sum(overdue).alias("days"),
        F.count(overdue).alias("days_n"),
        F.max(overdue).alias("days_max"),
    )
    credit = F.col("reco_bureau_id")
    return per_credit.groupBy("reco_id_curr").agg(
        F.count(credit).alias("total_credits"),
        F.count(F.when(F.col("active") == 1, credit)).alias("active_credits"),
        F.sum("credit_sum").alias("total_credit_sum"),
        F.sum("debt").alias("total_debt"),
        F.sum("overdue").alias("total_overdue"),
        F.try_divide(F.sum("days").cast("double"), F.sum("days_n")).alias("avg_days_overdue"),
        F.max("days_max").alias("max_days_overdue"),
        F.count(F.when(F.col("late") == 1, credit)).alias("credits_with_overdue"),
    )


def summary_of(bki: DataFrame, reco_id_curr: int) -> DataFrame:
    """``summary`` of one application."""
    return summary(bki.where(F.col("reco_id_curr") == F.lit(reco_id_curr)))
