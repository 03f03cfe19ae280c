"""Reports on the training set from its parts, without building it.

A row of the training set is one of an application's credits with one combination of a
loan's balances and installments. So counts over it are products of counts per key: every
table folds to one line per key first, and no join repeats a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.columns import select_existing
from lendspark.operators.enrich import BUREAU_CREDIT_COLUMNS
from lendspark.plans.training import (
    COVERAGE_COLUMNS,
    PREVIOUS_LOAN_COLUMNS,
    PriorLoans,
    children,
    recent_loans,
    summary_lines,
)
from lendspark.sources.schemas import APPLICATION_COLUMNS


def _or_one(name: str) -> Column:
    return F.coalesce(name, F.lit(1))


def _value_column(columns: dict[str, str], df: DataFrame) -> str | None:
    """The table's column that tells whether it contributed, if it has it."""
    return next((a for a, b in columns.items() if b in COVERAGE_COLUMNS and a in df.columns), None)


def prior_loan_facts(tables: PriorLoans) -> DataFrame:
    """Per application: rows of ``prior_loans_wide`` and values of each coverage column in them.

    A loan without an application takes the one its children name, in their order, so its
    children fold per loan and application; those of other loans fold per loan.
    """
    loans = recent_loans(tables.previous_loan)
    facts = loans.groupBy("reco_id_last", "reco_id_curr").agg(F.count(F.lit(1)).alias("n"))
    facts = facts.withColumn("reco_id_last_n", F.when(F.col("reco_id_last").isNotNull(), F.col("n")).otherwise(0))
    names = ["reco_id_last"]
    for _, child, columns in children(tables):
        value = _value_column(columns, child)
        held = F.count(F.col(value)) if value else F.lit(0).cast("long")
        folded = child.groupBy("reco_id_last", F.col("reco_id_curr").alias("named")).agg(
            F.count(F.lit(1)).alias("found"), held.alias("held")
        )
        joined = facts.join(folded, "reco_id_last", "left")
        owner = F.coalesce("reco_id_curr", "named")
        own = columns[value] if value else None
        sums = {c: F.sum(F.col(f"{c}_n") * _or_one("found")) for c in names}
        if own:
            sums[own] = F.sum(F.col("n") * F.coalesce("held", F.lit(0)))
            names.append(own)
        # A loan of a known application may match several lines of a child; a missing match
        # counts once.
        facts = joined.groupBy("reco_id_last", owner.alias("reco_id_curr")).agg(
            F.sum(F.col("n") * _or_one("found")).alias("n"), *(c.alias(f"{name}_n") for name, c in sums.items())
        )
    return facts.groupBy("reco_id_curr").agg(
        F.sum("n").alias("prior_rows"), *(F.sum(f"{name}_n").alias(name) for name in names)
    )


def application_facts(
    applications: DataFrame,
    credits: DataFrame,
    prior: PriorLoans | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Per application: rows of the training set, those with a credit, coverage, first and last day."""
    day = F.col(date_column) if date_column else F.lit(None).cast("date")
    applied = applications.groupBy("reco_id_curr").agg(
        F.count(F.lit(1)).alias("applied"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    found = credits.groupBy("reco_id_curr").agg(
        F.count(F.lit(1)).alias("found"), F.count("reco_bureau_id").alias("identified")
    )
    facts = applied.join(found, "reco_id_curr", "left")
    rows, held = F.col("applied") * _or_one("found"), F.col("applied") * F.coalesce("identified", F.lit(0))
    if prior is None:
        return facts.select("reco_id_curr", rows.alias("rows"), held.alias("credits"), "first_day", "last_day")
    loans = prior_loan_facts(prior)
    names = [c for c in loans.columns if c not in ("reco_id_curr", "prior_rows")]
    return facts.join(loans, "reco_id_curr", "left").select(
        "reco_id_curr",
        (rows * _or_one("prior_rows")).alias("rows"),
        (held * _or_one("prior_rows")).alias("credits"),
        *((rows * F.coalesce(c, F.lit(0))).alias(c) for c in names),
        "first_day",
        "last_day",
    )


def source_coverage(applications: DataFrame, credits: DataFrame, prior: PriorLoans) -> DataFrame:
    """How many rows of the training set each prior-loan table reaches."""
    facts = application_facts(applications, credits, prior)
    names = [c for c in COVERAGE_COLUMNS if c in facts.columns]
    return facts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names))


def training_columns(applications: DataFrame, credits: DataFrame, prior: PriorLoans | None) -> list[str]:
    """Columns of the training set, from the tables' columns alone."""
    named = [*APPLICATION_COLUMNS, *(c for c in BUREAU_CREDIT_COLUMNS if c != "reco_id_curr")]
    there = set(select_existing(applications, named).columns) | set(select_existing(credits, named).columns)
    found = [c for c in dict.fromkeys(named) if c in there]
    if prior is not None:
        found.append("reco_id_last")
        listed = [(recent_loans(prior.previous_loan), PREVIOUS_LOAN_COLUMNS)]
        listed += [(child, columns) for _, child, columns in children(prior)]
        found += [b for df, columns in listed for a, b in columns.items() if a in df.columns]
    return found


def training_summary(
    applications: DataFrame,
    credits: DataFrame,
    prior: PriorLoans | None,
    exported_at: Column,
    date_column: str = "processing_date_app",
) -> DataFrame:
    """The report of ``training.training_summary`` over the set that these tables make."""
    columns = training_columns(applications, credits, prior)
    has_date = date_column in columns
    facts = application_facts(applications, credits, prior, date_column if has_date else None)
    return summary_lines(facts, len(columns), has_date, exported_at)
