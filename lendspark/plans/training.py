"""The wide training set: applications, bureau credits and prior loans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.functions.columns import non_null_counts, select_existing
from lendspark.operators.enrich import BUREAU_CREDIT_COLUMNS
from lendspark.operators.joins import enforced_unique, key_join
from lendspark.operators.key_sketch import KeySketch, sketches
from lendspark.sources.lake import write_snapshot
from lendspark.sources.relational import JdbcSource, optional_source
from lendspark.sources.schemas import APPLICATION_COLUMNS

# How far back loans and monthly balances count.
RECENT_DECISION_DAYS = -365
RECENT_MONTHS = (-3, 0)

# Columns taken from each table, in order, and their output names.
PREVIOUS_LOAN_COLUMNS = {
    "contract_type_name": "prev_contract_type_name",
    "annuity_payment": "prev_annuity_payment",
    "loan_body_requested": "loan_body_requested",
    "loan_body": "prev_loan_body",
    "first_payment": "first_payment",
    "goods_price": "prev_goods_price",
    "start_weekday_appr_process": "prev_start_weekday",
    "hour_of_approval_process_start": "prev_hour_approval",
    "last_application_per_contract_flag": "last_application_per_contract_flag",
    "last_day_app_f": "last_day_app_f",
    "down_payment_rate": "down_payment_rate",
    "interest_primary_rate": "interest_primary_rate",
    "interest_privileged_rate": "interest_privileged_rate",
    "cash_loan_purpose_name": "cash_loan_purpose_name",
    "contract_status_name": "prev_contract_status",
    "days_decision": "days_decision",
    "payment_type_name": "payment_type_name",
    "reject_reason_code": "reject_reason_code",
    "type_suite_name": "prev_type_suite_name",
    "client_type_name": "client_type_name",
    "goods_category_name": "goods_category_name",
    "portfolio_name": "portfolio_name",
    "product_type_name": "product_type_name",
    "channel_type": "channel_type",
    "area_seller_place": "area_seller_place",
    "seller_industry_name": "seller_industry_name",
    "payment_count": "payment_count",
    "yield_group_name": "yield_group_name",
    "combination_of_product": "combination_of_product",
    "days_first_drawing": "days_first_drawing",
    "days_first_due": "days_first_due",
    "first_due_date": "first_due_date",
    "last_due_date": "last_due_date",
    "termination_date": "termination_date",
    "insured_last_f": "insured_last_f",
}
CASH_POS_COLUMNS = {
    "months_balance": "cashpos_months_balance",
    "installment_count": "installment_count",
    "installment_future_count": "installment_future_count",
    "contract_status_name": "cashpos_contract_status_name",
    "reco_dpd": "cashpos_reco_dpd",
    "reco_dpd_def": "cashpos_reco_dpd_def",
}
CREDIT_CARD_COLUMNS = {
    "months_balance": "cc_months_balance",
    "balance": "balance",
    "credit_limit": "credit_limit",
    "drawings_atm": "drawings_atm",
    "drawings": "drawings",
    "drawings_other": "drawings_other",
    "drawings_pos": "drawings_pos",
    "minimal_payment": "minimal_payment",
    "payment_now": "payment_now",
    "payment_total_now": "payment_total_now",
    "receivable_principal": "receivable_principal",
    "receivable": "receivable",
    "total_receivable": "total_receivable",
    "drawings_atm_count": "drawings_atm_count",
    "drawings_count": "drawings_count",
    "drawings_other_count": "drawings_other_count",
    "drawings_pos_count": "drawings_pos_count",
    "installment_mature_cum_count": "installment_mature_cum_count",
    "contract_status_name": "cc_contract_status_name",
    "reco_dpd": "cc_reco_dpd",
    "reco_dpd_def": "cc_reco_dpd_def",
}
INSTALLMENT_COLUMNS = {
    "number_of_instalment_ver": "number_of_instalment_ver",
    "number_of_instalment_num": "number_of_instalment_num",
    "installment_due_date": "installment_due_date",
    "days_entry_payment": "days_entry_payment",
    "first_payment_requested": "first_payment_requested",
    "payment": "actual_payment",
}

IDS = ("reco_id_last", "reco_id_curr")

# One column of each prior-loan table that tells whether it contributed.
COVERAGE_COLUMNS = "reco_id_last cashpos_months_balance cc_months_balance number_of_instalment_ver".split()


def _project(df: DataFrame, columns: dict[str, str], tag: str | None = None) -> DataFrame:
    """Listed columns that exist, under their output names, and both ids."""
    names = {a: b for a, b in columns.items() if a in df.columns}
    if tag is None:
        ids = list(IDS)
    else:
        # The join keeps its key once, so hold a copy to coalesce from.
        ids = [
            F.col("reco_id_last"),
            F.col("reco_id_last").alias(f"{tag}_last"),
            F.col("reco_id_curr").alias(f"{tag}_curr"),
        ]
    return df.select(*ids, *(F.col(a).alias(b) for a, b in names.items()))


@dataclass(frozen=True)
class PriorLoans:
    """The four relational tables about earlier loans."""

    previous_loan: DataFrame
    cash_pos_balance: DataFrame
    credit_card_balance: DataFrame
    installments_payments: DataFrame


def recent_loans(previous_loan: DataFrame) -> DataFrame:
    return previous_loan.where(F.col("days_decision") >= RECENT_DECISION_DAYS)


def recent_balances(balance: DataFrame) -> DataFrame:
    return balance.where(F.col("months_balance").between(*RECENT_MONTHS))


def children(tables: PriorLoans) -> tuple[tuple[str, DataFrame, dict[str, str]], ...]:
    """Tables that hang off a loan. Their month ranges belong to the join, so they filter
    the table beforehand: a loan without a recent balance stays."""
    return (
        ("_cpb", recent_balances(tables.cash_pos_balance), CASH_POS_COLUMNS),
        ("_ccb", recent_balances(tables.credit_card_balance), CREDIT_CARD_COLUMNS),
        ("_ip", tables.installments_payments, INSTALLMENT_COLUMNS),
    )


def prior_key_tables(tables: PriorLoans) -> dict[str, tuple[DataFrame, str]]:
    """The tables and keys whose sketches ``prior_loans_wide`` and the joins after it use."""
    loans = recent_loans(tables.previous_loan)
    keyed = {"loan": (loans, "reco_id_last"), "owner": (loans, "reco_id_curr")}
    return keyed | {tag: (child, "reco_id_last") for tag, child, _ in children(tables)}


def prior_loans_wide(tables: PriorLoans, known: dict[str, KeySketch] | None = None) -> DataFrame:
    """Recent loans with recent balances and all installments, one row per combination.

    ``known`` holds the sketches of ``prior_key_tables`` where they have been taken.
    """
    known = known or sketches(prior_key_tables(tables))
    wide, rows = _project(recent_loans(tables.previous_loan), PREVIOUS_LOAN_COLUMNS), known["loan"]
    for tag, child, columns in children(tables):
        wide = key_join(
            wide, _project(child, columns, tag), "reco_id_last", "left",
            left_sketch=rows, right_sketch=known[tag],
        )
        rows = rows.joined(known[tag])
    tags = [tag for tag, _, _ in children(tables)]
    merged = {
        f"reco_id_{end}": F.coalesce(f"reco_id_{end}", *(f"{t}_{end}" for t in tags))
        for end in ("last", "curr")
    }
    helpers = {f"{t}_{end}" for t in tags for end in ("last", "curr")}
    rest = [c for c in wide.columns if c not in helpers and c not in merged]
    return wide.select(*(c.alias(n) for n, c in merged.items()), *rest)


def prior_sketch(known: dict[str, KeySketch], tables: PriorLoans) -> KeySketch:
    """Estimate of the rows of ``prior_loans_wide`` per application."""
    loan = known["loan"]
    for tag, _, _ in children(tables):
        loan = loan.joined(known[tag])
    return known["owner"].times(loan.heavy.max())


def applications_with_credits(
    applications: DataFrame,
    credits: DataFrame,
    validate: bool = True,
    credit_sketch: KeySketch | None = None,
) -> DataFrame:
    """Applications with their credit rows; each application must occur once.

    A repeated application is an error when the rows are read, unless ``validate`` is off.
    Columns of the credits that applications also have get the ending ``_bureau``.
    """
    if validate:
        # Also spreads the applications in the partitioning of the joins that multiply them.
        applications = enforced_unique(applications, "reco_id_curr")
    shared = (set(applications.columns) & set(credits.columns)) - {"reco_id_curr"}
    credits = credits.withColumnsRenamed({c: f"{c}_bureau" for c in shared})
    return key_join(
        applications, credits, "reco_id_curr", "left",
        left_sketch=KeySketch.of_unique() if validate else None, right_sketch=credit_sketch,
    )


def training_set(
    applications: DataFrame,
    credits: DataFrame,
    prior: PriorLoans | None = None,
    validate: bool = True,
) -> DataFrame:
    """Applications x credits x prior loans, columns in their fixed order.

    Listed columns that a source lacks are skipped; without prior loans their columns are.
    All tables are sketched in one pass over their keys before they are joined.
    """
    applications = select_existing(applications, APPLICATION_COLUMNS)
    credits = select_existing(credits, BUREAU_CREDIT_COLUMNS)
    tables = {"credits": (credits, "reco_id_curr")}
    if not validate:
        tables["applications"] = (applications, "reco_id_curr")
    if prior is not None:
        tables |= prior_key_tables(prior)
    known = sketches(tables)
    joined = applications_with_credits(applications, credits, validate, known["credits"])
    order = APPLICATION_COLUMNS + [c for c in BUREAU_CREDIT_COLUMNS if c != "reco_id_curr"]
    if prior is not None:
        loans = prior_loans_wide(prior, known)
        order = order + [c for c in loans.columns if c != "reco_id_curr"]
        shared = (set(joined.columns) & set(loans.columns)) - {"reco_id_curr"}
        loans = loans.withColumnsRenamed({c: f"{c}_prev" for c in shared})
        per_application = known.get("applications", KeySketch.of_unique()).joined(known["credits"])
        joined = key_join(
            joined, loans, "reco_id_curr", "left",
            left_sketch=per_application, right_sketch=prior_sketch(known, prior),
        )
    return select_existing(joined, order)


def source_coverage(training: DataFrame) -> DataFrame:
    """How many rows each prior-loan table reaches."""
    return non_null_counts(training, [c for c in COVERAGE_COLUMNS if c in training.columns])


def training_summary(
    training: DataFrame, exported_at: Column, date_column: str = "processing_date_app"
) -> DataFrame:
    """Report of (metric, value) lines over a training set.

    Rows fold to one per application first, which turns three distinct counts into plain
    ones.
    """
    has_date = date_column in training.columns
    day = F.col(date_column) if has_date else F.lit(None).cast("date")
    per_application = training.groupBy("reco_id_curr").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("reco_bureau_id").alias("credits"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )
    return summary_lines(per_application, len(training.columns), has_date, exported_at)


def summary_lines(
    per_application: DataFrame, n_columns: int, has_date: bool, exported_at: Column
) -> DataFrame:
    """The report over one line per application: its rows, those with a credit, and its days."""
    key = F.col("reco_id_curr")
    totals = per_application.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(key).alias("applications"),
        F.count(F.when(F.col("credits") > 0, key)).alias("with_credits"),
        F.count(F.when(F.col("credits") < F.col("rows"), key)).alias("without_credits"),
        F.coalesce(F.sum("credits"), F.lit(0)).alias("credits"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    dates = F.concat_ws(" to ", F.col("first_day").cast("string"), F.col("last_day").cast("string"))

    def grouped(name: str) -> Column:
        return F.format_number(F.col(name), 0)

    # Report lines; counts show thousands separators.
    lines = {
        "Total Rows": grouped("rows"),
        "Total Columns": F.lit(n_columns),
        "Total Applications": grouped("applications"),
        "Applications with Bureau Data": grouped("with_credits"),
        "Applications without Bureau Data": grouped("without_credits"),
        "Total Bureau Credits": grouped("credits"),
        "Date Range (Processing Date)": dates if has_date else F.lit("N/A"),
        "Export Timestamp": F.date_format(exported_at, "yyyy-MM-dd HH:mm:ss"),
    }
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("metric"), value.cast("string").alias("value"))
            for name, value in lines.items()
        )
    )
    return totals.select(F.inline(pairs))


def read_prior_loans(
    spark: SparkSession, source: JdbcSource, lower: int, upper: int, partitions: int
) -> PriorLoans:
    """The four tables from a database, each in parallel slices of the loan id."""
    return PriorLoans(
        **{
            f.name: source.table(spark, f.name, "reco_id_last", lower, upper, partitions)
            for f in fields(PriorLoans)
        }
    )


def write_training_snapshot(
    applications: DataFrame,
    credits: DataFrame,
    load_prior: Callable[[], PriorLoans],
    folder: str,
    at: datetime,
    compression: str = "snappy",
    require_prior: bool = False,
) -> str:
    """Build the training set and write it; where it is.

    Prior loans are optional unless required: when their source is not there, the set
    lacks their columns.
    """
    prior = load_prior() if require_prior else optional_source(load_prior, "prior loans")
    return write_snapshot(training_set(applications, credits, prior), folder, at, compression)
