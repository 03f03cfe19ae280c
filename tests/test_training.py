import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendspark.operators.enrich import BUREAU_CREDIT_COLUMNS
from lendspark.plans import training, training_facts
from lendspark.sources.schemas import APPLICATION_SCHEMA
from tests.oracle import plan_text

IDS = "reco_id_last INT, reco_id_curr INT"


@pytest.fixture(scope="module")
def prior(spark):
    return training.PriorLoans(
        previous_loan=spark.createDataFrame(
            [(1, 100, -365, 5.0), (2, 100, -366, 6.0), (3, 101, None, 7.0), (4, 102, -1, 8.0), (5, None, 0, 9.0)],
            IDS + ", days_decision INT, loan_body DOUBLE",
        ),
        cash_pos_balance=spark.createDataFrame(
            [(1, 100, -3, "a"), (1, 100, -4, "b"), (1, 100, 0, "c"), (1, 100, 1, "d"), (1, 100, None, "e"), (4, 102, -9, "f"), (5, 105, 0, "g")],
            IDS + ", months_balance INT, contract_status_name STRING",
        ),
        credit_card_balance=spark.createDataFrame(
            [(1, 100, -1, 1.5), (1, 100, -2, 2.5)], IDS + ", months_balance INT, balance DOUBLE"
        ),
        installments_payments=spark.createDataFrame(
            [(1, 100, 1, 10.0), (2, 100, 1, 20.0)], IDS + ", number_of_instalment_ver INT, payment DOUBLE"
        ),
    )


def test_prior_loans_fan_out_and_ranges(prior):
    rows = training.prior_loans_wide(prior).collect()
    per_loan = Counter(r.reco_id_last for r in rows)
    assert per_loan == {1: 2 * 2 * 1, 4: 1, 5: 1}
    assert {r.cashpos_months_balance for r in rows if r.reco_id_last == 1} == {-3, 0}
    four = next(r for r in rows if r.reco_id_last == 4)
    assert (four.cashpos_months_balance, four.cc_months_balance, four.actual_payment) == (None, None, None)
    assert four.prev_loan_body == 8.0
    # The application id of a loan without one comes from its children.
    assert next(r for r in rows if r.reco_id_last == 5).reco_id_curr == 105


def test_ranges_reach_the_scans(spark, tmp_path, prior):
    for name in ("previous_loan", "cash_pos_balance"):
        getattr(prior, name).write.parquet(str(tmp_path / name))
    stored = training.PriorLoans(
        spark.read.parquet(str(tmp_path / "previous_loan")),
        spark.read.parquet(str(tmp_path / "cash_pos_balance")),
        prior.credit_card_balance, prior.installments_payments,
    )
    plan = plan_text(training.prior_loans_wide(stored))
    assert "GreaterThanOrEqual(days_decision,-365)" in plan
    assert "GreaterThanOrEqual(months_balance,-3), LessThanOrEqual(months_balance,0)" in plan


def apps(spark, *rows):
    return spark.createDataFrame(list(rows), "reco_id_curr INT, income STRING, extra INT")


def credits(spark):
    return spark.createDataFrame(
        [(100, 10, 0, "x"), (100, 10, -1, "y"), (101, 20, 0, "z")],
        "reco_id_curr INT, reco_bureau_id INT, months_balance INT, extra STRING",
    )


def test_training_set_rows_and_columns(spark, prior):
    got = training.training_set(apps(spark, (100, "1", 0), (101, "2", 0), (103, "3", 0)), credits(spark), prior)
    rows = Counter(r.reco_id_curr for r in got.collect())
    assert rows == {100: 2 * 4, 101: 1, 103: 1}
    assert got.columns[:4] == ["reco_id_curr", "income", "reco_bureau_id", "months_balance"]
    assert got.columns[4] == "reco_id_last" and "extra" not in got.columns
    assert got.columns[-1] == "actual_payment"
    coverage = training.source_coverage(got).first()
    assert (coverage.reco_id_last, coverage.cashpos_months_balance) == (8, 8)


def test_training_set_without_prior(spark):
    got = training.training_set(apps(spark, (100, "1", 0)), credits(spark), None)
    assert got.columns == ["reco_id_curr", "income", "reco_bureau_id", "months_balance"]
    assert got.count() == 2


def test_repeated_application_is_refused(spark):
    twice = apps(spark, (100, "1", 0), (100, "2", 0))
    with pytest.raises(Exception, match="not unique"):
        training.training_set(twice, credits(spark)).collect()
    assert training.training_set(twice, credits(spark), validate=False).count() == 4


def test_overlapping_columns_get_an_ending(spark):
    joined = training.applications_with_credits(apps(spark, (100, "1", 5)), credits(spark))
    assert joined.columns == ["reco_id_curr", "income", "extra", "reco_bureau_id", "months_balance", "extra_bureau"]


def test_full_width(spark):
    def empty(listing):
        names = dict.fromkeys([*training.IDS, *listing])
        return spark.createDataFrame([], ", ".join(f"{n} STRING" for n in names)).withColumns(
            {c: F.col(c).cast("int") for c in names if c in ("months_balance", "days_decision")}
        )

    prior = training.PriorLoans(
        empty(training.PREVIOUS_LOAN_COLUMNS), empty(training.CASH_POS_COLUMNS),
        empty(training.CREDIT_CARD_COLUMNS), empty(training.INSTALLMENT_COLUMNS),
    )
    wide = training.prior_loans_wide(prior)
    assert len(wide.columns) == 70
    lake_credits = spark.createDataFrame([], ", ".join(f"{c} STRING" for c in BUREAU_CREDIT_COLUMNS))
    got = training.training_set(spark.createDataFrame([], APPLICATION_SCHEMA), lake_credits, prior)
    assert len(got.columns) == 209 == len(set(got.columns))


def test_summary(spark):
    t = training.training_set(apps(spark, (100, "1", 0), (103, "3", 0), (None, "4", 0)), credits(spark))
    lines = {r.metric: r.value for r in training.training_summary(t, F.lit("2025-01-01 00:00:00").cast("timestamp")).collect()}
    assert lines["Total Rows"] == "4" and lines["Total Applications"] == "2"
    assert lines["Applications with Bureau Data"] == "1"
    assert lines["Applications without Bureau Data"] == "1"
    assert lines["Total Bureau Credits"] == "2" and lines["Date Range (Processing Date)"] == "N/A"
    dated = t.withColumn("processing_date_app", F.lit("2025-03-01").cast("date"))
    lines = {r.metric: r.value for r in training.training_summary(dated, F.current_timestamp()).collect()}
    assert lines["Date Range (Processing Date)"] == "2025-03-01 to 2025-03-01"


def test_snapshot_with_and_without_prior(spark, tmp_path, prior):
    from datetime import datetime

    from lendspark.sources.relational import JdbcSource

    some = apps(spark, (100, "1", 0), (101, "2", 0))
    at = datetime(2025, 10, 28, 9, 30)
    full = training.write_training_snapshot(some, credits(spark), lambda: prior, str(tmp_path / "a"), at)
    assert full.endswith("data_20251028_093000.parquet")
    assert spark.read.parquet(full).count() == 9
    away = JdbcSource("jdbc:postgresql://db.invalid/x")
    bare = training.write_training_snapshot(
        some, credits(spark), lambda: training.read_prior_loans(spark, away, 0, 10, 2),
        str(tmp_path / "b"), at, "gzip",
    )
    assert spark.read.parquet(bare).columns == ["reco_id_curr", "income", "reco_bureau_id", "months_balance"]


def test_reports_without_the_joined_frame(spark, prior):
    """Counts from the parts equal those over the set, also where loans and children disagree."""
    shared = "reco_id_last INT, reco_id_curr INT"
    loans = [(i, o, -1, 1.0) for i, o in [(1, 100), (2, 100), (3, None), (4, 101), (4, 101), (None, 100), (6, 999)]]
    odd = training.PriorLoans(
        spark.createDataFrame(loans, shared + ", days_decision INT, loan_body DOUBLE"),
        spark.createDataFrame(
            [(1, 1, 0), (1, None, -1), (3, 100, 0), (3, 101, 0), (3, None, -2), (4, None, 0), (None, 100, 0)],
            shared + ", months_balance INT",
        ),
        spark.createDataFrame([(3, 101, 0), (3, 103, -1), (4, 7, -3), (4, 8, -3)], shared + ", months_balance INT"),
        spark.createDataFrame(
            [(1, 100, None), (1, 100, 2), (2, 100, None), (3, 100, 1)], shared + ", number_of_instalment_ver INT"
        ),
    )
    some = apps(spark, (100, "1", 0), (101, "2", 0), (103, "3", 0), (None, "4", 0), (104, "5", 0))
    held = credits(spark).unionByName(
        spark.createDataFrame([(103, None, 0, "x"), (100, None, 0, "y"), (None, 7, 0, "z"), (7, 8, 0, "w")], credits(spark).schema)
    )
    at = F.lit("2025-01-01 00:00:00").cast("timestamp")
    for loans in (prior, odd):
        joined = training.training_set(some, held, loans)
        assert training_facts.training_columns(some, held, loans) == joined.columns
        assert training_facts.source_coverage(some, held, loans).collect() == training.source_coverage(joined).collect()
        got = training_facts.training_summary(some, held, loans, at)
        assert got.collect() == training.training_summary(joined, at).collect()
    bare = training.training_set(some, held)
    assert training_facts.training_summary(some, held, None, at).collect() == training.training_summary(bare, at).collect()
    wide = training.prior_loans_wide(odd)
    want = {r.reco_id_curr: r["count"] for r in wide.groupBy("reco_id_curr").count().collect()}
    assert {r.reco_id_curr: r.prior_rows for r in training_facts.prior_loan_facts(odd).collect()} == want


def test_summary_dates_from_the_parts(spark, monkeypatch):
    dated = apps(spark, (100, "1", 0), (101, "2", 0)).withColumn(
        "processing_date_app", F.lit("2025-03-01").cast("date") + F.col("reco_id_curr") - 100
    )
    monkeypatch.setattr(training_facts, "APPLICATION_COLUMNS", ["reco_id_curr", "processing_date_app"])
    lines = training_facts.training_summary(dated, credits(spark), None, F.current_timestamp())
    assert {r.metric: r.value for r in lines.collect()}["Date Range (Processing Date)"] == "2025-03-01 to 2025-03-02"


def jobs_of(spark, build):
    """Jobs that building a frame runs."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "counted")
    try:
        frame = build()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return frame, context.statusTracker().getJobIdsForGroup(group)


def test_few_jobs_before_the_frame(spark, prior):
    some = apps(spark, (100, "1", 0), (101, "2", 0))
    _, jobs = jobs_of(spark, lambda: training.training_set(some, credits(spark), prior))
    assert len(jobs) < 8
    _, jobs = jobs_of(spark, lambda: training.prior_loans_wide(prior))
    assert len(jobs) < 4


def test_unique_check_shares_the_joins_exchange(spark, tmp_path):
    some, held = apps(spark, (100, "1", 0), (101, "2", 0)), credits(spark)
    some.write.parquet(str(tmp_path / "a"))
    held.write.parquet(str(tmp_path / "c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, c = (spark.read.parquet(str(tmp_path / n)) for n in "ac")
        plan = training.applications_with_credits(a, c)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_loans_and_applications(spark, prior, monkeypatch):
    from lendspark.operators import joins

    some = apps(spark, (100, "1", 0), (101, "2", 0), (103, "3", 0))
    plain = Counter(training.training_set(some, credits(spark), prior).collect())
    monkeypatch.setattr(joins.key_join, "__defaults__", (*joins.key_join.__defaults__[:2], 1, None, None))
    assert Counter(training.training_set(some, credits(spark), prior).collect()) == plain
