from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendspark.functions.lookup import quality_score
from lendspark.operators import enrich, joins
from lendspark.streaming import ingest
from tests.oracle import plan_text

BKI = "reco_id_curr INT, reco_bureau_id INT, credit_sum DOUBLE, annuity_payment DOUBLE"


@pytest.fixture(scope="module")
def apps(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "reco_id_curr INT, tag STRING")


@pytest.fixture(scope="module")
def bki(spark):
    return spark.createDataFrame(
        [(1, 10, 1.0, 0.5), (1, 11, 2.0, None), (2, 20, 3.0, None), (9, 90, 4.0, None)], BKI
    )


@pytest.fixture(scope="module")
def balance(spark):
    return spark.createDataFrame(
        [(10, -1, "C"), (10, 0, "C"), (10, None, "X"), (11, -2, "0"), (11, -2, "0"), (90, 0, "C")],
        "reco_bureau_id INT, months_balance INT, stat_for_bureau STRING",
    )


def test_outcome_per_application(apps, bki, balance):
    rows = {r.tag: r for r in enrich.enrich(apps, bki, balance, F.lit(99)).collect()}
    assert len(rows) == 5
    outcome = {
        t: (r.bureau_count, r.bureau_api_status, r.bureau_api_http_code, r.bureau_api_timestamp)
        for t, r in rows.items()
    }
    assert outcome == {
        "a": (5, "success", 200, 99), "b": (5, "success", 200, 99),
        "c": (0, "not_found", 404, 99),  # its only credit has no balances
        "d": (0, "not_found", 404, 99), "e": (0, "null_id", 0, 0),
    }
    assert rows["a"].bureau_api_response_time_ms == 0 and rows["a"].bureau_api_url is None


@pytest.mark.parametrize("max_items", [1, 2, 3, 100])
def test_arrays_hold_every_credit(apps, bki, balance, max_items):
    nested = enrich.enrich_with_arrays(apps, bki, balance, F.lit(99), max_items)
    exploded = enrich.explode_credits(nested)
    direct = enrich.bureau_credits(apps, bki, balance)
    assert exploded.columns == direct.columns
    assert Counter(map(tuple, exploded.collect())) == Counter(map(tuple, direct.collect()))
    rows = nested.collect()
    assert {r.tag for r in rows if r.bureau_credits == []} == {"c", "d", "e"}
    if max_items == 100:
        credits = next(r.bureau_credits for r in rows if r.tag == "a")
        assert [(c.reco_bureau_id, c.months_balance) for c in credits] == [
            (10, None), (10, 0), (10, -1), (11, -2), (11, -2),
        ]
    if max_items == 1:  # two equal rows are dealt to two pieces
        assert nested.where("tag = 'a'").select(F.max(F.size("bureau_credits"))).first()[0] <= 3


def test_only_large_applications_are_folded_by_whole_rows(spark, tmp_path):
    """Both kinds side by side, with equal rows and an unknown applicant; alone, small ones need no such table."""
    bki = spark.createDataFrame([(1, 10, 1.0, 0.5), (2, 20, 2.0, None), (None, 30, 3.0, None)], BKI)
    months = [(10, -m, "C") for m in range(3)] + [(20, -(m % 7), "0") for m in range(40)] + [(30, 0, "C")]
    balance = spark.createDataFrame(months, "reco_bureau_id INT, months_balance INT, stat_for_bureau STRING")
    rows = enrich.credit_arrays(bki, balance, 5).collect()
    got = Counter((r.reco_id_curr, c.reco_bureau_id, c.months_balance, c.stat_for_bureau) for r in rows for c in r.bureau_credits)
    assert got == Counter((b // 10, b, m, s) for b, m, s in months if b != 30)
    assert [r.part for r in rows if r.reco_id_curr == 1] == [0]
    assert max(len(r.bureau_credits) for r in rows) < 40

    bki.where("reco_id_curr = 1").write.parquet(str(tmp_path / "bki"))
    small = enrich.credit_arrays(spark.read.parquet(str(tmp_path / "bki")), balance, 5)
    assert len(small.collect()) == 1
    plan = small._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "final" in plan.lower()
    folds = [line for line in plan.splitlines() if "HashAggregate(keys=[reco_id_curr" in line and "credit_sum" in line.split("functions")[0]]
    assert folds == []


def test_annuity_is_renamed(apps, bki, balance):
    columns = enrich.bureau_credits(apps, bki, balance).columns
    assert "bureau_annuity_payment" in columns and "annuity_payment" not in columns


@pytest.mark.parametrize("pushed", [0, 1000])
def test_narrowing_keeps_the_result(apps, bki, balance, pushed):
    few = joins.narrowed(bki, apps, "reco_id_curr", pushed)
    assert {r.reco_id_curr for r in few.collect()} == {1, 2}
    a = enrich.enrich(apps, few, balance, F.lit(1)).collect()
    assert Counter(a) == Counter(enrich.enrich(apps, bki, balance, F.lit(1)).collect())


def test_small_batch_filters_the_bureau_scan(spark, tmp_path, apps, bki, balance):
    bki.write.parquet(str(tmp_path / "bki"))
    few, _ = ingest.of_batch(apps, spark.read.parquet(str(tmp_path / "bki")), balance)
    assert "PushedFilters: [In(reco_id_curr, [1,2,3])]" in plan_text(few)


def test_plan_has_no_python(apps, bki, balance):
    assert "EvalPython" not in plan_text(enrich.enrich(apps, bki, balance, F.lit(99)))


def test_quality_scores(spark):
    statuses = ["success", "not_found", "timeout", "http_error_500", "null_id", None]
    df = spark.createDataFrame([(s,) for s in statuses], "s STRING")
    got = [r.q for r in df.select(quality_score(F.col("s")).alias("q")).collect()]
    assert got == [100, 80, 0, 0, 0, 0]


@pytest.mark.parametrize("broadcast", [False, True])
def test_repeated_credits_are_the_joined_ones(spark, broadcast):
    bki = spark.createDataFrame(
        [(1, 10, 5.0), (1, 10, 5.0), (1, 11, None), (2, 20, 6.0), (None, 30, 7.0)],
        "reco_id_curr INT, reco_bureau_id INT, credit_sum DOUBLE",
    )
    balance = spark.createDataFrame(
        [(10, 0, "C"), (10, None, None), (11, 0, "X"), (20, 0, "C"), (20, 0, "C"), (30, 0, "C")],
        "reco_bureau_id INT, months_balance INT, stat_for_bureau STRING",
    )
    applications = spark.createDataFrame([(1,)] * 7 + [(2,)] * 3 + [(3,), (None,), (None,)], "reco_id_curr BIGINT")
    joined = enrich.bureau_credits(applications, bki, balance)
    # Pieces of three rows: seven rows are two whole pieces and one of a single row.
    counts = joins.key_counts(applications, "reco_id_curr")
    repeated = enrich.repeated_credits(counts, bki, balance, 3, broadcast, max_items=3)
    assert repeated.dtypes == joined.dtypes
    assert Counter(map(tuple, repeated.collect())) == Counter(map(tuple, joined.collect()))
    assert repeated.count() == 7 * 5 + 3 * 2
