import pytest
from pyspark.sql import functions as F

from lendspark.operators import bureau
from lendspark.operators.ordering import numbered, page, running_total
from tests.oracle import plan_text

BKI = "reco_id_curr INT, reco_bureau_id INT, credit_status STRING, credit_type STRING, credit_sum DOUBLE, credit_sum_debt DOUBLE, credit_sum_overdue DOUBLE, credit_day_overdue INT"


@pytest.fixture(scope="module")
def bki(spark):
    return spark.createDataFrame(
        [
            (1, 10, "Active", "card", 100.0, None, None, None),
            (1, 11, "Closed", "card", 200.0, None, None, 0),
            (1, 12, "Active", "loan", 300.0, None, 5.0, 30),
            (2, 20, "Sold", "loan", None, None, None, None),
            (3, 30, "Active", "card", 50.0, 1.0, None, 2),  # no balances
        ],
        BKI,
    )


@pytest.fixture(scope="module")
def balance(spark):
    return spark.createDataFrame(
        [
            (10, 0, "C"), (10, -1, "C"), (10, None, "X"), (11, -2, "0"), (11, -2, "0"),
            (12, 0, "1"), (20, -5, "C"),
        ],
        "reco_bureau_id INT, months_balance INT, stat_for_bureau STRING",
    )


def ids(df):
    return sorted({r.reco_bureau_id for r in df.collect()})


def test_lookup_order(bki, balance):
    got = [(r.reco_bureau_id, r.months_balance) for r in bureau.lookup(bki, balance, 1).collect()]
    assert got == [(10, None), (10, 0), (10, -1), (11, -2), (11, -2), (12, 0)]
    assert bureau.lookup(bki, balance, 3).isEmpty()


@pytest.mark.parametrize(
    ("wanted", "expected"),
    [
        ({}, [10, 11, 12, 20]),
        ({"credit_status": "", "credit_type": ""}, [10, 11, 12, 20]),
        ({"has_overdue": True}, [12]),
        ({"has_overdue": False}, [10, 11, 20]),
        ({"min_credit_sum": 0}, [10, 11, 12]),
        ({"min_credit_sum": 200, "max_credit_sum": 300}, [11, 12]),
        ({"reco_id_curr": 0}, []),
        ({"reco_id_curr": 1, "credit_status": "Active", "credit_type": "card"}, [10]),
    ],
)
def test_search(bki, balance, wanted, expected):
    assert ids(bureau.search(bki, balance, bureau.Search(**wanted))) == expected


def test_search_filters_reach_the_scan(spark, tmp_path, bki, balance):
    bki.write.parquet(str(tmp_path / "bki"))
    found = bureau.search(
        spark.read.parquet(str(tmp_path / "bki")), balance,
        bureau.Search(credit_status="Active", min_credit_sum=10.0),
    )
    plan = plan_text(found)
    assert "EqualTo(credit_status,Active)" in plan
    assert "GreaterThanOrEqual(credit_sum,10.0)" in plan


def test_page_limits(bki, balance):
    assert bureau.search_page(bki, balance, bureau.Search(), limit=2, offset=50).isEmpty()
    for bad in ({"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            bureau.search_page(bki, balance, bureau.Search(), **bad)


def test_summary(bki):
    rows = {r.reco_id_curr: r for r in bureau.summary(bki).collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert (one.total_credits, one.active_credits, one.credits_with_overdue) == (3, 2, 1)
    assert (one.total_credit_sum, one.total_debt, one.total_overdue) == (600.0, None, 5.0)
    assert (one.avg_days_overdue, one.max_days_overdue) == (15.0, 30)
    assert (two.total_credits, two.active_credits, two.total_credit_sum) == (1, 0, None)
    assert (two.avg_days_overdue, two.max_days_overdue) == (None, None)
    assert three.total_credits == 1  # counted although the lookup drops it


def test_summary_counts_repeated_credit_once(bki):
    twice = bki.union(bki)
    row = bureau.summary_of(twice, 1).first()
    assert (row.total_credits, row.active_credits, row.credits_with_overdue) == (3, 2, 1)
    assert (row.total_credit_sum, row.avg_days_overdue) == (1200.0, 15.0)


def test_answer_schema_requires_ids(spark):
    rows = spark.createDataFrame([(1, None, 2.0), (1, 5, 3.0)], "reco_id_curr LONG, reco_bureau_id LONG, credit_sum DOUBLE")
    answer = bureau.answer_schema(rows)
    assert len(answer.columns) == 19
    assert [r.reco_bureau_id for r in answer.collect()] == [5]


@pytest.mark.parametrize("offset", [0, 7, 495, 2000])
def test_deep_page_equals_shallow_page(spark, offset):
    df = spark.range(500).select((F.col("id") % 7).alias("a"), "id").repartition(8)
    order = [F.col("a").desc(), F.col("id").asc()]
    shallow = page(df, order, 10, offset).collect()
    assert page(df, order, 10, offset, top_k=1).collect() == shallow


def test_numbered_is_the_global_position(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(8)
    assert numbered(df, [F.col("v")]).where("v != row_no").isEmpty()


@pytest.mark.parametrize("small", [5, 40, 10_000])
def test_running_total(spark, small):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 5).alias("n")).repartition(8)
    got = running_total(df, [F.col("id").desc()], {"before": "n"}, small)
    rows = {r.id: r.before for r in got.collect()}
    total = 0
    for i in reversed(range(300)):
        assert rows[i] == total
        total += i % 5
