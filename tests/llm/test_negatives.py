"""Hard negatives against plain loops and SQL, on hard rows and on the smallest table."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm import negatives
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows):
    """Every anchor against every row, in Python integers."""
    good = [
        (i, math.fmod(label + 1, 10) if i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = []
    for row in good:
        if row[0] % 100 == 0 and row not in anchors:
            anchors.append(row)
    found = []
    for i, label, v in anchors:
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in good]
        positives = sorted((-s, j) for s, j, other in scored if other == label and j != i)[:5]
        for s, j in positives:
            below = sorted((-t, k) for t, k, other in scored if other != label and 80 * -s <= 100 * t <= 100 * -s)
            found += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(below[:5], 1)]
    return sorted(found)


def mined(df):
    return sorted(tuple(r) for r in negatives.mine(df).collect())


def test_smallest_table_against_sql(spark):
    assert differences(negatives.op11_hard_negatives(spark, SF), connect(SF), negatives.OP11_SQL) == []


@pytest.mark.parametrize("seed,scale,width", [(1, 1.0, 8), (2, 200.0, 70), (3, 0.02, 3), (4, 1.0, 1)])
def test_against_plain_loops(spark, monkeypatch, seed, scale, width):
    # Small blocks and slices, so that anchors and rows are met in several pieces.
    monkeypatch.setattr(negatives, "ANCHORS_TOGETHER", 4)
    random.seed(seed)
    rows = [
        (100 * i if i % 20 == 0 else i, random.randrange(3), [random.gauss(0, scale) for _ in range(width)])
        for i in range(240)
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = plain(rows)
    assert expected
    assert mined(df) == expected


def test_hard_rows(spark):
    same = [1.0, 0.5, 0.0]
    rows = [
        (0, 1, same), (0, 1, same), (None, 1, same), (5, None, same), (6, 1, None), (8, 1, [1.0, None, 0.0]),
        (9, 1, [float("nan"), 1.0, 0.0]), (10, 1, [float("inf"), 1.0, 0.0]), (7, 0, same), (14, 9, same),
        # Ties: many equal vectors of either label, some twice.
        *((i, 1, same) for i in range(20, 40)), *((i, 2, same) for i in range(50, 70)), (51, 2, same),
        (100, 2, []), (101, 2, [1.0]), (103, 3, []), (104, 2, []), (200, -4, [-1.0, 0.0, 0.0]),
        (201, -4, [1.0, 1.0, 1.0]), (300, 8, [-0.0, 1e-9, -1e-9]), (301, 8, [0.0, 0.0, 0.0, 5.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.withColumn("grp", F.lit(1)).withColumn("score", F.lit("x")).withColumn("rank", F.lit(None).cast("int"))
    assert mined(df) == plain(rows)


def test_no_rows_and_no_anchors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mined(empty) == []
    assert negatives.mine(empty).schema.simpleString() == negatives.mine(empty.limit(0)).schema.simpleString()
    assert mined(spark.createDataFrame([(1, 1, [1.0]), (2, 2, [1.0])], SCHEMA)) == []


def test_product_is_exact():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(-40_000, 40_000, (30, 200)).astype(float) for _ in range(2))
    exact = a.astype(np.int64) @ b.astype(np.int64).T
    primes = negatives.enough_moduli(float(np.abs(exact).max()))
    assert len(primes) > 3
    assert (negatives.product(a, b, primes) == exact).all()
    assert all(p // 2 * (p // 2) * negatives.DIMENSIONS_TOGETHER <= 1 << 24 for p in negatives.moduli())
    with pytest.raises(OverflowError):
        negatives.enough_moduli(1e16)
