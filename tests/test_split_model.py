import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lendspark.operators import metrics, model, split


def labelled(spark, counts):
    rows, i = [], 0
    for label, n in counts.items():
        for _ in range(n):
            rows.append((i, label, i * 0.5))
            i += 1
    return spark.createDataFrame(rows, "id INT, label STRING, x DOUBLE")


@pytest.mark.parametrize(
    ("counts", "ratio", "expected"),
    [
        ({"a": 70, "b": 30}, 0.9, {"a": 63, "b": 27}),
        ({"a": 5, "b": 5}, 0.5, {"a": 3, "b": 2}),  # equal remainders go by label
        ({"a": 2, "b": 2, "c": 6}, 0.9, {"a": 2, "b": 2, "c": 5}),
        ({"a": 2, "b": 20}, 0.2, {"a": 0, "b": 4}),
    ],
)
def test_exact_quotas(spark, counts, ratio, expected):
    df = labelled(spark, counts)
    parts = split.stratified_split(df, "label", ["id"], train_ratio=ratio)
    rows = parts.collect()
    assert sorted(r.id for r in rows) == list(range(sum(counts.values())))
    got = Counter(r.label for r in rows if r.part == split.TRAIN)
    assert {k: got[k] for k in counts} == expected
    assert sorted(parts.drop("part").collect()) == sorted(df.collect())


def test_split_repeats_and_depends_on_the_seed(spark):
    df = labelled(spark, {"a": 50, "b": 50})

    def train(seed, frame=df):
        parts = split.stratified_split(frame, "label", ["id"], test_size=0.2, seed=seed)
        return {r.id for r in parts.where("part = 'train'").collect()}

    assert train(1) == train(1, df.repartition(5)) != train(2)
    assert len(train(1)) == 80


def test_coarse_buckets_agree(spark, monkeypatch):
    df = labelled(spark, {"a": 40, "b": 60})
    fine = split.stratified_split(df, "label", ["id"], train_ratio=0.75).collect()
    monkeypatch.setattr(split, "BUCKET_DIGITS", 1)
    coarse = split.stratified_split(df, "label", ["id"], train_ratio=0.75).collect()
    assert sorted(fine) == sorted(coarse)


@pytest.mark.parametrize(("digits", "rows"), [(1, 1), (1, 3), (2, 1), (4, 2)])
def test_edge_buckets_are_split_further(spark, monkeypatch, digits, rows):
    df = labelled(spark, {"a": 400, "b": 37, "c": 2})
    plain = split.stratified_split(df, "label", ["id"], train_ratio=0.75).collect()
    monkeypatch.setattr(split, "BUCKET_DIGITS", digits)
    monkeypatch.setattr(split, "EDGE_ROWS", rows)
    assert sorted(split.stratified_split(df, "label", ["id"], train_ratio=0.75).collect()) == sorted(plain)


@pytest.mark.parametrize("edge_rows", [1, 1_000_000])
def test_repeated_ids_are_refused(spark, monkeypatch, edge_rows):
    monkeypatch.setattr(split, "EDGE_ROWS", edge_rows)
    twenty = spark.createDataFrame([(i // 5, "a", float(i)) for i in range(100)], "id INT, label STRING, x DOUBLE")
    with pytest.raises(Exception, match="identify rows"):
        split.stratified_split(twenty, "label", ["id"], train_ratio=0.73).collect()
    # Told apart by a further column, the same rows split exactly.
    parts = split.stratified_split(twenty, "label", ["id", "x"], train_ratio=0.75).collect()
    assert Counter(r.part for r in parts) == {"train": 75, "simulation": 25}


def test_split_errors(spark):
    with pytest.raises(ValueError):
        split.stratified_split(labelled(spark, {"a": 5, "b": 1}), "label", ["id"], train_ratio=0.5)
    with pytest.raises(ValueError):
        split.stratified_split(labelled(spark, {"a": 5, None: 3}), "label", ["id"], train_ratio=0.5)
    with pytest.raises(ValueError, match="missing"):
        split.stratified_split(labelled(spark, {"a": 5}), "target", ["id"], train_ratio=0.5)


def test_train_size_is_exact():
    assert split.train_size(2266 * 5, test_size=0.2) == 2266 * 4
    assert split.train_size(1000, train_ratio=0.999) == 999
    assert split.train_size(7, test_size=0.2) == 5
    assert split.train_size(10, train_ratio=0.7) == 7


def test_class_distribution_percent_of_all_rows(spark):
    rows = split.class_distribution(labelled(spark, {"a": 1, "b": 2, None: 1}), "label").collect()
    assert [tuple(r) for r in rows] == [("b", 2, 50.0), ("a", 1, 25.0)]


def test_written_split(spark, tmp_path):
    parts = split.stratified_split(labelled(spark, {"a": 70, "b": 30}), "label", ["id"], train_ratio=0.9)
    split.write_split(parts, str(tmp_path), "label", 0.9, 42, "in.csv")
    report = {r.name: (r.rows, r.columns) for r in split.split_report(spark, str(tmp_path)).collect()}
    assert report == {"train_data.csv": (90, 3), "production.csv": (10, 2), "production_with_target.csv": (10, 3)}
    facts = split.read_split_metadata(spark, str(tmp_path)).first()
    assert (facts.total_rows, facts.train_rows, facts.simulation_rows) == (100, 90, 10)
    assert facts.target_distribution == {"a": 70, "b": 30}
    assert facts.simulation_target_distribution == {"a": 7, "b": 3}
    assert facts.columns == ["id", "label", "x"] and facts.input_file == "in.csv"


def test_split_of_a_csv_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,target\n" + "".join(f"{i},{i % 2}\n" for i in range(100)))
    split.split_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), "target", ["id"])
    facts = split.read_split_metadata(spark, str(tmp_path / "out")).first()
    assert facts.train_target_distribution == {"0": 45, "1": 45}
    with pytest.raises(ValueError, match="missing"):
        split.split_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "no"), "label", ["id"])


def test_plain_split(spark):
    parts = split.plain_split(spark.range(101), ["id"], test_size=0.2)
    assert parts.columns == ["id", "part"]
    assert Counter(r.part for r in parts.collect()) == {"train": 80, "simulation": 21}


@pytest.mark.parametrize("small", [3, 100_000])
def test_auc_by_brute_force(spark, small):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.randint(0, 12) / 12) for _ in range(150)]
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = metrics.roc_auc(spark.createDataFrame(rows, "label INT, score DOUBLE"), small=small).first()
    assert math.isclose(got.roc_auc, want)
    assert (got.positives, got.negatives) == (len(pos), len(neg))


def test_auc_of_one_class_is_null(spark):
    assert metrics.roc_auc(spark.createDataFrame([(1, 0.5)], "label INT, score DOUBLE")).first().roc_auc is None


def test_metrics(spark):
    rows = [(1, 1)] * 27 + [(1, 0)] * 20 + [(0, 1)] * 7 + [(0, 0)] * 2212
    got = metrics.classification_metrics(spark.createDataFrame(rows, "label INT, prediction INT")).first()
    assert round(got.accuracy, 5) == 0.98808
    assert round(got.recall, 5) == 0.57447 and round(got.f1, 5) == 0.66667
    none = metrics.classification_metrics(spark.createDataFrame([(0, 0)], "label INT, prediction INT")).first()
    assert (none.recall, none.precision, none.f1) == (0.0, 0.0, 0.0)


TOY = "age INT, income DOUBLE, city STRING, tier STRING, label INT"


@pytest.fixture(scope="module")
def toy(spark):
    return spark.createDataFrame(
        [
            (25, 11.0, "Oslo", "A", 0), (47, 26.5, "Lima", "B", 1), (33, 14.0, "Kyiv", "A", 0),
            (55, 41.0, "Oslo", "C", 1), (43, 28.0, "Lima", "B", 1), (21, 9.0, "Kyiv", "A", 0),
            (38, 19.0, "Oslo", "B", 1), (29, 12.5, "Lima", "C", 0),
        ],
        TOY,
    )


def test_pipeline_scores_new_rows(spark, toy, tmp_path):
    fitted = model.fit_logistic(toy, "label")
    new = spark.createDataFrame([(30, 16.0, "Kyiv", "B"), (50, 35.0, "Quito", "C")], "age INT, income DOUBLE, city STRING, tier STRING")
    scores = [r.score for r in model.score(fitted, new, "city").collect()]
    assert all(0 < s < 1 for s in scores) and scores[1] > 0.5
    own = model.score(fitted, toy, "label")
    assert metrics.classification_metrics(own).first().accuracy == 1.0
    fitted.save(str(tmp_path / "model"))
    again = type(fitted).load(str(tmp_path / "model"))
    assert [r.score for r in model.score(again, new, "city").collect()] == scores


def test_unseen_category_is_all_zeros(spark, toy):
    from pyspark.ml import Pipeline

    columns = model.FeatureColumns.of(toy, "label")
    assert (columns.text, columns.numeric) == (["city", "tier"], ["age", "income"])
    fitted = Pipeline(stages=model.feature_stages(toy, columns)).fit(toy)
    new = spark.createDataFrame([(30, 16.0, "Quito", "B")], "age INT, income DOUBLE, city STRING, tier STRING")
    values = fitted.transform(new).first().features.toArray()
    assert list(values[:6]) == [0, 0, 0, 0, 1, 0] and len(values) == 8


def test_population_scaling(spark, toy):
    rows = model.standardize(toy, ["age", "income"]).collect()
    for c in ("age", "income"):
        values = [r[c] for r in rows]
        assert abs(sum(values)) < 1e-9
        assert math.isclose(sum(v * v for v in values) / len(values), 1.0)
    constant = model.standardize(toy.withColumn("age", F.lit(3)), ["age"])
    assert {r.age for r in constant.collect()} == {0.0}


def test_coefficients_solve_the_penalized_problem(spark, toy):
    """Gradient of summed log loss plus half the squared weights vanishes."""
    fitted = model.fit_logistic(toy, "label")
    last = fitted.stages[-1]
    gradient = list(last.coefficients)
    for row in fitted.transform(toy).collect():
        p = row.probability[1]
        for i, v in enumerate(row.features.toArray()):
            gradient[i] += (p - row.label) * v
    assert max(map(abs, gradient)) < 1e-2


def test_incomplete_rows_go(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, float("nan"))], "a INT, b DOUBLE")
    assert [r.a for r in model.drop_incomplete(df).collect()] == [1]
