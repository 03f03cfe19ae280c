"""Splits, features, model and metrics."""

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendspark.catalog import roles
from lendspark.catalog.registry import query
from lendspark.operators import bureau, metrics, model, split
from lendspark.session import scratch_path

LABEL, IDS, RATIO, SEED = "contract_type_name", ["reco_id_curr"], 0.9, 42

# Classes with their size, quota of training rows, and each row's place in its class.
_SPLIT = f"""
    , c AS (SELECT {LABEL} AS label, count(*) AS n FROM applications GROUP BY 1),
    t AS (SELECT sum(n)::BIGINT AS n, (sum(n)::BIGINT * 9) // 10 AS m FROM c),
    q AS (SELECT label, c.n, c.n * t.m // t.n AS base, c.n * t.m % t.n AS rest FROM c, t),
    quota AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                  <= (SELECT m FROM t) - (SELECT sum(base) FROM q) THEN 1 ELSE 0 END AS quota
              FROM q),
    placed AS (SELECT *, row_number() OVER (PARTITION BY {LABEL}
                   ORDER BY md5('{SEED}:' || reco_id_curr), reco_id_curr) AS place
               FROM applications),
    parts AS (SELECT placed.* EXCLUDE (place),
                  CASE WHEN place <= quota THEN 'train' ELSE 'simulation' END AS part
              FROM placed JOIN quota ON {LABEL} = label) """


def split_frame(spark, sf):
    return split.stratified_split(
        roles.applications(spark, sf), LABEL, IDS, train_ratio=RATIO, seed=SEED
    )


@query(
    "class_distribution",
    roles.sql(
        """SELECT contract_type_name, count(*) AS rows,
                  100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS percent
        FROM applications GROUP BY 1 ORDER BY 2 DESC, 1""",
        "applications",
    ),
)
def class_distribution(spark, sf):
    return split.class_distribution(roles.applications(spark, sf), LABEL)


@query("stratified_split", roles.sql(f"{_SPLIT} SELECT * FROM parts", "applications"))
def stratified_split(spark, sf):
    return split_frame(spark, sf)


@query(
    "stratified_split_counts",
    roles.sql(
        f"{_SPLIT} SELECT part, {LABEL}, count(*) AS rows FROM parts GROUP BY ALL", "applications"
    ),
)
def stratified_split_counts(spark, sf):
    return split.split_counts(split_frame(spark, sf), LABEL)


@query(
    "plain_split",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id)
                  <= (count(*) OVER ()) - ceil(count(*) OVER () * 2 / 10.0)
              THEN 'train' ELSE 'simulation' END AS part
       FROM documents""",
)
def plain_split(spark, sf):
    documents = roles.table(spark, sf, "documents").select("doc_id")
    return split.plain_split(documents, ["doc_id"], test_size=0.2, seed=SEED)


@query(
    "simulation_features",
    roles.sql(
        f"{_SPLIT} SELECT * EXCLUDE (part, {LABEL}) FROM parts WHERE part = 'simulation'",
        "applications",
    ),
)
def simulation_features(spark, sf):
    return split.simulation_features(split_frame(spark, sf), LABEL)


def written_split(spark, sf) -> str:
    folder = scratch_path(spark, "split")
    split.write_split(split_frame(spark, sf), folder, LABEL, RATIO, SEED, source="applications")
    return folder


@query(
    "split_metadata",
    roles.sql(
        f"""{_SPLIT}
        SELECT 'rows' AS section, 'total' AS label, count(*) AS rows FROM parts
        UNION ALL SELECT 'rows', part, count(*) FROM parts GROUP BY part
        UNION ALL SELECT 'all', {LABEL}, count(*) FROM parts GROUP BY 2
        UNION ALL SELECT part, {LABEL}, count(*) FROM parts GROUP BY 1, 2
        UNION ALL SELECT 'columns', 'total', 5""",
        "applications",
    ),
)
def split_metadata(spark, sf):
    facts = split.read_split_metadata(spark, written_split(spark, sf))

    def line(section, label, rows):
        return F.struct(
            F.lit(section).alias("section"), F.lit(label).alias("label"),
            rows.cast("bigint").alias("rows"),
        )

    def lines(section, distribution):
        return F.transform(
            F.map_entries(distribution),
            lambda e: F.struct(
                F.lit(section).alias("section"), e["key"].alias("label"), e["value"].alias("rows")
            ),
        )

    single = F.array(
        line("rows", "total", F.col("total_rows")),
        line("rows", "train", F.col("train_rows")),
        line("rows", "simulation", F.col("simulation_rows")),
        line("columns", "total", F.size("columns")),
    )
    return facts.select(
        F.inline(
            F.concat(
                single,
                lines("all", F.col("target_distribution")),
                lines("train", F.col("train_target_distribution")),
                lines("simulation", F.col("simulation_target_distribution")),
            )
        )
    )


@query(
    "split_report",
    roles.sql(
        f"""{_SPLIT}
        SELECT 'train_data.csv' AS name, count(*) AS rows, 5 AS columns FROM parts
        WHERE part = 'train'
        UNION ALL SELECT 'production.csv', count(*), 4 FROM parts WHERE part = 'simulation'
        UNION ALL SELECT 'production_with_target.csv', count(*), 5 FROM parts
        WHERE part = 'simulation'""",
        "applications",
    ),
)
def split_report(spark, sf):
    return split.split_report(spark, written_split(spark, sf)).select("name", "rows", "columns")


@query(
    "standardize",
    """SELECT o_orderkey,
              round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6)
                  AS o_totalprice
       FROM orders""",
)
def standardize(spark, sf):
    orders = roles.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return model.standardize(orders, ["o_totalprice"]).withColumn(
        "o_totalprice", F.round("o_totalprice", 6)
    )


@query(
    "ml_features",
    roles.sql(
        """SELECT reco_id_curr, target,
                  dense_rank() OVER (ORDER BY contract_type_name) - 1 AS category,
                  (SELECT count(DISTINCT contract_type_name) FROM applications) + 2 AS width,
                  round((income - avg(income) OVER ()) / stddev_pop(income) OVER (), 6)
                      AS income,
                  round((rating_client_region - avg(rating_client_region) OVER ())
                      / stddev_pop(rating_client_region) OVER (), 6) AS rating_client_region
        FROM applications""",
        "applications",
    ),
)
def ml_features(spark, sf):
    frame = roles.applications(spark, sf)
    columns = model.FeatureColumns.of(frame, "target", "reco_id_curr")
    features = Pipeline(stages=model.feature_stages(frame, columns)).fit(frame).transform(frame)
    values = F.col("values")
    return features.withColumn("values", vector_to_array("features")).select(
        "reco_id_curr",
        "target",
        (F.array_position(values, 1.0) - 1).alias("category"),
        F.size(values).cast("bigint").alias("width"),
        F.round(F.element_at(values, -2), 6).alias("income"),
        F.round(F.element_at(values, -1), 6).alias("rating_client_region"),
    )


def model_frame(spark, sf):
    """Applications with their bureau totals; the label is not among the features."""
    totals = bureau.summary(roles.bki(spark, sf)).select(
        "reco_id_curr", "total_credits", "active_credits",
        F.col("total_credit_sum").cast("double").alias("total_credit_sum"),
    )
    return roles.applications(spark, sf).drop("income").join(totals, "reco_id_curr", "left")


@query(
    "ml_toy_scores",
    roles.sql(
        f"""
        , totals AS (
            SELECT reco_id_curr, count(DISTINCT reco_bureau_id) AS total_credits FROM bki GROUP BY 1),
        complete AS (
            SELECT a.reco_id_curr, a.target FROM applications a JOIN totals USING (reco_id_curr)
            WHERE a.contract_type_name IS NOT NULL AND a.rating_client_region IS NOT NULL),
        c AS (SELECT target AS label, count(*) AS n FROM complete GROUP BY 1),
        t AS (SELECT sum(n)::BIGINT AS n, sum(n)::BIGINT - CAST(ceil(sum(n) * 2 / 10.0) AS BIGINT) AS m FROM c),
        q AS (SELECT label, c.n * t.m // t.n AS base, c.n * t.m % t.n AS rest FROM c, t),
        quota AS (
            SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                <= (SELECT m FROM t) - (SELECT sum(base) FROM q) THEN 1 ELSE 0 END AS quota FROM q),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY target
                ORDER BY md5('{SEED}:' || reco_id_curr), reco_id_curr) AS place FROM complete)
        SELECT reco_id_curr, target, true AS in_range, true AS follows_score
        FROM placed JOIN quota ON target = label WHERE place > quota""",
        "applications", "bki",
    ),
)
def ml_toy_scores(spark, sf):
    """Held-out complete rows scored after training on the others.

    A fitted score is no SQL expression, so the check covers which rows are scored, and that
    scores are probabilities which the predictions follow.
    """
    scored = toy_scores(spark, sf)
    return scored.select(
        *IDS, "target", F.col("score").between(0, 1).alias("in_range"),
        (F.col("prediction") == (F.col("score") > 0.5).cast("int")).alias("follows_score"),
    )


@query("ml_toy_probabilities")
def toy_scores(spark, sf):
    """The scores themselves."""
    frame = model.drop_incomplete(model_frame(spark, sf))
    table = scratch_path(spark, "model-split")
    split.stratified_split(frame, "target", IDS, test_size=0.2, seed=SEED).write.parquet(table)
    parts = spark.read.parquet(table)
    train = parts.where(F.col("part") == split.TRAIN).drop("part")
    held_out = parts.where(F.col("part") == split.SIMULATION).drop("part")
    fitted = model.fit_logistic(train, "target", *IDS)
    return model.score(fitted, held_out, "reco_id_curr", "target")


_PREDICTIONS = """
    (SELECT quality AS label, toxic AS prediction, n_chars AS score
     FROM labels JOIN documents USING (doc_id))"""


@query(
    "classification_metrics",
    f"""SELECT count(*) AS rows,
               count(*) FILTER (label = prediction)::DOUBLE / count(*) AS accuracy,
               count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE
                   / count(*) FILTER (label = 1) AS recall,
               count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE
                   / count(*) FILTER (prediction = 1) AS precision,
               2.0::DOUBLE * count(*) FILTER (label = 1 AND prediction = 1)
                   / (count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1)) AS f1
        FROM {_PREDICTIONS}""",
)
def classification_metrics(spark, sf):
    return metrics.classification_metrics(roles.scored_labels(spark, sf))


@query(
    "roc_auc",
    f"""SELECT max(p)::BIGINT AS positives, max(n)::BIGINT AS negatives,
               (sum(rank_) FILTER (label = 1) - max(p) * (max(p) + 1) / 2.0)::DOUBLE
                   / (max(p) * max(n))::DOUBLE AS roc_auc
        FROM (SELECT label, count(*) FILTER (label = 1) OVER () AS p,
                     count(*) FILTER (label = 0) OVER () AS n,
                     rank() OVER (ORDER BY score)
                         + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rank_
              FROM {_PREDICTIONS})""",
)
def roc_auc(spark, sf):
    return metrics.roc_auc(roles.scored_labels(spark, sf))
