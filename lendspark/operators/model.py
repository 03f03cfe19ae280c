"""Feature columns and logistic regression with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.columns import numeric_columns, text_columns
from lendspark.operators.ordering import numbered
from lendspark.session import scratch_path

# Values of a text column that may become features.
MOST_CATEGORIES = 1_000_000
# Iterations, inverse penalty and tolerance of the regression.
MAX_ITERATIONS, INVERSE_PENALTY, TOLERANCE = 1000, 1.0, 1e-6


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows in which no column is null or NaN."""
    return df.dropna(how="any")


def scaling(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column scales by 1."""
    if not columns:
        return {}
    row = df.agg(
        *(
            fn(F.col(c).cast("double")).alias(f"{tag}{i}")
            for i, c in enumerate(columns)
            for tag, fn in (("m", F.avg), ("s", F.stddev_pop))
        )
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardized(column: str, mean: float, deviation: float) -> Column:
    return (F.col(column).cast("double") - F.lit(mean)) / F.lit(deviation)


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns shifted to mean 0 and scaled to population deviation 1."""
    facts = scaling(df, columns)
    return df.withColumns({c: standardized(c, *facts[c]) for c in columns})


@dataclass(frozen=True)
class FeatureColumns:
    """Inputs by kind; any other column stays out of the features."""

    text: list[str]
    numeric: list[str]

    @staticmethod
    def of(df: DataFrame, *excluded: str) -> FeatureColumns:
        rest = df.drop(*excluded)
        return FeatureColumns(text_columns(rest), numeric_columns(rest))


def dictionary(df: DataFrame, column: str, folder: str) -> str:
    """Write a column's values with their number in alphabetical order; where they are.

    The values are numbered by a distributed sort and stay in the shared folder, so none
    reaches the driver. A column with more than ``MOST_CATEGORIES`` is an error.
    """
    values = df.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    if values.limit(MOST_CATEGORIES + 1).count() > MOST_CATEGORIES:
        raise ValueError(f"{column} has more than {MOST_CATEGORIES} values: leave it out or group them")
    path = f"{folder.rstrip('/')}/{column}"
    numbered(values, [F.col("value")], "place").write.mode("overwrite").parquet(path)
    return path


def feature_stages(train: DataFrame, columns: FeatureColumns, folder: str | None = None) -> list:
    """Stages that encode text one-hot and standardize numbers into ``features``.

    Categories are in alphabetical order; one that training did not see has no entry.
    Their dictionaries are written to ``folder``, by default a new one in the shared folder;
    a saved model reads them there, so give a lasting one with it.
    """
    spark = train.sparkSession
    folder = folder or scratch_path(spark, "dictionaries")
    stages: list = []
    if columns.text:
        paths = {c: dictionary(train, c, folder) for c in columns.text}
        joins, places = [], []
        for i, (c, path) in enumerate(paths.items()):
            # An unseen or missing value takes the place after the last, which the encoder,
            # told to keep and then drop that place, encodes as all zeros.
            size = spark.read.parquet(path).count()
            joins.append(f"LEFT JOIN parquet.`{path}` d{i} ON t.`{c}` = d{i}.value")
            places.append(f"CAST(coalesce(d{i}.place, {size}) AS DOUBLE) AS `{c}__index`")
        statement = f"SELECT t.*, {', '.join(places)} FROM __THIS__ t {' '.join(joins)}"
        stages.append(SQLTransformer(statement=statement))
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}__index" for c in columns.text], outputCols=[f"{c}__hot" for c in columns.text],
                dropLast=True, handleInvalid="keep",
            )
        )
    facts = scaling(train, columns.numeric)
    if facts:
        scaled = ", ".join(
            f"(CAST(`{c}` AS DOUBLE) - CAST('{m!r}' AS DOUBLE)) / CAST('{s!r}' AS DOUBLE) AS `{c}__std`"
            for c, (m, s) in facts.items()
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"))
    stages.append(
        VectorAssembler(
            inputCols=[f"{c}__hot" for c in columns.text] + [f"{c}__std" for c in columns.numeric],
            outputCol="features",
        )
    )
    return stages


def fit_logistic(train: DataFrame, label: str, *ids: str) -> PipelineModel:
    """Features and an L2 logistic regression, fitted on complete rows of ``train``."""
    complete = drop_incomplete(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        columns = FeatureColumns.of(complete, label, *ids)
        classifier = LogisticRegression(
            labelCol=label,
            maxIter=MAX_ITERATIONS,
            tol=TOLERANCE,
            # The inverse penalty applies to the summed loss; Spark penalizes the mean loss.
            regParam=1.0 / (INVERSE_PENALTY * max(1, complete.count())),
            elasticNetParam=0.0,
            standardization=False,
            fitIntercept=True,
        )
        return Pipeline(stages=[*feature_stages(complete, columns), classifier]).fit(complete)
    finally:
        complete.unpersist()


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Kept columns, prediction and probability of class 1."""
    return model.transform(df).select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )
