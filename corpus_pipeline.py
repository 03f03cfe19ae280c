"""Documents to training sequences: toxicity, near duplicates, leaks, personal data, packing.

Each stage takes the documents its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm import decontaminate, jaccard_join, packing, pii, toxicity
from lendspark.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the fitted network scores below 0.5; blank ones stay."""
    classifier = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, classifier)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return jaccard_join.one_per_class(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that align with no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced, ``n_chars`` counted anew."""
    changed = pii.anonymise(docs)
    n_chars = F.when(F.col("pii_count") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return changed.withColumn("n_chars", n_chars).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]
"""No stage can be written in SQL as a whole: the tests compare them with brute force."""
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
