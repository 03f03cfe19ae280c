"""Stratified splits with exact class counts, and reports on them."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.functions.columns import require_columns
from lendspark.operators.ordering import running_total
from lendspark.session import ensure_checkpoint_dir
from lendspark.sources.text import csv_reader, read_csv, read_json, write_csv, write_json

# Names of the written parts and of their description.
TRAIN, SIMULATION = "train", "simulation"
TRAIN_FILE, FEATURES_FILE, LABELLED_FILE = (
    "train_data.csv", "production.csv", "production_with_target.csv",
)
METADATA_FILE = "split_metadata.json"

METADATA_DDL = """
    input_file STRING, total_rows BIGINT, total_columns INT, train_ratio DOUBLE,
    train_rows BIGINT, simulation_rows BIGINT, target_column STRING, random_state INT,
    columns ARRAY<STRING>, target_distribution MAP<STRING, BIGINT>,
    train_target_distribution MAP<STRING, BIGINT>,
    simulation_target_distribution MAP<STRING, BIGINT>
"""

# Classes whose edge bucket, a few dozen bytes each, may be broadcast.
BROADCAST_CLASSES = 100_000

# Digits of the row hash that a pass adds to a bucket: 16 ** 4 buckets each.
BUCKET_DIGITS = 4
# Rows of a class that one task ranks; an edge bucket with more is split further.
EDGE_ROWS = 1_000_000
HASH_DIGITS = 32


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and their percentage of all rows, most frequent first.

    Rows without a label form no class but count among all rows.
    """
    require_columns(df, label)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return (
        counts.withColumn("percent", 100.0 * F.col("rows") / total)
        .where(F.col(label).isNotNull())
        .orderBy(F.col("rows").desc(), F.col(label))
    )


def train_size(rows: int, train_ratio: float | None = None, test_size: float | None = None) -> int:
    """Rows of the training part: a ratio rounds it down, a test size rounds the rest up."""
    if (train_ratio is None) == (test_size is None):
        raise ValueError("give either train_ratio or test_size")
    if train_ratio is not None:
        return math.floor(Fraction(str(train_ratio)) * rows)
    return rows - math.ceil(Fraction(str(test_size)) * rows)


def class_quotas(counts: DataFrame, label: str, rows: int, n_train: int) -> DataFrame:
    """Training rows per class: the proportional share rounded down, and one more for the
    classes with the largest remainders until the total is met (ties by label)."""
    # Whole numbers throughout, so that equal remainders really tie.
    wide = "cast(rows as decimal(19,0))"
    based = counts.withColumn("quota", F.expr(f"{wide} * {n_train} div {rows}")).withColumns({
        "remainder": F.expr(f"{wide} * {n_train} - cast(quota as decimal(19,0)) * {rows}"),
        "one": F.lit(1).cast("long"),
    })
    missing = F.lit(n_train) - based.agg(F.sum("quota")).scalar()
    ranked = running_total(
        based, [F.col("remainder").desc(), F.col(label)], {"larger": "one"}
    )
    quota = F.col("quota") + (F.col("larger") < missing).cast("long")
    return ranked.select(label, "rows", quota.alias("quota"))


def row_hash(seed: int, id_columns: list[str]) -> Column:
    """Hash that decides the place of a row, the same in every run."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") for c in id_columns))
    return F.md5(text.cast("binary"))


def stratified_split(
    df: DataFrame,
    label: str,
    id_columns: list[str],
    train_ratio: float | None = None,
    test_size: float | None = None,
    seed: int = 42,
    part: str = "part",
) -> DataFrame:
    """Rows with a ``part`` of train or simulation, each class in exact proportion.

    Every class sends its rows with the smallest hashes to training, so a split is known
    by the last training row of each class. Row counts per (class, hash prefix) tell which
    bucket holds it; while such an edge bucket holds too many rows, it alone is counted by
    longer prefixes. The last bucket is ranked: no task sorts a whole class, and the full
    rows are read once, without a shuffle. ``id_columns`` must identify a row: where equal
    ids lie on both sides of the border, or fill a bucket, the split is an error. Rows
    without a label, which have no class, are an error, as is a class of one row.
    """
    require_columns(df, label, *id_columns)
    ensure_checkpoint_dir(df.sparkSession)
    hashed = df.withColumn("_hash", row_hash(seed, id_columns))
    digits = BUCKET_DIGITS
    keys = hashed.select(F.col(label).alias("_class"), "_hash", *id_columns)
    # Read several times below and small next to the data: at most 16 ** 4 rows per class.
    buckets = _bucket_counts(keys, digits).checkpoint()
    counts = buckets.groupBy("_class").agg(F.sum("n").alias("rows"))
    facts = counts.agg(
        F.sum("rows").alias("rows"),
        F.min("rows").alias("smallest"),
        F.count(F.when(F.col("_class").isNull(), 1)).alias("unlabelled"),
        F.count(F.lit(1)).alias("classes"),
    ).first()
    if facts.unlabelled or (facts.smallest or 0) < 2:
        raise ValueError("every row needs a label and every class at least two rows")
    n_train = train_size(facts.rows, train_ratio, test_size)
    few = facts.classes <= BROADCAST_CLASSES

    quotas = class_quotas(counts, "_class", facts.rows, n_train)
    edges = _edges(buckets, quotas.select("_class", F.col("quota").alias("_take"))).checkpoint()
    while (edges.agg(F.max("n")).first()[0] or 0) > EDGE_ROWS:
        digits += BUCKET_DIGITS
        if digits > HASH_DIGITS:
            raise ValueError(f"{', '.join(id_columns)} repeat too often to identify rows")
        # Only the edge buckets are counted again; a small one is cut further at no cost.
        inside = keys.withColumn("_bucket", F.substring("_hash", 1, digits - BUCKET_DIGITS)).join(
            F.broadcast(edges) if few else edges, ["_class", "_bucket"]
        )
        takes = edges.select("_class", "_take")
        edges = _edges(_bucket_counts(inside, digits), takes).checkpoint()
    row = F.struct("_hash", *id_columns)
    order = Window.partitionBy("_class").orderBy("_hash", *id_columns)
    message = F.lit(f"{', '.join(id_columns)} do not identify rows: equal ones lie on both sides of a split")
    last_rows = (
        keys.withColumn("_bucket", F.substring("_hash", 1, digits))
        .join(F.broadcast(edges) if few else edges, ["_class", "_bucket"])
        .select("_class", "_take", row.alias("_last"), F.row_number().over(order).alias("_place"), F.lead(row).over(order).alias("_next"))
        .where(F.col("_place") == F.col("_take"))
        .where(F.assert_true(F.coalesce(F.col("_last") != F.col("_next"), F.lit(True)), message).isNull())
        .select("_class", "_last")
    )
    # A class with no training row has no last one.
    is_train = F.coalesce(row <= F.col("_last"), F.lit(False))
    return hashed.join(
        F.broadcast(last_rows) if few else last_rows, F.col(label) == F.col("_class"), "left"
    ).select(*df.columns, F.when(is_train, TRAIN).otherwise(SIMULATION).alias(part))


def _bucket_counts(keys: DataFrame, digits: int) -> DataFrame:
    """Rows per class and hash prefix."""
    prefix = F.substring("_hash", 1, digits)
    return keys.groupBy("_class", prefix.alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))


def _edges(buckets: DataFrame, takes: DataFrame) -> DataFrame:
    """Per class the bucket that holds its ``_take``-th row, and the row's number in it."""
    before = F.sum("n").over(Window.partitionBy("_class").orderBy("_bucket")) - F.col("n")
    placed = buckets.withColumn("_before", before).join(takes, "_class")
    return placed.where(
        (F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("n"))
    ).select("_class", "_bucket", "n", (F.col("_take") - F.col("_before")).alias("_take"))


def plain_split(
    df: DataFrame,
    id_columns: list[str],
    train_ratio: float | None = None,
    test_size: float | None = None,
    seed: int = 42,
    part: str = "part",
) -> DataFrame:
    """The same without classes."""
    return stratified_split(
        df.withColumn("_all", F.lit(1)), "_all", id_columns, train_ratio, test_size, seed, part
    ).drop("_all")


def split_counts(split: DataFrame, label: str, part: str = "part") -> DataFrame:
    return split.groupBy(part, label).agg(F.count(F.lit(1)).alias("rows"))


def simulation_features(split: DataFrame, label: str, part: str = "part") -> DataFrame:
    """The simulation part without its label."""
    return split.where(F.col(part) == SIMULATION).drop(label, part)


def split_metadata(
    split: DataFrame, label: str, train_ratio: float, seed: int, source: str, part: str = "part"
) -> DataFrame:
    """One row that describes a split."""
    by_class = split_counts(split.where(F.col(label).isNotNull()), label, part)
    per_class = by_class.groupBy(F.col(label).cast("string").alias("label")).agg(
        *(
            F.sum(F.when(F.col(part) == p, F.col("rows")).otherwise(0)).alias(p)
            for p in (TRAIN, SIMULATION)
        )
    )

    def distribution(rows: Column) -> Column:
        pair = F.when(rows > 0, F.struct(F.col("label"), rows))
        return F.map_from_entries(F.array_sort(F.collect_list(pair)))

    columns = [c for c in split.columns if c != part]
    train, simulation = F.col(TRAIN), F.col(SIMULATION)
    return per_class.agg(
        F.lit(source).alias("input_file"),
        F.sum(train + simulation).alias("total_rows"),
        F.lit(len(columns)).alias("total_columns"),
        F.lit(train_ratio).alias("train_ratio"),
        F.sum(train).alias("train_rows"),
        F.sum(simulation).alias("simulation_rows"),
        F.lit(label).alias("target_column"),
        F.lit(seed).alias("random_state"),
        F.array(*(F.lit(c) for c in columns)).alias("columns"),
        distribution(train + simulation).alias("target_distribution"),
        distribution(train).alias("train_target_distribution"),
        distribution(simulation).alias("simulation_target_distribution"),
    )


def write_split(
    split: DataFrame, folder: str, label: str, train_ratio: float, seed: int = 42,
    source: str = "", part: str = "part",
) -> None:
    """The three CSV tables of a split and the JSON that describes it."""
    folder = folder.rstrip("/")
    split = split.persist(StorageLevel.DISK_ONLY)
    try:
        of = {p: split.where(F.col(part) == p).drop(part) for p in (TRAIN, SIMULATION)}
        write_csv(of[TRAIN], f"{folder}/{TRAIN_FILE}")
        write_csv(of[SIMULATION].drop(label), f"{folder}/{FEATURES_FILE}")
        write_csv(of[SIMULATION], f"{folder}/{LABELLED_FILE}")
        metadata = split_metadata(split, label, train_ratio, seed, source, part)
        write_json(metadata, f"{folder}/{METADATA_FILE}")
    finally:
        split.unpersist()


def split_csv(
    spark: SparkSession,
    path: str,
    folder: str,
    label: str,
    id_columns: list[str],
    train_ratio: float = 0.9,
    seed: int = 42,
    schema: str | None = None,
) -> None:
    """Split a CSV table into the three tables and the description of ``write_split``."""
    table = read_csv(spark, path, schema)
    parts = stratified_split(table, label, id_columns, train_ratio=train_ratio, seed=seed)
    write_split(parts, folder, label, train_ratio, seed, path)


def read_split_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return read_json(spark, f"{folder.rstrip('/')}/{METADATA_FILE}", METADATA_DDL)


def split_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, columns and bytes of the tables that ``write_split`` wrote."""
    def line(name: str) -> DataFrame:
        # Column names come from the header alone; values need no types to be counted.
        path = f"{folder.rstrip('/')}/{name}"
        header = csv_reader(spark).csv(path)
        table = read_csv(spark, path, header.schema)
        files = table.groupBy(F.col("_metadata.file_path")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.col("_metadata.file_size")).alias("bytes")
        )
        return files.agg(
            F.lit(name).alias("name"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.lit(len(table.columns)).alias("columns"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        )

    first, *rest = (line(name) for name in (TRAIN_FILE, FEATURES_FILE, LABELLED_FILE))
    for frame in rest:
        first = first.unionByName(frame)
    return first
