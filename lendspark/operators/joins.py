"""Equi-joins that keep their result whole when one key holds very many rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.operators.key_sketch import KeySketch, crowded_buckets, key_bucket, sketches

# Pairs of rows that one key may join in one task; a key with more is spread over several.
PAIRS_TOGETHER = 10_000_000
# Keys spread at most, those with the most pairs; bounds what is collected and broadcast.
# Further keys join in one task each, with the same rows.
MAX_HOT_KEYS = 10_000
# Distinct keys that may travel into the scan of another table as literals.
PUSHED_KEYS = 1_000
# Buckets of a sketch whose keys are counted by a filter; with more, all keys are.
FILTERED_BUCKETS = 1_000


def key_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key; folds on the map side, so a hot key costs one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once. Null counts as a key of its own."""
    return key_counts(df, *keys).where(F.col("rows") > 1)


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """The frame itself, once its key is known to be unique; raises otherwise."""
    repeated = duplicate_keys(df, *keys).first()
    if repeated is not None:
        raise ValueError(f"key {', '.join(keys)} is not unique: {repeated.asDict()}")
    return df


def enforced_unique(df: DataFrame, *keys: str) -> DataFrame:
    """The rows, spread and sorted by their key; a repeated key is an error when they are read.

    A join on the key uses the same exchange and order, so the check costs no shuffle of
    its own. Null counts as a key of its own.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    message = F.concat(
        F.lit(f"key {', '.join(keys)} is not unique: "), F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    )
    checked = df.withColumn("_place", place).where(F.assert_true(F.col("_place") == 1, message).isNull())
    return checked.drop("_place")


def narrowed(
    df: DataFrame, rows: DataFrame, key: str, pushed_keys: int = PUSHED_KEYS
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``rows``.

    A few keys become an IN filter, which prunes row groups of a table kept in key order
    and needs no shuffle. More keys narrow by a semi join.
    """
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    some = keys.limit(pushed_keys + 1).collect()
    if len(some) <= pushed_keys:
        return df.where(F.col(key).isin([r[key] for r in some]))
    return df.join(keys, key, "left_semi")


def hot_keys(
    left_counts: DataFrame, right_counts: DataFrame, key: str, null_safe: bool = False,
    pairs_together: int = PAIRS_TOGETHER, max_hot: int = MAX_HOT_KEYS,
) -> DataFrame | None:
    """Keys whose pairs do not fit one task, with the salts of both sides; None without any.

    One job over two ``key_counts``. A key whose rows meet nobody counts with its own rows.
    Null is a key per side unless nulls match each other. The salts of a side follow the
    square root of its share of the rows, which repeats the fewest rows on the other side.
    """
    sides = [
        counts.select(
            F.col(key).alias("_hot"),
            F.when(F.col(key).isNull() & F.lit(not null_safe), F.lit(side)).alias("_side"),
            (F.col("rows") if side == 1 else F.lit(0)).cast("double").alias("_n_left"),
            (F.col("rows") if side == 2 else F.lit(0)).cast("double").alias("_n_right"),
        )
        for side, counts in ((1, left_counts), (2, right_counts))
    ]
    n_left, n_right = F.col("_n_left"), F.col("_n_right")
    pieces = F.ceil(F.greatest(n_left, F.lit(1)) * F.greatest(n_right, F.lit(1)) / pairs_together)
    salts_left = (
        F.when(n_left == 0, 1)
        .when(n_right == 0, F.col("_pieces"))
        .otherwise(F.least("_pieces", F.ceil(F.sqrt(F.col("_pieces") * n_left / n_right))))
    )
    found = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("_hot", "_side")
        .agg(F.sum("_n_left").alias("_n_left"), F.sum("_n_right").alias("_n_right"))
        .withColumn("_pieces", pieces)
        .where(F.col("_pieces") > 1)
        .orderBy(F.desc("_pieces"), "_hot", "_side")
        .limit(max_hot)
        .withColumn("_salts_left", salts_left.cast("int"))
        .withColumn("_salts_right", F.ceil(F.col("_pieces") / F.col("_salts_left")).cast("int"))
        .select("_hot", "_n_left", "_n_right", "_salts_left", "_salts_right")
    )
    rows = found.collect()
    return left_counts.sparkSession.createDataFrame(rows, found.schema) if rows else None


def _spread(df: DataFrame, key: str, hot: DataFrame, own: str, other: str) -> DataFrame:
    """One side of a salted join: each row takes one salt of its side and all of the other's.

    The salt is a hash of the row, the same in every rerun; values pass through untouched.
    Columns that hold maps or variants do not enter it. Equal rows share their salt, and
    their pairs are then split by the other side's salts alone.
    """
    hashed = [
        f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
    mine = hot.where(F.col(f"_n_{own}") > 0).select(
        "_hot", F.col(f"_salts_{own}").alias("_own"), F.col(f"_salts_{other}").alias("_other"),
        (F.col(f"_n_{other}") > 0).alias("_met"),
    )
    marked = df.join(F.broadcast(mine), F.col(key).eqNullSafe(F.col("_hot")), "left")
    salt = F.coalesce(F.pmod(F.xxhash64(*hashed), F.col("_own")), F.lit(0)).cast("int")
    every = F.sequence(F.lit(0), F.coalesce(F.col("_other"), F.lit(1)) - 1)
    return marked.select(
        *df.columns,
        salt.alias(f"_{own}"),
        F.explode(every).alias(f"_{other}"),
        F.coalesce("_met", F.lit(False)).alias(f"_{own}_met"),
    )


def _plain(left: DataFrame, right: DataFrame, key: str, how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, key, how)
    keyed = right.withColumnRenamed(key, "_right_key")
    joined = left.join(keyed, F.col(key).eqNullSafe(F.col("_right_key")), how)
    chosen = F.coalesce(F.col(key), F.col("_right_key")).alias(key)
    return joined.select(
        chosen, *(c for c in left.columns if c != key), *(c for c in right.columns if c != key)
    )


def _counted_hot_keys(
    left: DataFrame, right: DataFrame, key: str, null_safe: bool, pairs_together: int,
    left_sketch: KeySketch | None, right_sketch: KeySketch | None,
) -> DataFrame | None:
    """Hot keys, counted exactly among the keys that the sketches cannot rule out."""
    missing = {
        name: (df, key)
        for name, df, known in (("left", left, left_sketch), ("right", right, right_sketch))
        if known is None
    }
    made = sketches(missing)
    crowded = crowded_buckets(
        left_sketch or made["left"], right_sketch or made["right"], pairs_together, null_safe
    )
    if not crowded:
        return None
    few = len(crowded) <= FILTERED_BUCKETS
    counts = [
        key_counts(df.where(key_bucket(df, key).isin(crowded)) if few else df, key) for df in (left, right)
    ]
    return hot_keys(*counts, key, null_safe, pairs_together)


def key_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    null_safe: bool = False,
    pairs_together: int = PAIRS_TOGETHER,
    left_sketch: KeySketch | None = None,
    right_sketch: KeySketch | None = None,
) -> DataFrame:
    """Join on one equally named key; columns other than the key must differ in name.

    ``how`` is left, inner, right or outer. Spark splits skewed partitions by size, and
    never on a side that an outer join may fill with nulls. This one looks at a sketch of
    both sides' keys first and spreads every key with too many pairs over salts on both
    sides, so that every pair still meets exactly once. A table's sketch may be given where
    it is known; otherwise both sides are sketched in one pass over their keys. A sketch
    that is off costs time, never rows.
    """
    if how not in ("left", "inner", "right", "outer"):
        raise ValueError(f"unknown join type: {how}")
    hot = _counted_hot_keys(left, right, key, null_safe, pairs_together, left_sketch, right_sketch)
    if hot is None:
        return _plain(left, right, key, how, null_safe)
    a = _spread(left, key, hot, "left", "right")
    b = _spread(right, key, hot, "right", "left").withColumnsRenamed(
        {key: "_right_key", "_left": "_left_b", "_right": "_right_b"}
    )
    # Few bytes can make many pairs, so neither size-based merging of partitions nor a
    # broadcast may undo the spread.
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = a.repartition(width, key, "_left", "_right"), b.hint("merge")
    one, two = F.col(key), F.col("_right_key")
    same = one.eqNullSafe(two) if null_safe else one == two
    joined = a.join(
        b, same & (F.col("_left") == F.col("_left_b")) & (F.col("_right") == F.col("_right_b")), how
    )
    # A repeated row meets its partners in some salts only; where the key has partners, its
    # null-filled copies in the other salts do not belong to the result.
    false_miss = F.lit(False)
    for here, there in (("_left_met", "_right_met"), ("_right_met", "_left_met")):
        false_miss = false_miss | (F.coalesce(here, F.lit(False)) & F.col(there).isNull())
    return joined.where(~false_miss).select(
        F.coalesce(one, two).alias(key),
        *(c for c in left.columns if c != key),
        *(c for c in right.columns if c != key),
    )


def join_tables(
    first: DataFrame, second: DataFrame, key: str = "reco_id_curr", how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Join on one key; other columns both frames have get the endings ``_1`` and ``_2``."""
    shared = (set(first.columns) & set(second.columns)) - {key}
    first = first.withColumnsRenamed({c: f"{c}_1" for c in shared})
    second = second.withColumnsRenamed({c: f"{c}_2" for c in shared})
    return key_join(first, second, key, how, null_safe)


def join_stats(first: DataFrame, second: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Unique keys of both sides and of their join, and how often the join repeats rows.

    Derived from the row counts per key, without running the join.
    """
    a = key_counts(first.where(F.col(key).isNotNull()), key).withColumnRenamed("rows", "n_1")
    b = key_counts(second.where(F.col(key).isNotNull()), key).withColumnRenamed("rows", "n_2")
    n1, n2 = F.coalesce("n_1", F.lit(0)), F.coalesce("n_2", F.lit(0))
    kept_1 = how in ("left", "outer")
    kept_2 = how in ("right", "outer")
    joined: Column = n1 * n2
    if kept_1:
        joined = joined + F.when(n2 == 0, n1).otherwise(0)
    if kept_2:
        joined = joined + F.when(n1 == 0, n2).otherwise(0)
    per_key = a.join(b, key, "outer").select(n1.alias("n1"), n2.alias("n2"), joined.alias("n"))
    # Rows without a key match nothing, yet an outer join keeps them.
    null_1 = first.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("n1"))
    null_2 = second.where(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("n2"))
    zero = F.lit(0).cast("long")
    nulls = null_1.select(
        "n1", zero.alias("n2"), (F.col("n1") if kept_1 else zero).alias("n")
    ).unionByName(null_2.select(
        zero.alias("n1"), "n2", (F.col("n2") if kept_2 else zero).alias("n")
    )).withColumn("keyed", F.lit(0))
    every = per_key.withColumn("keyed", F.lit(1)).unionByName(nulls)
    keyed = F.col("keyed") == 1
    return every.agg(
        F.count(F.when(keyed & (F.col("n1") > 0), 1)).alias("unique_keys_1"),
        F.count(F.when(keyed & (F.col("n2") > 0), 1)).alias("unique_keys_2"),
        F.count(F.when(keyed & (F.col("n") > 0), 1)).alias("unique_keys_joined"),
        F.sum("n1").alias("rows_1"),
        F.sum("n").alias("rows_joined"),
    ).withColumn(
        "row_multiplication",
        F.try_divide(F.col("rows_joined").cast("double"), F.col("rows_1")),
    )
