"""Row positions, running totals and pages without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendspark.session import ensure_checkpoint_dir

# Rows that one task, or a top-k buffer, may hold.
SMALL_ROWS = 100_000


def numbered(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """Zero-based position of every row in a total order, exact at any size.

    A range-partitioned sort is written once to the checkpoint folder, so that partition
    ids and positions cannot change when a task is run again; then only the per-partition
    row counts, one row each, are summed up.
    """
    ensure_checkpoint_dir(df.sparkSession)
    position = F.monotonically_increasing_id()
    placed = (
        df.orderBy(*order)
        .withColumns(
            {"_slice": F.shiftright(position, 33), "_at": position.bitwiseAND((1 << 33) - 1)}
        )
        .checkpoint()
    )
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        "_slice",
        (F.sum("_rows").over(Window.orderBy("_slice")) - F.col("_rows")).alias("_before"),
    )
    # One row per sort partition, so its size is bounded by the shuffle width.
    return (
        placed.join(F.broadcast(before), "_slice")
        .withColumn(name, F.col("_before") + F.col("_at"))
        .drop("_slice", "_at", "_before")
    )


def page(
    df: DataFrame, order: list[Column], limit: int, offset: int, top_k: int = SMALL_ROWS
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of a total order.

    Near the start a top-k keeps ``offset + limit`` rows per task. Pages beyond ``top_k``
    go by row position instead.
    """
    if offset + limit <= top_k:
        return df.orderBy(*order).offset(offset).limit(limit)
    at = F.col("_row_no")
    return (
        numbered(df, order, "_row_no")
        .where((at >= offset) & (at < offset + limit))
        .orderBy(at)
        .drop("_row_no")
    )


def running_total(
    df: DataFrame, order: list[Column], totals: dict[str, str], small: int = SMALL_ROWS
) -> DataFrame:
    """Sum of a column over all earlier rows, for ``{output: input}`` in ``totals``.

    ``df`` has one row per position of the order. Few rows fit one window task; more are
    cut into runs of consecutive positions, whose sums are few.
    """
    def earlier(column: str, window) -> Column:
        rows = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(rows), F.lit(0))

    if df.limit(small + 1).count() <= small:
        one = Window.orderBy(*order)
        return df.withColumns({out: earlier(col, one) for out, col in totals.items()})
    runs = numbered(df, order, "_row_no").withColumn("_run", F.expr(f"_row_no div {small}"))
    heads = runs.groupBy(F.col("_run").alias("_head")).agg(
        *(F.sum(c).alias(f"_t_{o}") for o, c in totals.items())
    )
    # The heads are fewer by the factor ``small``; the same step sums them up.
    heads = running_total(
        heads, [F.col("_head")], {f"_b_{o}": f"_t_{o}" for o in totals}, small
    ).select(F.col("_head").alias("_run"), *(f"_b_{o}" for o in totals))
    within = Window.partitionBy("_run").orderBy("_row_no")
    return (
        runs.join(heads, "_run")
        .withColumns({o: F.col(f"_b_{o}") + earlier(c, within) for o, c in totals.items()})
        .drop("_run", "_row_no", *(f"_b_{o}" for o in totals))
    )
