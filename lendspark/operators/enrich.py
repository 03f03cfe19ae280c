"""Bureau lookup for all applications at once, as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.functions.lookup import lookup_columns
from lendspark.operators.bureau import credit_balances
from lendspark.sources.schemas import CREDIT_COLUMNS

# Credits one array may hold; an application with more gets several arrays.
ARRAY_ITEMS = 10_000

BUREAU_CREDIT_COLUMNS = [
    "bureau_annuity_payment" if c == "annuity_payment" else c for c in CREDIT_COLUMNS
]


def lookup_counts(bki: DataFrame, balance: DataFrame) -> DataFrame:
    """Rows a lookup returns per application: its credits times their balances.

    Balances are counted per credit before the join, so neither a credit nor an
    application with very many rows gathers in one task.
    """
    months = balance.groupBy("reco_bureau_id").agg(F.count(F.lit(1)).alias("months"))
    return (
        bki.select("reco_id_curr", "reco_bureau_id")
        .join(months, "reco_bureau_id")
        .groupBy("reco_id_curr")
        .agg(F.sum("months").alias("found"))
    )


def enrich(
    applications: DataFrame, bki: DataFrame, balance: DataFrame, asked_at_ms: Column
) -> DataFrame:
    """Applications with the outcome columns of their lookup; row count unchanged.

    The credits themselves stay rows, see ``bureau_credits``.
    """
    return with_outcome(applications, lookup_counts(bki, balance), asked_at_ms)


def with_outcome(applications: DataFrame, counts: DataFrame, asked_at_ms: Column) -> DataFrame:
    """``enrich`` by the ``lookup_counts`` of the applications."""
    joined = applications.join(counts, "reco_id_curr", "left")
    outcome = lookup_columns(F.col("reco_id_curr"), F.col("found"), asked_at_ms)
    return joined.select(*applications.columns, *(c.alias(n) for n, c in outcome.items()))


def bureau_credits(applications: DataFrame, bki: DataFrame, balance: DataFrame) -> DataFrame:
    """One row per application row, credit and balance: the table of landed credits."""
    credits, columns = _credits(bki, balance)
    return applications.select("reco_id_curr").join(credits, "reco_id_curr").select(*columns)


def _credits(bki: DataFrame, balance: DataFrame) -> tuple[DataFrame, list[str]]:
    """Credits with their balances, and the columns of a landed credit."""
    credits = credit_balances(bki, balance).withColumnRenamed(
        "annuity_payment", "bureau_annuity_payment"
    )
    return credits, [c for c in BUREAU_CREDIT_COLUMNS if c in credits.columns]


def repeated_credits(
    counts: DataFrame,
    bki: DataFrame,
    balance: DataFrame,
    tasks: int,
    broadcast: bool = False,
    max_items: int = ARRAY_ITEMS,
) -> DataFrame:
    """``bureau_credits`` of applications given once each, with their number of ``rows``.

    Each credit row meets its application once and is then repeated in place, where it is
    written, by ``tasks`` tasks: a join of all rows would go by the bytes it reads, and these
    say little about the rows it returns. An application with very many rows is repeated
    in pieces of ``max_items``.
    """
    credits, columns = _credits(bki, balance)
    rows = F.col("rows")
    pieces = counts.select(
        "reco_id_curr", rows, F.explode(F.sequence(F.lit(0), F.floor((rows - 1) / max_items))).alias("_piece")
    ).select(
        "reco_id_curr", "_piece", F.least(F.lit(max_items), rows - F.col("_piece") * max_items).cast("int").alias("_times")
    )
    if broadcast:
        pieces = F.broadcast(pieces)
    met = pieces.join(credits, "reco_id_curr")
    dealt = met.repartition(tasks, "reco_id_curr", "_piece", "reco_bureau_id", "months_balance")
    return dealt.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("_times")))).select(*columns)


def credit_arrays(
    bki: DataFrame, balance: DataFrame, max_items: int = ARRAY_ITEMS
) -> DataFrame:
    """Credits of each application as sorted arrays, for callers that want them nested.

    An application normally has one array, ``part`` 0. One with more than ``max_items``
    credit rows has as many parts as keep each near that size, told apart by a hash of
    the credit; its equal rows are folded and dealt to parts by number, so nothing is lost
    and no task or row has to hold a whole large group. Only the rows of such applications
    are folded, as that takes a table of whole rows.
    """
    large = (
        lookup_counts(bki, balance)
        .where((F.col("found") > max_items) & F.col("reco_id_curr").isNotNull())
        .select("reco_id_curr", F.ceil(F.col("found") / max_items).alias("_parts"))
    )
    known = bki.where(F.col("reco_id_curr").isNotNull())
    credits = credit_balances(known.join(large, "reco_id_curr", "left_anti"), balance)
    columns = credits.columns

    def items(n: Column) -> Column:
        item = F.struct(
            # Ids ascending, newest balance first; the rest makes the order total.
            F.col("reco_bureau_id"),
            (-F.col("months_balance")).alias("_age"),
            *(F.col(c) for c in columns if c not in ("reco_id_curr", "reco_bureau_id")),
            n.cast("int").alias("_n"),
        )
        return F.array_sort(F.collect_list(item)).alias("items")

    def answer(gathered: DataFrame, unfolded: Column) -> DataFrame:
        plain = F.transform(
            unfolded, lambda i: F.struct(*(i[c].alias(c) for c in columns if c != "reco_id_curr"))
        )
        return gathered.select("reco_id_curr", "part", plain.alias("bureau_credits"))

    one = credits.groupBy("reco_id_curr", F.lit(0).cast("long").alias("part")).agg(items(F.lit(1)))
    several = credit_balances(known.join(large, "reco_id_curr", "left_semi"), balance)
    folded = several.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    pieces = folded.withColumn(
        "_piece",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / max_items))),
    ).withColumn("_n", F.least(F.lit(max_items), F.col("_n") - F.col("_piece") * max_items))
    part = F.pmod(F.xxhash64(*columns, "_piece"), F.col("_parts"))
    dealt = (
        pieces.join(large, "reco_id_curr")
        .groupBy("reco_id_curr", part.alias("part"))
        .agg(items(F.col("_n")))
    )
    unfold = F.flatten(F.transform("items", lambda i: F.array_repeat(i, i["_n"])))
    return answer(one, F.col("items")).unionByName(answer(dealt, unfold))


def enrich_with_arrays(
    applications: DataFrame,
    bki: DataFrame,
    balance: DataFrame,
    asked_at_ms: Column,
    max_items: int = ARRAY_ITEMS,
) -> DataFrame:
    """``enrich`` with nested credits; an application without any has an empty array."""
    arrays = credit_arrays(bki, balance, max_items)
    enriched = enrich(applications, bki, balance, asked_at_ms)
    # An inner join, which Spark can split at a hot application, plus the rows without
    # credits; a left join would keep all arrays of one application in one task.
    with_credits = enriched.where(F.col("bureau_count") > 0).join(arrays, "reco_id_curr")
    without = enriched.where(F.col("bureau_count") == 0).select(
        "*",
        F.lit(0).cast("long").alias("part"),
        F.array().cast(arrays.schema["bureau_credits"].dataType).alias("bureau_credits"),
    )
    return with_credits.select(*without.columns).unionByName(without)


def explode_credits(enriched: DataFrame) -> DataFrame:
    """Nested credits back to rows; applications without credits give none."""
    rows = enriched.where(F.col("bureau_count") > 0).select(
        "reco_id_curr", F.explode("bureau_credits").alias("credit")
    )
    flat = rows.select("reco_id_curr", "credit.*").withColumnRenamed(
        "annuity_payment", "bureau_annuity_payment"
    )
    return flat.select(*(c for c in BUREAU_CREDIT_COLUMNS if c in flat.columns))
