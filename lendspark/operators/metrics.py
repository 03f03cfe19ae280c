"""Classification metrics over (label, prediction, score) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.operators.ordering import SMALL_ROWS, running_total
from lendspark.session import ensure_checkpoint_dir


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, recall, precision and F1 of a binary prediction; 0 where undefined."""
    hit = F.col(label) == F.col(prediction)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(hit, 1)).alias("hits"),
        F.count(F.when(hit & (F.col(label) == 1), 1)).alias("tp"),
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
        F.count(F.when(F.col(prediction) == 1, 1)).alias("predicted"),
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    tp = F.col("tp")
    return counts.select(
        "rows",
        ratio(F.col("hits"), F.col("rows")).alias("accuracy"),
        ratio(tp, F.col("positives")).alias("recall"),
        ratio(tp, F.col("predicted")).alias("precision"),
        ratio(2 * tp, F.col("positives") + F.col("predicted")).alias("f1"),
    )


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", small: int = SMALL_ROWS
) -> DataFrame:
    """Exact area under the ROC curve by rank sums; ties count half.

    Rows fold to one per distinct score first, so however many share a score, the rest of
    the work is over distinct scores. They are kept, as their number decides how to rank
    them. Null when a class is missing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
    ).checkpoint()
    ranked = running_total(per_score, [F.col("score")], {"below": "neg"}, small)
    # Twice the number of (negative, positive) pairs in the right order.
    won = F.col("pos").cast("decimal(18,0)") * (2 * F.col("below") + F.col("neg")).cast("decimal(19,0)")
    return ranked.agg(
        F.sum(won).cast("double").alias("won2"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    ).select(
        "positives",
        "negatives",
        F.try_divide(
            F.col("won2"),
            2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double"),
        ).alias("roc_auc"),
    )
