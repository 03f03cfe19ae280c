"""Quality rules with thresholds that adapt to each language and source.

A group's values are counted in logarithmic bins, a quantile sketch of fixed relative
error that merges by adding counts and does not depend on the order of rows. Fences beyond
a group's outer quantiles replace fixed cutoffs. Where most texts of a group have none of
something, its fence is 0, and what chance may put into a text follows from the group too:
the share of texts without any gives the rate at which it occurs, and a text may have what
is not all too unlikely at that rate in its length. All figures of a group are drawn towards
its language's, and those towards all texts', by the weight of a few texts, at any size. The
limits are joined back and decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.llm.common import coded, mixed, ngram_hashes, slices, string_hashes, table, words_of, written

SYMBOLS = "[#*$%&|<>]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """``bins``: bins per unit of the natural logarithm, so 1 % wide. ``outer``: share of
    texts below the upper and above the lower quantile. ``fence``: distances of that quantile
    from the median beyond it. ``tail``: chance below which a text's occurrences are too many.
    ``weight``: texts that a language's figures count as in those of its sources."""

    bins: int = 100
    outer: float = 0.8
    fence: float = 4.0
    tail: float = 1e-3
    weight: float = 20.0
    min_words: int = 10
    base_repeat_percent: int = 20


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """doc_id, lang, source and the counts of each row's whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, n = pc.fill_null(batch.column("text"), ""), batch.num_rows
            words, rows = words_of(texts)
            codes, distinct = coded(words)
            chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False) if len(distinct) else np.zeros(0, np.int64)
            hashes = string_hashes(distinct)
            grams, at = ngram_hashes(hashes[codes] if len(codes) else hashes, rows, 5)
            _, which, times = np.unique(grams ^ mixed(rows[at].astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
            again = at[times[which] > 1]
            covered = np.zeros(len(codes) + 5, np.int64)
            np.add.at(covered, again, 1)
            np.add.at(covered, again + 5, -1)
            covered = np.cumsum(covered)[: len(codes)] > 0
            lines, repeated = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for row, text in enumerate(texts.to_pylist()):
                own = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
                lines[row], repeated[row] = len(own), len(own) - len(set(own))
            total = lambda w: np.bincount(rows, weights=w, minlength=n).astype(np.int64)
            yield pa.record_batch(
                [batch.column(c) for c in ("doc_id", "lang", "source")]
                + [
                    pa.array(np.bincount(rows, minlength=n).astype(np.int64)),
                    pa.array(total(chars[codes]) if len(codes) else np.zeros(n, np.int64)),
                    pc.count_substring_regex(texts, SYMBOLS).cast(pa.int64()),
                    pa.array(lines),
                    pa.array(repeated),
                    pa.array(total(covered)),
                ],
                ["doc_id", "lang", "source", *COUNTS],
            )

    lang, source = groups
    chosen = docs.select(
        F.col(id_column).alias("doc_id"), F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"), F.col(text_column).alias("text"),
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def rates(rules: Rules) -> dict[str, tuple]:
    """Per rule: its whole-number rate per 1,000, what it counts, out of what, and the count
    of one occurrence (two runs of five words for a repeat); None for a rule with both fences."""
    per = lambda a, b: F.floor(F.col(a) * 1000 / F.greatest(F.col(b), F.lit(1)))
    parts = {
        "word_length": ("word_chars", "n_words", None),
        "symbols": ("n_symbols", "n_words", 1),
        "dup_lines": ("n_dup_lines", "n_lines", 1),
        "repeats": ("n_repeat_words", "n_words", 10),
    }
    return {rule: (per(a, b), a, b, one) for rule, (a, b, one) in parts.items()}


NONE = -1
"""Bin of the texts with no occurrence."""


def sketches(measured: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, rule, bin, n, size) over the texts that pass the base rules.

    ``size``: words or lines of the bin's texts.
    """
    each = F.explode(F.array(*(
        F.struct(F.lit(r).alias("rule"), v.alias("value"), F.col(count).alias("count"), F.col(of).alias("size"))
        for r, (v, count, of, _) in rates(rules).items()
    )))
    values = measured.where("not base_failed").select("lang", "source", each.alias("x"))
    bin_of = F.when(F.col("x.count") == 0, NONE).otherwise(F.floor(F.log1p(F.col("x.value").cast("double")) * rules.bins))
    return values.groupBy("lang", "source", F.col("x.rule").alias("rule"), bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("x.size").alias("size")
    )


FACTS = ("low", "middle", "high", "none", "length")


def quantiles(sketch: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """Per key and rule: number of texts, their median and outer quantiles, at their bins' middles,
    the share of texts without an occurrence, and the mean length."""
    merged = sketch.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    # A window holds the bins of one group, about 1,500 at most.
    own = Window.partitionBy(*keys, "rule")
    merged = merged.withColumn("total", F.sum("n").over(own)).withColumn("upto", F.sum("n").over(own.orderBy("bin")))
    value = F.when(F.col("bin") == NONE, 0.0).otherwise(F.expm1((F.col("bin") + 0.5) / rules.bins))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, value))
    return merged.groupBy(*keys, "rule").agg(
        F.max("total").alias("total"),
        *(at(q).alias(n) for n, q in (("low", 1 - rules.outer), ("middle", 0.5), ("high", rules.outer))),
        # Half a text more on either side, so that neither share is ever 0.
        ((F.sum(F.when(F.col("bin") == NONE, F.col("n")).otherwise(0)) + 0.5) / (F.sum("n") + 1)).alias("none"),
        (F.sum("size") / F.sum("n")).alias("length"),
    )


def fences(sketch: DataFrame, rules: Rules) -> DataFrame:
    """One row per language and source with each rule's lower and upper fence and its rate."""
    sketch = written(sketch.na.fill("\u0000", ["lang", "source"]), "sketch")
    facts = F.struct("total", *FACTS)
    own = quantiles(sketch, ["lang", "source"], rules).select("lang", "source", "rule", facts.alias("own"))
    lang = quantiles(sketch, ["lang"], rules).select("lang", "rule", facts.alias("of_lang"))
    every = quantiles(sketch, [], rules).select("rule", facts.alias("of_all"))

    def drawn(own: str, towards: dict[str, Column]) -> dict[str, Column]:
        total = F.col(f"{own}.total")
        return {f: (total * F.col(f"{own}.{f}") + rules.weight * towards[f]) / (total + rules.weight) for f in FACTS}

    x = drawn("own", drawn("of_lang", {f: F.col(f"of_all.{f}") for f in FACTS}))
    # A bin's width at least, which is the sketch's error.
    beyond = lambda q, d: F.greatest(rules.fence * d, q / rules.bins)
    upper = x["high"] + beyond(x["high"], x["high"] - x["middle"])
    lower = x["low"] - beyond(x["low"], x["middle"] - x["low"])
    # Texts without any are as many as chance leaves at this rate.
    rate = -F.log(x["none"]) / F.greatest(x["length"], F.lit(1.0))
    found = own.join(lang, ["lang", "rule"]).join(every, "rule").select(
        "lang", "source", "rule", upper.alias("most"), lower.alias("least"), rate.alias("rate")
    )
    columns = [
        F.max(F.when(F.col("rule") == rule, F.col(c))).alias(f"{rule}_{c}")
        for rule in rates(rules) for c in ("most", "least", "rate")
    ]
    return written(found.groupBy("lang", "source").agg(*columns), "fences")


def likely(count: Column, expected: Column, rules: Rules) -> Column:
    """Whether so many occurrences or more are no rarer than ``tail``.

    The chance is bounded by Chernoff's formula for a Poisson count.
    """
    bound = count - expected - count * F.log(count / expected)
    return (count <= expected) | (bound >= F.log(F.lit(rules.tail)))


def judged(docs: DataFrame, rules: Rules = Rules(), id_column: str = "doc_id", text_column: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Every row's id, counts, ``base_failed`` and ``kept``.

    Null texts have no words and fail the base rules, as empty ones do. A null language
    or source is a group of its own. Null and repeated ids keep their rows. Other columns
    are ignored. Extra rows of a group move its limits alone, but for the few texts' weight
    that its language has in the others.
    """
    measured = measures(docs, id_column, text_column, groups)
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.base_repeat_percent * F.col("n_words"))
    measured = written(measured.withColumn("base_failed", failed).na.fill("\u0000", ["lang", "source"]), "measures")
    limits = fences(sketches(measured, rules), rules)
    inside = F.lit(True)
    for rule, (value, count, of, one) in rates(rules).items():
        if one is None:
            within = value.between(F.col(f"{rule}_least"), F.col(f"{rule}_most"))
        else:
            # At the fence, or no more than chance may put there.
            within = (value <= F.col(f"{rule}_most")) | likely(
                F.col(count) / F.lit(float(one)), F.col(f"{rule}_rate") * F.col(of), rules
            )
        inside = inside & F.coalesce(within, F.lit(True))
    joined = measured.join(limits, ["lang", "source"], "left")
    return joined.select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & inside).alias("kept"))


def op6_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))
