"""Substring deduplication by hashed units: repeated passages keep their first occurrence.

A unit is a sentence or the rest of a line; it is normalised and hashed to 128 bits. Per
digest the occurrence of the least rank stays. Others are repeats, and neighbouring
repeats of a text form a passage, which is removed. Only passages of one or two words are
too short to tell a repeat from chance, and stay. Offsets refer to the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import bounded_batches, slices, table, written

UNIT = re.compile(r"\S[^\n]*?(?:[.!?](?=\s)|(?=\n)|\Z)")


@dataclass(frozen=True)
class Passages:
    """``words``: least length of a removed passage, a floor against noise such as "Yes."."""

    words: int = 3


def units(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Every unit with its digest, place and length in words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in slices(batches, "text"):
            rows, a, b, keys, numbers, starts, ends, words = [], [], [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                if not text:
                    continue
                key = xxhash.xxh3_64_intdigest(text) - (1 << 63)
                for number, found in enumerate(UNIT.finditer(text)):
                    parts = found[0].lower().split()
                    digest = xxhash.xxh3_128_intdigest(" ".join(parts))
                    a.append((digest >> 64) - (1 << 63))
                    b.append((digest & (1 << 64) - 1) - (1 << 63))
                    rows.append(row)
                    keys.append(key)
                    numbers.append(number)
                    starts.append(found.start())
                    ends.append(found.end())
                    words.append(len(parts))
            yield pa.record_batch(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(keys, pa.int64())]
                + [pa.array(x, pa.int32()) for x in (numbers, starts, ends, words)],
                ["a", "b", "doc_id", "key", "number", "begin", "end", "words"],
            )

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"a long, b long, doc_id {kind}, key long, number int, begin int, end int, words int")


def repeats(
    docs: DataFrame, settings: Passages = Passages(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Removed passages: doc_id, key, copy, begin, end, n_units, n_words, kept_doc_id, kept_begin.

    Occurrences rank by id (null last), then by a hash of the text, then by place; ``key``
    is that hash. Of n equal rows (same id and text) the first, ``copy`` 0, is treated like
    any other; each further one, ``copy`` 1 to n - 1, is a repeat as a whole, whatever its
    length. Null, empty and blank texts have no unit. Begin and end count code points.
    Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    # Taken apart once; what follows reads the units.
    found = written(units(docs, id_column, text_column), "units")
    kind = found.schema["doc_id"].dataType.simpleString()
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "begin")
    # Partial sums go first, so a very common unit is one row per task.
    ranked = found.select("a", "b", rank.alias("rank")).groupBy("a", "b").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    # As a table, so that Spark may split a very common unit's rows in the join.
    ranked = written(ranked.where("first <> last").select("a", "b", "first"), "repeated")
    again = found.join(ranked, ["a", "b"]).where(rank != F.col("first"))
    unit = F.struct("number", "begin", "end", "words", F.col("first.doc_id").alias("kept"), F.col("first.begin").alias("kept_begin"))
    per_text = again.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(unit)).alias("units"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for row, own in enumerate(batch.column("units").to_pylist()):
                start = 0
                for k in range(1, len(own) + 1):
                    if k == len(own) or own[k]["number"] != own[k - 1]["number"] + 1:
                        run_of = own[start:k]
                        words = sum(u["words"] for u in run_of)
                        if words >= settings.words:
                            rows.append(row)
                            out.append((run_of[0]["begin"], run_of[-1]["end"], len(run_of), words, run_of[0]["kept"], run_of[0]["kept_begin"]))
                        start = k
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            at = pa.array(rows, pa.int64())
            kinds = [pa.int32()] * 4 + [batch.schema.field("doc_id").type, pa.int32()]
            yield pa.record_batch(
                [batch.column("doc_id").take(at), batch.column("key").take(at)]
                + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "key", "begin", "end", "n_units", "n_words", "kept_doc_id", "kept_begin"],
            )

    schema = f"doc_id {kind}, key long, begin int, end int, n_units int, n_words int, kept_doc_id {kind}, kept_begin int"
    passages = per_text.mapInArrow(run, schema).withColumn("copy", F.lit(0))
    return passages.unionByName(equal_rows(found))


def equal_rows(found: DataFrame) -> DataFrame:
    """A passage over the whole text for every row but the first of equal ones."""
    rows = found.where("number = 0").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("rows"))
    rows = written(rows.where("rows > 1"), "equal")
    same = (F.col("u.key") == F.col("r.key")) & F.col("u.doc_id").eqNullSafe(F.col("r.doc_id"))
    whole = found.alias("u").join(rows.alias("r"), same).groupBy("u.doc_id", "u.key").agg(
        F.max("rows").alias("rows"), F.min("begin").alias("begin"), F.max("end").alias("end"),
        (F.count(F.lit(1)) / F.max("rows")).cast("int").alias("n_units"),
        (F.sum("words") / F.max("rows")).cast("int").alias("n_words"),
    )
    return whole.select(
        "doc_id", "key", "begin", "end", "n_units", "n_words", F.col("doc_id").alias("kept_doc_id"),
        F.col("begin").alias("kept_begin"), F.explode(F.sequence(F.lit(1), F.col("rows").cast("int") - 1)).alias("copy"),
    )


def cut_out(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the spans."""
    if not text:
        return text
    kept, at = [], 0
    for begin, end in sorted(spans):
        kept.append(text[at:begin])
        at = max(at, end)
    return "".join([*kept, text[at:]])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).drop("key")
