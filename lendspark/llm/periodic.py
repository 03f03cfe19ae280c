"""Periodic runs of words inside a text, by seed and extend over k-gram diagonals.

A run of smallest period q and length of at least max(6, 4q) repeats itself q words later
over at least max(5, 3q) words. So every k-gram with q <= k <= max(5, 3q) that starts inside
recurs q words later, and not sooner: the first q words of the gram are no repetition of a
shorter word, and such a word occurs in its own square at the two ends alone. The occurrence
pairs worth looking at are thus the neighbouring ones of each gram, of which there are at
most as many as words.

Gram sizes double from 5 on. The grams of one size find the lags between half of it and
itself; grams of the next size are pairs of this one's, and only those that recur in their
text are kept. On a lag, a seed that the stretch before it already reaches extends it by a
word; every other seed opens a stretch. Stretches that are long enough are the runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import coded, slices, table, words_of

LEAST_LENGTH = 6
LEAST_REPEATS = 4
SEED = LEAST_LENGTH - 1
"""Words of the smallest seed; the least stretch that a run of period 1 repeats."""

RESULT = (
    "doc_id {id}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
)


def _recurring(names: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams that recur in their text: position, exact number of the gram, distance to the next one.

    ``names`` numbers the grams that start at ``at`` (ascending), equal for equal grams. The
    distance is 0 at a gram's last occurrence. Results are in the order of the positions.
    """
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    place = at[order]
    same &= rows[place[1:]] == rows[place[:-1]]
    gap = np.zeros(len(order), np.int64)
    gap[:-1][same] = (place[1:] - place[:-1])[same]
    kept = np.zeros(len(order), bool)
    kept[:-1] |= same
    kept[1:] |= same
    number = np.cumsum(np.concatenate([[True], ~same])) if len(order) else order
    number, place, gap = number[kept], place[kept], gap[kept]
    back = np.argsort(place, kind="stable")
    return place[back], number[back], gap[back]


def _paired(at: np.ndarray, number: np.ndarray, step: int, other_at: np.ndarray, other: np.ndarray):
    """Grams joined with the grams that start ``step`` later: positions, and a number per pair."""
    if not len(at) or not len(other_at):
        return at[:0], number[:0]
    there = np.minimum(np.searchsorted(other_at, at + step), len(other_at) - 1)
    both = other_at[there] == at + step
    return at[both], number[both] * (int(other.max()) + 1) + other[there[both]]


def stretches(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, period) of all runs. ``codes`` numbers words, ``rows`` their texts, ascending."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    every = np.arange(len(codes))
    one = codes.astype(np.int64)
    # Grams are numbered per text, so one that crosses a border recurs nowhere.
    at, number, _ = _recurring(one, every, rows)
    single = (at, number)
    at, names = _paired(at, number, 1, *single)
    at, number, _ = _recurring(names, at, rows)
    at, names = _paired(at, number, 2, at, number)
    at, number, _ = _recurring(names, at, rows)
    at, names = _paired(at, number, SEED - 1, *single)
    at, number, gap = _recurring(names, at, rows)
    k, least = SEED, 1
    longest = int(np.bincount(rows).max()) if len(rows) else 0
    while len(at) and LEAST_REPEATS * least <= longest:
        fits = (gap >= least) & (gap <= k)
        lag, seed = gap[fits], at[fits]
        order = np.lexsort((seed, lag))
        lag, seed = lag[order], seed[order]
        if len(lag):
            # Per lag the seeds ascend, so what is covered furthest is the stretch just before.
            opens = np.concatenate([[True], (lag[1:] != lag[:-1]) | (seed[1:] != seed[:-1] + 1)])
            first = np.flatnonzero(opens)
            last = np.append(first[1:], len(lag)) - 1
            start, period = seed[first], lag[first]
            length = seed[last] + k - start + period
            whole = length >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * period)
            found.append((start[whole], length[whole], period[whole]))
        at, names = _paired(at, number, k, at, number)
        at, number, gap = _recurring(names, at, rows)
        least, k = k + 1, 2 * k
    if not found:
        return every[:0], every[:0], every[:0]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _stretched(lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray | None:
    """Which word stands at each place once the contract's texts are made periodic; None if none is."""
    g = hashes // 10
    changed = np.flatnonzero((hashes >= 0) & (hashes % 10 == 0) & (lengths > 0))
    if not len(changed):
        return None
    places = np.arange(int(lengths.sum()))
    begins = np.cumsum(lengths) - lengths
    for r in changed.tolist():
        n, begin = int(lengths[r]), int(begins[r])
        a = int(g[r]) % n
        p = 1 + (n - a) // (3 + int(g[r]) % 8)
        places[begin + a : begin + n] = begin + a + np.arange(n - a) % p
    return places


def _texts(words: pa.Array, counts: np.ndarray) -> pa.Array:
    """Each text's words joined by a space."""
    borders = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
    lists = pa.LargeListArray.from_arrays(borders, words)
    return pc.binary_join(lists, " ")


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", stretch: bool = False) -> DataFrame:
    """Runs of every text by start, then period, and the text with each run cut to its first period.

    A run is a stretch of words with smallest period q and at least max(6, 4q) words that
    its neighbours do not continue. Runs may overlap; a word goes if any run holds it after
    that run's first q words; the others are joined by single spaces. With ``stretch``, texts
    whose id hashes to a multiple of ten are made periodic first, as the contract says.

    One row per input row, repeated and null ids included (a null id is never stretched). A
    null text has no words, like an empty or blank one: no runs and an empty text. Texts are
    handled whole, however long, in slices of a few megabytes or one text. An empty table
    gives no rows; further columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            size = batch.num_rows
            words, rows = words_of(batch.column("text"))
            lengths = np.bincount(rows, minlength=size)
            codes, _ = coded(words)
            if stretch:
                places = _stretched(lengths, pc.fill_null(batch.column("crc"), -1).to_numpy())
                if places is not None:
                    codes, words = codes[places], words.take(pa.array(places))
            start, length, period = stretches(codes, rows)
            order = np.lexsort((period, start))
            start, length, period = start[order], length[order], period[order]
            owner = rows[start]
            counts = np.bincount(owner, minlength=size)
            # Words that some run holds after its first period.
            depth = np.zeros(len(codes) + 1, np.int64)
            np.add.at(depth, start + period, 1)
            np.add.at(depth, start + length, -1)
            kept = np.cumsum(depth[:-1]) == 0
            left = words if kept.all() else words.filter(pa.array(kept))
            local = start - (np.cumsum(lengths) - lengths)[owner]
            runs = pa.StructArray.from_arrays(
                [pa.array(local), pa.array(length), pa.array(period)], ["start", "length", "period"]
            )
            borders = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            columns = [
                batch.column("doc_id"),
                pa.array(lengths.astype(np.int64)),
                pa.ListArray.from_arrays(borders, runs),
                _texts(left, np.bincount(rows[kept], minlength=size)),
            ]
            yield pa.record_batch(columns, ["doc_id", "n_words", "runs", "collapsed"])

    ids = F.col(id_column).alias("doc_id")
    chosen = docs.select(ids, F.col(text_column).alias("text"))
    if stretch:
        chosen = chosen.withColumn("crc", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return chosen.mapInArrow(run, RESULT.format(id=chosen.schema["doc_id"].dataType.simpleString()))


def digests(found: DataFrame) -> DataFrame:
    """Per text the number of runs, the longest (ties: least start, then period), and digests."""
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("q")))
    )
    line = F.transform(
        "runs", lambda r: F.concat_ws(",", *(r[f].cast("string") for f in ("start", "length", "period")))
    )
    lines = F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n"))))
    top = found.withColumn("top", longest)
    start, length, period = -F.col("top.s"), F.col("top.length"), -F.col("top.q")
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * top.length div -top.q").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a tenth of them made periodic, with the digests of their runs and collapsed texts."""
    return digests(periodic_runs(table(spark, sf_dir, "documents"), stretch=True))
