"""Hard-negative mining over exact integer scores.

Scores come from a matrix product in a residue number system: the integer vectors are
reduced modulo several small primes, multiplied per prime in float32, where every sum
stays below 2^24 and is thus exact, and the signed scores are reconstructed by Chinese
remaindering. Anchors are taken in blocks of bounded size; each block meets all rows, which
stay where they are, and only the best few of each task are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt, prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.llm.common import table
from lendspark.session import scratch_path

SCALE = 256
LABELS = 10
ANCHOR_EVERY = 100
MOVED_EVERY = 7
POSITIVES = 5
NEGATIVES = 5
WINDOW = (80, 100)
"""A negative's score lies between these percentages of the positive's."""

DIMENSIONS_TOGETHER = 64
"""Products added in one float32 sum."""
ANCHORS_TOGETHER = 4096
ANCHOR_BYTES = 32 << 20
"""Anchors of a block: the lesser of the two bounds what is broadcast."""
CELLS = 1 << 20
"""Scores that a task holds at once."""

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def moduli() -> list[int]:
    """Primes p, greatest first, whose residues in (-p/2, p/2) keep a float32 sum within 2^24.

    As many as a product below 2^52 allows, so that reconstruction is exact in float64.
    """
    most = 2 * isqrt((1 << 24) // DIMENSIONS_TOGETHER) + 1
    found: list[int] = []
    for p in range(most, 2, -1):
        if all(p % d for d in range(2, isqrt(p) + 1)):
            if prod(found) * p >= 1 << 52:
                break
            found.append(p)
    return found


def enough_moduli(bound: float) -> list[int]:
    """The fewest primes that tell all integers of at most this size apart."""
    primes = moduli()
    for k in range(1, len(primes) + 1):
        if prod(primes[:k]) > 2 * bound + 1:
            return primes[:k]
    raise OverflowError(f"scores may reach {bound:.3g}; the most that is exact here is {prod(primes) // 2}")


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Residues modulo an odd p, between -p/2 and p/2."""
    return x - p * np.rint(x / p)


def product(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """``a @ b.T`` of integers held as float64, exact while its size is below half the primes' product."""
    result, known = np.zeros((len(a), len(b))), 1
    for p in primes:
        left, right = centred(a, p).astype(np.float32), centred(b, p).astype(np.float32)
        total = np.zeros(result.shape)
        for at in range(0, a.shape[1], DIMENSIONS_TOGETHER):
            part = slice(at, at + DIMENSIONS_TOGETHER)
            total += left[:, part] @ right[:, part].T
        digit = centred(centred(total - result, p) * pow(known, -1, p), p) if known > 1 else centred(total, p)
        result += known * digit
        known *= p
    return result


class Vectors:
    """Rows of a batch that take part, with their label and integer components."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        vectors = batch.column("embedding")
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        n = len(vectors)
        lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(n), lengths)
        good = np.bincount(rows[~np.isfinite(flat)], minlength=n) == 0
        for name in ("vec_id", "label", "embedding"):
            good &= batch.column(name).is_valid().to_numpy(zero_copy_only=False)
        width = int(lengths.max()) if n else 0
        dense = np.zeros((n, width))
        dense[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        ids = pc.fill_null(batch.column("vec_id"), 0).to_numpy().astype(np.int64)[good]
        labels = pc.fill_null(batch.column("label"), 0).to_numpy().astype(np.int64)[good]
        # Equal scores rank by id: rows in the order of their ids make position the tie-breaker.
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        moved = np.fmod(labels[order] + 1, LABELS)
        self.labels = np.where(self.ids % MOVED_EVERY == 0, moved, labels[order])
        self.values = np.floor(SCALE * dense[good][order])

    def part(self, start: int, stop: int) -> Vectors:
        some = object.__new__(Vectors)
        some.ids, some.labels, some.values = (
            x[start:stop] for x in (self.ids, self.labels, self.values)
        )
        return some


def scores(anchors: Vectors, rows: Vectors) -> np.ndarray:
    """Integer inner products, anchors by rows. A shorter vector counts as filled up with zeros."""
    shared = min(anchors.values.shape[1], rows.values.shape[1])
    a, b = anchors.values[:, :shared], rows.values[:, :shared]
    norms = [float(np.sqrt(np.square(x).sum(axis=1).max(initial=0))) for x in (a, b)]
    return product(a, b, enough_moduli(norms[0] * norms[1] * (1 + 1e-9))).astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first of each group by score, then id."""
    order = np.lexsort((ids, -score, group))
    group = group[order]
    first = np.searchsorted(group, group)
    return order[np.arange(len(order)) - first < k]


LEAST = np.iinfo(np.int64).min


def ranked(anchors: Vectors, rows: Vectors, allowed: np.ndarray) -> np.ndarray:
    """One sortable number per anchor and row: score, then the lesser id. ``LEAST`` if not allowed."""
    n = len(rows.ids)
    return np.where(allowed, scores(anchors, rows) * n + np.arange(n - 1, -1, -1), LEAST)


def positive_candidates(anchors: Vectors, rows: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, score, id) of the first rows of the same label, other than the anchor."""
    n = len(rows.ids)
    other = (anchors.labels[:, None] == rows.labels) & (anchors.ids[:, None] != rows.ids)
    keys = ranked(anchors, rows, other)
    if n > POSITIVES:
        keys = np.partition(keys, n - POSITIVES, axis=1)[:, n - POSITIVES :]
    at, column = np.nonzero(keys != LEAST)
    found = keys[at, column]
    return at, found // n, rows.ids[n - 1 - found % n]


def negative_candidates(
    anchors: Vectors, positives: np.ndarray, rows: Vectors
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor and positive, score, id) of the first rows of other labels inside each window.

    ``positives`` holds each anchor's positive scores, ``LEAST`` where there are fewer.
    """
    n = len(rows.ids)
    keys = np.sort(ranked(anchors, rows, anchors.labels[:, None] != rows.labels), axis=1)
    groups, found_scores, found_ids = [], [], []
    every = np.arange(len(anchors.ids))
    for j in range(positives.shape[1]):
        top = positives[:, j]
        known = top != LEAST
        top = np.where(known, top, 0)
        least = -((-WINDOW[0] * top) // WINDOW[1])
        below = (keys <= (top * n + n - 1)[:, None]).sum(axis=1)
        for back in range(1, NEGATIVES + 1):
            at = below - back
            key = keys[every, np.maximum(at, 0)]
            score = key // n
            chosen = known & (at >= 0) & (key != LEAST) & (score >= least)
            groups.append(every[chosen] * POSITIVES + j)
            found_scores.append(score[chosen])
            found_ids.append(rows.ids[n - 1 - key[chosen] % n])
    return np.concatenate(groups), np.concatenate(found_scores), np.concatenate(found_ids)


def _per_task(rows: DataFrame, block, find, keep: int) -> DataFrame:
    """(group, score, vec_id): the best of every task for each group of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, *rest = block.value
        step = min(8192, max(64, CELLS // max(1, len(anchors.ids))))
        held, size = [], 0
        most = 4 * keep * POSITIVES * max(1, len(anchors.ids))

        def folded():
            group, score, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            chosen = best(group, score, ids, keep)
            return [(group[chosen], score[chosen], ids[chosen])]

        for batch in batches:
            vectors = Vectors(batch)
            for at in range(0, len(vectors.ids), step):
                found = find(anchors, *rest, vectors.part(at, at + step))
                held.append(found)
                size += len(found[0])
                if size > most:
                    held = folded()
                    size = len(held[0][0])
        if held:
            group, score, ids = folded()[0]
            yield pa.record_batch(
                [pa.array(group.astype(np.int32)), pa.array(score), pa.array(ids)],
                ["grp", "score", "vec_id"],
            )

    return rows.mapInArrow(run, "grp int, score long, vec_id long")


def _first(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("grp").orderBy(F.desc("score"), "vec_id")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def anchor_blocks(rows: DataFrame) -> Iterator[Vectors]:
    """The anchors, dealt out by a hash of their id in blocks of bounded size.

    Equal anchor rows are asked once.
    """
    anchors = rows.where((F.col("vec_id") % ANCHOR_EVERY == 0) & F.col("label").isNotNull())
    anchors = anchors.where(F.col("embedding").isNotNull()).distinct()
    n, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n:
        return
    # A hash spreads evenly but for chance, which the half leaves room for.
    together = max(1, min(ANCHORS_TOGETHER, ANCHOR_BYTES // (8 * max(1, width))) // 2)
    blocks = -(-n // together)
    for b in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b) if blocks > 1 else anchors
        block = Vectors(mine.toArrow())
        if len(block.ids):
            yield block


def mine(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every anchor and positive, as ``op11`` of the contract defines them.

    A row with a null id, label or vector, or with a component that is null or not finite,
    takes no part. Every other row counts as itself, also when it repeats; equal anchor rows
    are asked once, and a row with the anchor's id is not its positive. Vectors of
    different lengths are compared as if filled up with zeros, an empty one scores 0.
    Equal scores rank by the smaller id. An empty table, or one without anchors, gives no
    rows. Further columns are ignored. Scores beyond 5e14 raise ``OverflowError``.
    Each block's rows are written to the shared folder, so a lost executor costs one block.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select("vec_id", "label", "embedding")
    path = scratch_path(spark, "negatives")
    done = False
    for number, anchors in enumerate(anchor_blocks(rows)):
        shared = spark.sparkContext.broadcast((anchors,))
        found = _first(_per_task(rows, shared, positive_candidates, POSITIVES), POSITIVES).toArrow()
        at = found["grp"].to_numpy()
        place = found["rank"].to_numpy() - 1
        top = np.full((len(anchors.ids), POSITIVES), LEAST)
        top[at, place] = found["score"].to_numpy()
        shared = spark.sparkContext.broadcast((anchors, top))
        chosen = _first(_per_task(rows, shared, negative_candidates, NEGATIVES), NEGATIVES)
        # One line per anchor and positive of the block.
        names = spark.createDataFrame(
            pa.table({
                "grp": pa.array((at * POSITIVES + place).astype(np.int32)),
                "anchor_id": pa.array(anchors.ids[at]),
                "positive_id": found["vec_id"],
                "positive_score": found["score"],
            })
        )
        result = chosen.join(F.broadcast(names), "grp").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        result.write.parquet(f"{path}/block={number}")
        done = True
    if not done:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(path).drop("block")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 100; the windows are 80 to 100 percent."""
    return mine(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
    WITH raw AS (
        SELECT vec_id, label, embedding,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM raw),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
               CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
        FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score
        FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    found AS (
        SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank
        FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
         AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM found WHERE rank <= 5"""
