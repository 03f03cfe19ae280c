"""Shards of near equal bytes by Karmarkar-Karp differencing of indivisible groups.

Rows with equal texts form a group. Groups are dealt into buckets of bounded size; in each
a task repeatedly combines the two partial partitions of largest spread, one in opposite
order, until one is left. The buckets' partitions are combined the same way, level by
level, and each level stores how its slots map to the next.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.llm.common import table, written


@dataclass(frozen=True)
class Shards:
    """``fan``: partial partitions one task combines. ``chunk``: rows numbered together."""

    count: int = 40
    fan: int = 4096
    chunk: int = 50_000
    row_bytes: int = 16


def differenced(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of each vector's slots in the joint partition, and its sums by label, descending.

    Each vector holds the sums of a partial partition.
    """
    n, k = vectors.shape
    order = np.argsort(-vectors, axis=1, kind="stable")
    sums = {i: v for i, v in enumerate(np.take_along_axis(vectors, order, axis=1))}
    heap = [(-int(v[0] - v[-1]), i) for i, v in sums.items()]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joint = sums.pop(a) + sums.pop(b)[::-1]
        by_size = np.argsort(-joint, kind="stable")
        joint = joint[by_size]
        made.append((a, b, by_size))
        sums[n + len(made) - 1] = joint
        heapq.heappush(heap, (-int(joint[0] - joint[-1]), n + len(made) - 1))
    labels = {heap[0][1]: np.arange(k)}
    total = sums[heap[0][1]]
    for c in range(len(made) - 1, -1, -1):
        a, b, by_size = made[c]
        own = labels.pop(n + c)
        labels[a], labels[b] = np.empty(k, np.int64), np.empty(k, np.int64)
        labels[a][by_size] = own
        labels[b][k - 1 - by_size] = own
    out = np.empty((n, k), np.int64)
    for i in range(n):
        out[i, order[i]] = labels[i]
    return out, total


def combined(nodes: DataFrame, settings: Shards, leaves: bool) -> DataFrame:
    """Rows (id, bucket, labels) of the nodes, and one (null, bucket, sums) per bucket."""
    k = settings.count
    kind = nodes.schema["id"].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id").combine_chunks()
        ids, bucket = group.column("id"), group.column("bucket")[0].as_py()
        if leaves:
            vectors = np.zeros((len(ids), k), np.int64)
            vectors[:, 0] = group.column("bytes").to_numpy()
            labels, sums = differenced(vectors)
            labels = labels[:, :1]
        else:
            labels, sums = differenced(np.array(group.column("sums").to_pylist(), np.int64))
        return pa.table(
            [
                pa.array([*ids.to_pylist(), None], ids.type),
                pa.array([bucket] * (len(ids) + 1), pa.int64()),
                pa.array([*labels.tolist(), sums.tolist()], pa.list_(pa.int64())),
            ],
            ["id", "bucket", "numbers"],
        )

    return nodes.groupBy("bucket").applyInArrow(run, f"id {kind}, bucket long, numbers array<long>")


def assigned(groups: DataFrame, settings: Shards = Shards()) -> DataFrame:
    """(id, shard) for groups (id, bytes), shards within about a group's size of each other."""
    n = groups.count()
    buckets = max(1, -(-n // settings.fan))
    dealt = groups.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("long"))
    level = written(combined(dealt, settings, True), "differences")
    placed = level.where("id is not null").select("id", "bucket", F.col("numbers")[0].alias("slot"))
    while buckets > 1:
        partial = level.where("id is null").select(F.col("bucket").alias("id"), F.col("numbers").alias("sums"))
        buckets = -(-buckets // settings.fan)
        partial = partial.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("long"))
        level = written(combined(partial, settings, False), "differences")
        upper = level.where("id is not null").select(F.col("id").alias("bucket"), F.col("bucket").alias("above"), "numbers")
        placed = placed.join(upper, "bucket").select("id", F.col("above").alias("bucket"), F.col("numbers")[F.col("slot").cast("int")].alias("slot"))
    return placed.select("id", F.col("slot").cast("int").alias("shard"))


def sharded(docs: DataFrame, settings: Shards = Shards(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; equal texts share a shard.

    A null text counts as empty. Null and repeated ids keep their rows; ties of size
    follow a hash of the text. An empty table gives no rows. A group larger than a fair
    shard cannot be split and has a shard of its own. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.unhex(F.md5(text)).alias("id"),
        (F.octet_length(text).cast("long") + settings.row_bytes).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = written(rows, "sizes")
    groups = rows.groupBy("id").agg(F.sum("size").alias("bytes"))
    placed = written(assigned(groups, settings), "shards")
    chunks = max(1, -(-rows.count() // (settings.count * settings.chunk)), 8)
    where = rows.join(placed, "id").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "id"), F.lit(chunks)).cast("int"))
    where = written(where, "placed")
    counts = where.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    number = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "id"))
    numbered = where.withColumn("rank", number).join(counts, ["shard", "chunk"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"))


def op8_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharded(table(spark, sf_dir, "documents"))
    return found.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))
