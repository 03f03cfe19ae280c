"""What several text operators share: word splitting in Arrow, hashes, scratch tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.session import scratch_path

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20
"""Text handled at once inside a task; longer batches are cut into slices of rows."""


BATCH_BYTES = 4 << 20
"""Text in one Arrow batch: what a task hands to its Python worker at once."""


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in this session, unless it says itself how large they may be.

    Rows alone bound a batch otherwise, so that long texts make it large on both sides.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def release() -> None:
    """Give back what this process holds of free memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Of the C library on Linux; others have no such call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(work):
    """A step of ``mapInArrow`` after which the worker, which waits for other tasks, gives back free memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, which survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_share(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about ``limit`` bytes of text, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and per word the position of its text. Null has none."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = parts.flatten()
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    full = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(full), rows[full.to_numpy(zero_copy_only=False)]


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Code of each word, and the distinct words by code."""
    if len(words) == 0:
        return np.zeros(0, np.int64), words
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def string_hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash per string, the same in every task and batch."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


def distinct_numbers(x: np.ndarray) -> np.ndarray:
    """Distinct numbers in ascending order; sorting beats the hash table of ``np.unique``."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def ngram_hashes(word_hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n-gram that lies within one text, and the position of its first word."""
    count = len(word_hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(count, np.uint64)
        for k in range(n):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + word_hashes[k : k + count] + np.uint64(k + 1))
    at = np.flatnonzero(rows[:count] == rows[n - 1 :])
    return total[at], at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start+1, ... of every segment, one segment after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
