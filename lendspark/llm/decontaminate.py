"""Benchmark passages in training texts: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the test items are counted over all texts; each item keeps as seeds all that
some text holds, except those that texts hold everywhere, such as stop phrases. Seed hits of a text and an item that lie near one diagonal give a window, and
the item is aligned with it locally, word by word, so edited copies score high too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lendspark.llm.common import bounded_batches, coded, ngram_hashes, releasing, slices, string_hashes, table, words_of

EDGE = ".,;:!?\"'()[]*#$%&|<>"


@dataclass(frozen=True)
class Alignment:
    """``common``: an n-gram held by more than this share of the texts is a stop phrase and no
    seed, unless it is among the ``kept`` share of its item's n-grams that fewest texts hold;
    n-grams in fewer than ``rare`` texts always are seeds.
    ``score``: least alignment score as a share of the item's own."""

    seed: int = 4
    kept: float = 0.75
    common: float = 0.01
    rare: int = 1000
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    score: float = 0.5
    block_chars: int = 16 << 20


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash per word, without case and outer marks, and the position of its text."""
    words, rows = words_of(texts)
    codes, distinct = coded(words)
    hashes = string_hashes(pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGE))
    return (hashes[codes] if len(codes) else np.zeros(0, np.uint64)), rows


class Items:
    """Items of one block with their n-grams, sorted by hash."""

    def __init__(self, ids: list, texts: list, n: int):
        self.ids = ids
        hashes, rows = word_hashes(pa.array(texts, pa.string()))
        self.words = np.split(hashes, np.searchsorted(rows, np.arange(1, len(texts)))) if texts else []
        found = [np.zeros((0, 3), np.uint64)]
        # Items shorter than n words are seeded by all their words together.
        self.lengths = sorted({min(n, len(w)) for w in self.words if len(w)})
        for k, w in enumerate(self.words):
            if len(w):
                size = min(n, len(w))
                grams, at = ngram_hashes(w, np.zeros(len(w), np.int64), size)
                found.append(np.stack([grams, np.full(len(at), k, np.uint64), at.astype(np.uint64)], axis=1))
        self._set(np.concatenate(found))

    def _set(self, seeds: np.ndarray) -> None:
        seeds = seeds[np.argsort(seeds[:, 0], kind="stable")]
        self.item, self.at = seeds[:, 1].astype(np.int64), seeds[:, 2].astype(np.int64)
        self.hashes, self.first, self.count = np.unique(seeds[:, 0], return_index=True, return_counts=True)
        self.seeds = seeds

    def choose(self, texts_with: np.ndarray, texts: int, a: Alignment) -> None:
        """Drop n-grams that no text holds, and each item's stop phrases beyond its rarer part.

        What an edited copy still holds is thus a seed, unless it is common everywhere.
        """
        frequency = np.repeat(texts_with, self.count)
        held = frequency > 0
        self._set(self.seeds[held])
        frequency = frequency[held]
        order = np.lexsort((self.at, frequency, self.item))
        sizes = np.bincount(self.item, minlength=len(self.ids))
        rank = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rarer = rank < np.ceil(a.kept * np.repeat(sizes, sizes))
        self._set(self.seeds[order[rarer | (frequency[order] <= max(a.rare, a.common * texts))]])

    def hits(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word position and seed number of every n-gram that is a seed."""
        at, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in self.lengths:
            grams, begin = ngram_hashes(hashes, rows, n)
            place = np.searchsorted(self.hashes, grams).clip(max=max(0, len(self.hashes) - 1))
            hit = np.flatnonzero(self.hashes[place] == grams) if len(self.hashes) else np.zeros(0, np.int64)
            at.append(begin[hit])
            which.append(place[hit])
        return np.concatenate(at), np.concatenate(which)


def align(text: np.ndarray, item: np.ndarray, a: Alignment) -> tuple[int, int, int]:
    """Best local score, and the first and last word of ``text`` in it (inclusive)."""
    n = len(text)
    score, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = -a.gap * np.arange(n + 1)
    best, low, high = 0, 0, -1
    for word in item:
        fit = score[:-1] + np.where(text == word, a.match, a.mismatch)
        drop = score[1:] + a.gap
        now = np.concatenate([[0], np.maximum(np.maximum(fit, drop), 0)])
        start = np.concatenate([[0], np.where(fit >= drop, begin[:-1], begin[1:])])
        start = np.where(now > 0, start, np.arange(n + 1))
        # Gaps in the item: a running maximum along the text, less the steps walked.
        lifted = now + steps
        top = np.maximum.accumulate(lifted)
        origin = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        score = top - steps
        begin = np.where(score > 0, start[origin], np.arange(n + 1))
        k = int(score.argmax())
        if score[k] > best:
            best, low, high = int(score[k]), int(begin[k]), k - 1
    return best, low, high


def found_in(hashes: np.ndarray, rows: np.ndarray, items: Items, a: Alignment) -> list[tuple]:
    """(row, item, score, first word, last word) of the best window per text and item."""
    at, which = items.hits(hashes, rows)
    if not len(at):
        return []
    count = items.count[which]
    place = np.repeat(items.first[which] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    at = np.repeat(at, count)
    item, offset = items.item[place], items.at[place]
    row = rows[at]
    diagonal = at - offset
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal = row[order], item[order], diagonal[order]
    sizes = np.array([len(w) for w in items.words])
    slack = np.maximum(4, sizes // 4)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (np.diff(diagonal) > slack[item[1:]])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(row)) - 1
    text_end = np.searchsorted(rows, row[starts], side="right")
    text_start = np.searchsorted(rows, row[starts], side="left")
    best: dict[tuple, tuple] = {}
    for s, e, lo, hi in zip(starts, ends, text_start, text_end, strict=True):
        k = item[s]
        low = max(lo, diagonal[s] - slack[k])
        high = min(hi, diagonal[e] + sizes[k] + slack[k])
        # Each match needs a word of the item in the window: too few, and no alignment can reach the score.
        if np.isin(items.words[k], hashes[low:high]).sum() < a.score * sizes[k]:
            continue
        score, first, last = align(hashes[low:high], items.words[k], a)
        share = score / (a.match * sizes[k])
        key = (int(row[s]), int(k))
        if share >= a.score and share > best.get(key, (0,))[0]:
            best[key] = (share, int(low - lo + first), int(low - lo + last))
    return [(r, k, *v) for (r, k), v in best.items()]


def seeded_blocks(texts: DataFrame, items: DataFrame, settings: Alignment, item_id: str, item_text: str) -> Iterator:
    """The items in broadcast blocks of bounded size, each with its seeds."""
    spark = texts.sparkSession
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / settings.block_chars))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        seeds = Items([r["item_id"] for r in rows], [r["text"] or "" for r in rows], settings.seed)
        counting = spark.sparkContext.broadcast(seeds)

        def count(batches: Iterator[pa.RecordBatch], shared=counting) -> Iterator[pa.RecordBatch]:
            items = shared.value
            size = max(1, len(items.hashes))
            total, texts = np.zeros(size, np.int64), 0
            for batch in slices(batches, "text"):
                texts += batch.num_rows
                hashes, rows = word_hashes(batch.column("text"))
                at, which = items.hits(hashes, rows)
                total += np.bincount(np.unique(rows[at] * size + which) % size, minlength=size)
            seen = np.flatnonzero(total)
            # The number of texts goes along as seed -1.
            yield pa.record_batch([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], texts))], ["seed", "n"])

        counted = texts.select("text").mapInArrow(releasing(count), "seed long, n long").groupBy("seed").agg(F.sum("n"))
        texts_with = np.zeros(len(seeds.hashes) + 1, np.int64)
        for seed, n in counted.collect():  # at most a row per seed of the block
            texts_with[seed] = n
        seeds.choose(texts_with[:-1], int(texts_with[-1]), settings)
        yield spark.sparkContext.broadcast(seeds)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    settings: Alignment = Alignment(),
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) for each text and item that align.

    Items go out in blocks of at most about ``block_chars`` characters, each against all
    texts, so what a task holds does not grow with the number of items. Texts or items
    that are null, empty or blank align with nothing. Null ids and repeated rows keep
    their results, one per row. Other columns are ignored.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type, item_type = texts.schema["doc_id"].dataType, items.schema[item_id].dataType
    item_kind = to_arrow_type(item_type)
    found = []
    for shared in seeded_blocks(texts, items, settings, item_id, item_text):

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in slices(batches, "text"):
                out = found_in(*word_hashes(batch.column("text")), items, settings)
                row, item, score, first, last = zip(*out, strict=True) if out else [[]] * 5
                yield pa.record_batch(
                    [
                        batch.column("doc_id").take(pa.array(row, pa.int64())),
                        pa.array([items.ids[k] for k in item], item_kind),
                        pa.array(score, pa.float64()),
                        pa.array(first, pa.int64()),
                        pa.array(last, pa.int64()),
                    ],
                    ["doc_id", "item_id", "score", "first_word", "last_word"],
                )

        schema = f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, score double, first_word long, last_word long"
        found.append(texts.mapInArrow(search, schema))
    return reduce(DataFrame.unionByName, found)


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    settings: Alignment = Alignment(),
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, whole, that align with no item."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(text_column).alias("text"))
    for shared in seeded_blocks(texts, items, settings, item_id, item_text):

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_column):
                clean = np.ones(batch.num_rows, bool)
                clean[[row for row, *_ in found_in(*word_hashes(batch.column(text_column)), shared.value, settings)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(releasing(keep), docs.schema)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
