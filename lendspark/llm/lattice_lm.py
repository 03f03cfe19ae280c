"""Language-model scores from a subword lattice: all segmentations of a word are summed.

The pieces are those of a published vocabulary and start at its own scores. Words are
counted over all training texts; expected piece counts over the lattices of all distinct
training words then give the weights. The forward recursion, in log space, sums every way
to cut a word into pieces. A training word also passes uncut, as one edge of its own with
its discounted count; the discounts' mass goes to the cut ways, so all words and the end
of a text together have probability one. A text's score is the sum over its words and
its end. Words are scored once each; the commonest go out with the texts'
tasks, a bounded table, and all others meet their texts in a join on the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import coded, in_share, slices, table, words_of, written

START = "▁"
SCORED_AT_ONCE = 4096
PRIME = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Lattice:
    """``head``: words sent to all tasks, the bound of that table. ``rounds``: re-estimations."""

    vocabulary: str = "piece_bpe_32k.model"
    head: int = 100_000
    rounds: int = 2
    smoothing: float = 0.1
    discount: float = 0.75
    count_bytes: int = 32 << 20


class Pieces:
    """Pieces with their log weights, and lookups of substrings by a rolling hash."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        usable = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and START not in names[i][1:]]
        self.size = size
        self.longest = max(len(names[i]) for i in usable)
        hashes = np.array([self._hash(names[i]) for i in usable], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(usable)[order]
        # The vocabulary's scores are ranks; weights fall with the rank.
        scores = np.array([model.get_score(i) for i in range(size)])
        weights = np.zeros(size)
        weights[usable] = 1 / (10.0 - np.minimum(scores[usable], 0))
        weights[self.bytes] = weights[usable].min()
        self.set(weights, 0.01 * weights.sum())

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(PRIME) + ord(c) + 1) & (1 << 64) - 1
        return h

    def set(self, weights: np.ndarray, ends: float) -> None:
        """Normalise the weights of all pieces and of the end of a text together."""
        total = weights.sum() + ends
        with np.errstate(divide="ignore"):
            self.log = np.log(weights / total)
            self.end = float(np.log(ends / total)) if ends > 0 else -np.inf

    def edges(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of one length: per piece length, ids (or -1) and log weights at each start.

        Characters without a piece of their own pass as the pieces of their bytes.
        """
        length = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64) + np.uint64(1)
        found, running = [], np.zeros_like(codes)
        for n in range(1, min(self.longest, length) + 1):
            with np.errstate(over="ignore"):
                running = running[:, : length - n + 1] * PRIME + codes[:, n - 1 :]
            place = np.searchsorted(self.hashes, running).clip(max=len(self.hashes) - 1)
            ids = np.where(self.hashes[place] == running, self.ids[place], -1)
            log = np.where(ids >= 0, self.log[ids], -np.inf)
            fallback = None
            if n == 1 and (ids < 0).any():
                fallback = (ids < 0)
                chars, back = np.unique(codes[fallback], return_inverse=True)
                spelled = [chr(int(c) - 1).encode("utf-8", "surrogatepass") for c in chars]
                log[fallback] = np.array([self.log[self.bytes[list(s)]].sum() for s in spelled])[back]
            found.append((ids, log, fallback))
        return found

    def forward(self, edges: list, rows: int, length: int) -> np.ndarray:
        """Log probability of each prefix: (rows, length + 1)."""
        alpha = np.full((rows, length + 1), -np.inf)
        alpha[:, 0] = 0
        for end in range(1, length + 1):
            ways = np.stack([alpha[:, end - n] + edges[n - 1][1][:, end - n] for n in range(1, min(len(edges), end) + 1)])
            top = ways.max(axis=0)
            safe = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                alpha[:, end] = np.log(np.exp(ways - safe).sum(axis=0)) + safe
        return alpha

    def backward(self, edges: list, rows: int, length: int) -> np.ndarray:
        beta = np.full((rows, length + 1), -np.inf)
        beta[:, length] = 0
        for start in range(length - 1, -1, -1):
            ways = np.stack([beta[:, start + n] + edges[n - 1][1][:, start] for n in range(1, min(len(edges), length - start) + 1)])
            top = ways.max(axis=0)
            safe = np.where(np.isfinite(top), top, 0)
            with np.errstate(divide="ignore"):
                beta[:, start] = np.log(np.exp(ways - safe).sum(axis=0)) + safe
        return beta

    def _groups(self, words: list[str]) -> Iterator[np.ndarray]:
        """Positions of words of one length, in groups of bounded size."""
        lengths = np.array([len(w) for w in words]) + 1
        order = np.argsort(lengths, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
            step = max(1, SCORED_AT_ONCE * 16 // int(lengths[own[0]]))
            for k in range(0, len(own), step):
                yield own[k : k + step]

    def log10(self, words: list[str]) -> np.ndarray:
        """log10 of each word's probability, all segmentations summed."""
        out = np.zeros(len(words))
        for own in self._groups(words):
            some = [START + words[i] for i in own]
            out[own] = self.forward(self.edges(some), len(some), len(some[0]))[:, -1]
        return out / np.log(10)

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in these words."""
        total = np.zeros(self.size)
        for own in self._groups(words):
            some = [START + words[i] for i in own]
            length = len(some[0])
            edges = self.edges(some)
            alpha, beta = self.forward(edges, len(some), length), self.backward(edges, len(some), length)
            base = alpha[:, -1:]
            for n, (ids, log, fallback) in enumerate(edges, 1):
                share = np.exp(alpha[:, : length - n + 1] + log + beta[:, n:] - base) * counts[own][:, None]
                hit = ids >= 0
                total += np.bincount(ids[hit], weights=share[hit], minlength=self.size)
                if fallback is not None:
                    for r, c in zip(*np.nonzero(fallback), strict=True):
                        for b in some[r][c].encode("utf-8", "surrogatepass"):
                            total[self.bytes[b]] += share[r, c]
        return total


def with_whole(cut: np.ndarray, c: np.ndarray, n: int, v: int, discount: float) -> np.ndarray:
    """log10 of a word's probability: uncut by its count among n tokens of v kinds, or cut."""
    if n == 0:
        return cut
    with np.errstate(divide="ignore"):
        whole = np.log(np.maximum(c - discount, 0) / n)
    return np.logaddexp(whole, np.log(discount * v / n) + cut * np.log(10)) / np.log(10)


def counted(docs: DataFrame, settings: Lattice) -> DataFrame:
    """(word, c): every distinct word of all texts, and its count in the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", settings.count_bytes):
            words, rows = words_of(pc.ascii_lower(batch.column("text")))
            codes, distinct = coded(words)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            c = np.bincount(codes, weights=train[rows], minlength=len(distinct)).astype(np.int64)
            yield pa.record_batch([distinct.cast(pa.string()), pa.array(c)], ["word", "c"])

    partial = docs.select("held_out", "text").mapInArrow(run, "word string, c long")
    return written(partial.groupBy("word").agg(F.sum("c").alias("c")), "words")


def commonest(words: DataFrame, most: int) -> DataFrame:
    """At most ``most`` words: those above the least count bin that keeps to the bound.

    Bins are a sixteenth of a doubling wide, so their table is small for any corpus.
    """
    bin_of = F.floor(F.log2("c") * 16)
    chosen, total = None, 0
    for row in words.where("c > 1").groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("bin")).collect():
        total += row["n"]
        if total > most:
            break
        chosen = row["bin"]
    return words.where(F.lit(False) if chosen is None else (F.col("c") > 1) & (bin_of >= chosen))


def reestimated(words: DataFrame, pieces: Pieces, settings: Lattice) -> None:
    """Set the pieces' weights from their expected counts over all distinct training words.

    The cut ways serve words by their rarity, so each distinct word counts once.
    """
    spark = words.sparkSession
    known = words.where("c > 0")
    for _ in range(settings.rounds):
        shared = spark.sparkContext.broadcast(pieces)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shared.value.size)
            for batch in batches:
                total += shared.value.expected(batch.column("word").to_pylist(), np.ones(batch.num_rows))
            used = np.flatnonzero(total)
            yield pa.record_batch([pa.array(used), pa.array(total[used])], ["piece", "n"])

        weights = np.zeros(pieces.size)
        # One row per piece of the vocabulary.
        for piece, n in known.mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n")).collect():
            weights[piece] = n
        usable = np.zeros(pieces.size, bool)
        usable[pieces.ids] = usable[pieces.bytes] = True
        pieces.set(np.where(usable, weights + settings.smoothing, 0.0), 1.0)


def scored(docs: DataFrame, settings: Lattice = Lattice(), tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text", held_out=None) -> DataFrame:
    """Every row's token counts, add-one unigram score and lattice score (log10).

    A null text counts as empty and scores its end alone. Null and repeated ids keep
    their rows. Very long words are summed like others. Without training words all
    pieces weigh as the vocabulary says. Other columns are ignored.
    """
    import public_tokenizers

    out = in_share(F.col(id_column), 7, 2) if held_out is None else held_out
    texts = docs.select(F.col(id_column).alias("doc_id"), out.alias("held_out"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    spark = docs.sparkSession
    words = counted(texts, settings)
    total, distinct = words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    ends = texts.where("not held_out").count()
    n, v = (total or 0) + ends, distinct + (ends > 0)
    pieces = Pieces(tokenizer or public_tokenizers.path(settings.vocabulary))
    reestimated(words, pieces, settings)
    shared = spark.sparkContext.broadcast(pieces)

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = shared.value.log10(batch.column("word").to_pylist())
            log = with_whole(cut, batch.column("c").to_numpy(), n, v, settings.discount)
            yield pa.record_batch([batch.column("word"), batch.column("c"), pa.array(log)], ["word", "c", "log"])

    lexicon = words.mapInArrow(score_words, "word string, c long, log double")
    common = commonest(words, settings.head).collect()
    head_words = [r["word"] for r in common]
    head_c = np.array([r["c"] for r in common], np.int64)
    head = spark.sparkContext.broadcast(
        (dict(zip(head_words, range(len(head_words)), strict=True)), head_c, with_whole(pieces.log10(head_words), head_c, n, v, settings.discount))
    )
    base_of = lambda c: np.log10((c + 1) / (n + v + 1))
    end_log = with_whole(np.array([pieces.end / np.log(10)]), np.array([ends]), n, v, settings.discount)
    end = (float(base_of(ends)), float(end_log[0]), int(ends > 0))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per text with its end and common words, and one per other word of a text."""
        index, c, log = head.value
        part, row_of = TaskContext.get().partitionId() << 40, 0
        base = base_of(c)
        for batch in slices(batches, "text"):
            size = batch.num_rows
            found, rows = words_of(pc.ascii_lower(batch.column("text")))
            codes, distinct = coded(found)
            place = np.fromiter((index.get(w, -1) for w in distinct.to_pylist()), np.int64, len(distinct))
            at = place[codes] if len(codes) else codes
            known = at >= 0
            sums = lambda x: np.bincount(rows[known], weights=x[at[known]], minlength=size) if len(c) else np.zeros(size)
            keys = part + row_of + np.arange(size)
            row_of += size
            yield pa.record_batch(
                [
                    pa.array(keys), pa.array([f" {k}" for k in keys.tolist()], pa.string()), pa.array(np.zeros(size, np.int64)),
                    batch.column("doc_id"), batch.column("held_out"), pa.array(np.bincount(rows, minlength=size) + 1),
                    pa.array(np.bincount(rows[known], minlength=size) + end[2]),
                    pa.array(sums(base) + end[0]), pa.array(sums(log) + end[1]),
                ],
                names,
            )
            width = max(1, len(distinct))
            pairs, times = np.unique(rows[~known] * width + codes[~known], return_counts=True)
            none = len(pairs)
            yield pa.record_batch(
                [
                    pa.array(keys[pairs // width]), distinct.take(pa.array(pairs % width)).cast(pa.string()), pa.array(times),
                    pa.nulls(none, batch.schema.field("doc_id").type), pa.nulls(none, pa.bool_()), pa.nulls(none, pa.int64()),
                    pa.nulls(none, pa.int64()), pa.nulls(none, pa.float64()), pa.nulls(none, pa.float64()),
                ],
                names,
            )

    names = ["row", "word", "n", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
    parts = texts.mapInArrow(
        split, f"row long, word string, n long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double"
    )
    # A text's own row has a word that no text can hold, so it meets nothing and no other row.
    joined = parts.join(lexicon, "word", "left")
    c = F.coalesce("c", F.lit(0))
    base = F.coalesce("base", F.col("n") * F.log10((c + 1) / F.lit(float(n + v + 1))))
    score = F.coalesce("score", F.col("n") * F.col("log"))
    known = F.coalesce("n_known", F.when(c > 0, F.col("n")).otherwise(0))
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum(known).alias("n_known"), F.sum(base).alias("base_score"), F.sum(score).alias("score"),
    )
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op10_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))
