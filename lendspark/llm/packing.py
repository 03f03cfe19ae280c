"""Concatenate and cut: documents as one token stream, cut into fixed windows.

The first pass turns every text into token ids, once, and stores them with the running
offset inside their partition. The partitions' totals, one number each, become global
offsets by a prefix sum. The second pass adds them and cuts each document at the window
borders; it shuffles nothing, and every id lies in exactly one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import bounded_batches, coded, ragged, releasing, slices, table, words_of, written

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
WINDOW = 2048
ENCODE_AT_ONCE = 5_000
OTHERS_AT_ONCE = 1_000
ENCODE_BYTES = 1 << 20
KNOWN_STEMS = 1 << 19
"""Distinct words that a task keeps encoded; beyond them it begins anew, which costs time only."""
MARKS = (".", ",")

TOKENS = "doc_id {id}, part int, local long, n_tokens long, ids binary"
PIECES = (
    "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "cut_before boolean, cut_after boolean, ids binary"
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts by their words.

    The tokenizer treats white space as a border, so a text's ids are those of its words
    in order, and each distinct word is encoded once while a bounded table holds it. ASCII
    words differ by case only before the tokenizer, and a final mark after a letter is a
    token of its own; both are split off first, as this leaves fewer distinct words. Words
    of letters alone are encoded many at a time: each ends at the next id whose entry
    closes a word.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.end_id = end_id
        size = max(self.model.get_vocab_size(), end_id + 1)
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.closes = np.zeros(size, bool)
        for entry, i in self.model.get_vocab().items():
            self.closes[i] = entry.endswith("</w>")
        self.marks = [self.model.encode(m, add_special_tokens=False).ids for m in MARKS]
        # Words encoded so far, and where their ids lie.
        self.stems = pa.array([], pa.string())
        self.ids = np.zeros(0, np.int32)
        self.lengths, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of letters alone."""
        flat = [np.zeros(0, np.int64)]
        for at in range(0, len(words), ENCODE_AT_ONCE):
            some = words[at : at + ENCODE_AT_ONCE]
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(some)], some), " ")[0].as_py()
            flat.append(np.asarray(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids))
        ids = np.concatenate(flat).astype(np.int64)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        return ids, np.diff(ends, prepend=0)

    def _other(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for at in range(0, len(words), OTHERS_AT_ONCE):
            some = words[at : at + OTHERS_AT_ONCE].to_pylist()
            found.extend(e.ids for e in self.model.encode_batch_fast(some, add_special_tokens=False))
        lengths = np.array([len(x) for x in found], np.int64)
        return np.array([i for x in found for i in x], np.int64), lengths

    def _encode(self, stems: pa.Array) -> np.ndarray:
        """Add new words to the table; their places in it."""
        letters = pc.match_substring_regex(stems, r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+$")
        letters = letters.to_numpy(zero_copy_only=False)
        place = np.zeros(len(stems), np.int64)
        for chosen, encode in ((letters, self._plain), (~letters, self._other)):
            if chosen.any():
                some = stems.filter(pa.array(chosen))
                flat, length = encode(some)
                place[chosen] = len(self.stems) + np.arange(len(some))
                self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(length) - length])
                self.lengths = np.concatenate([self.lengths, length])
                self.ids = np.concatenate([self.ids, flat.astype(np.int32)])
                self.stems = pa.concat_arrays([self.stems, some])
        return place

    def _places(self, stems: pa.Array) -> np.ndarray:
        """Where in the table each of the distinct words is; new ones are encoded first."""
        if len(self.stems) + len(stems) > KNOWN_STEMS:
            self.stems, self.ids = self.stems[:0], self.ids[:0]
            self.lengths, self.starts = self.lengths[:0], self.starts[:0]
        known = pc.index_in(stems, value_set=self.stems)
        new = pc.is_null(known)
        place = pc.fill_null(known, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[new.to_numpy(zero_copy_only=False)] = self._encode(stems.filter(new))
        return place

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with the end id after each, and how many each has."""
        words, rows = words_of(texts)
        codes, distinct = coded(words)
        mark = np.zeros(len(distinct), np.int64)
        stems = distinct
        for k, m in enumerate(MARKS):
            has = pc.match_substring_regex(stems, rf"[A-Za-z\x{{DF}}-\x{{F6}}\x{{F8}}-\x{{FF}}]\{m}$")
            at = has.to_numpy(zero_copy_only=False) & (mark == 0)
            mark[at] = k + 1
            stems = pc.if_else(pa.array(at), pc.utf8_slice_codeunits(stems, 0, -1), stems)
        stems = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
        stem_codes, stems = coded(stems)
        place = self._places(stems)
        # After the words' own ids: the end id, then the marks.
        extra = [[self.end_id], *self.marks]
        base = len(self.ids)
        ids = np.concatenate([self.ids, *(np.asarray(x, np.int32) for x in extra)])
        lengths = np.concatenate([self.lengths[place], [len(x) for x in extra]])
        starts = np.concatenate([self.starts[place], base + np.cumsum([0, *map(len, extra[:-1])])])
        # The stream of entries: each word's stem, then its mark; after each text the end.
        word_mark = mark[codes]
        marked = np.flatnonzero(word_mark) + 1
        stream = np.insert(stem_codes[codes] if len(codes) else codes, marked, len(stems) + word_mark[marked - 1])
        owner = np.insert(rows, marked, rows[marked - 1])
        ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
        stream = np.insert(stream, ends, len(stems))
        owner = np.insert(owner, ends, np.arange(len(texts)))
        counts = np.bincount(owner, weights=lengths[stream], minlength=len(texts)).astype(np.int64)
        return ids[ragged(starts[stream], lengths[stream])].astype(self.kind), counts


def tokenize(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its ids, and its offset among the tokens of its partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer, end_id)
        part, local = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", ENCODE_BYTES):
            flat, counts = encoder(batch.column("text"))
            ends = np.cumsum(counts)
            data = pa.py_buffer(flat)
            borders = np.concatenate([[0], ends * flat.itemsize]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(borders), data])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(counts), part, np.int32)),
                    pa.array(local + ends - counts),
                    pa.array(counts),
                    ids,
                ],
                ["doc_id", "part", "local", "n_tokens", "ids"],
            )
            local += int(ends[-1])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(releasing(run), TOKENS.format(id=chosen.schema["doc_id"].dataType.simpleString()))


def cut(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of the stored documents in windows of ``window`` tokens."""
    spark = tokens.sparkSession
    totals = sorted(tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    # One number per input partition, whatever the partitions hold.
    bases, total = {}, 0
    for part, n in totals:
        bases[part] = total
        total += n
    offsets = spark.sparkContext.broadcast(bases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids", ENCODE_BYTES):
            n = batch.column("n_tokens").to_numpy()
            parts = batch.column("part").to_numpy()
            begin = batch.column("local").to_numpy() + np.array([offsets.value[p] for p in parts.tolist()], np.int64)
            first, last = begin // window, (begin + n - 1) // window
            count = last - first + 1
            row = np.repeat(np.arange(len(n)), count)
            sequence = ragged(first, count)
            low = np.maximum(begin[row], sequence * window)
            high = np.minimum(begin[row] + n[row], (sequence + 1) * window)
            start = low - begin[row]
            stored = [np.frombuffer(x, np.uint16 if len(x) == 2 * k else np.uint32)
                      for x, k in zip(batch.column("ids").to_pylist(), n.tolist(), strict=True)]
            ids = [stored[r][a : a + k].astype("<u4").tobytes()
                   for r, a, k in zip(row.tolist(), start.tolist(), (high - low).tolist(), strict=True)]
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(start),
                    pa.array(high - low),
                    pa.array(n[row]),
                    pa.array(sequence),
                    pa.array(low - sequence * window),
                    pa.array(start > 0),
                    pa.array(high < begin[row] + n[row]),
                    pa.array(ids, pa.binary()),
                ],
                [f.split()[0] for f in PIECES.split(", ")],
            )

    return tokens.mapInArrow(releasing(run), PIECES.format(id=tokens.schema["doc_id"].dataType.simpleString()))


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens; ``ids`` is little-endian uint32.

    Documents follow each other in reading order. Only the last sequence is padded (with
    nothing stored). A null text counts as empty: its piece is the end id alone. Null and
    repeated ids keep their rows; an empty table gives no piece. Very long texts span as
    many windows as they need. Other columns of the input are ignored.
    """
    bounded_batches(docs.sparkSession)
    tokens = tokenize(docs, tokenizer or tokenizer_path(), end_id, id_column, text_column)
    return cut(written(tokens, "tokens"), window)


def op4_concat_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "cut_before", "cut_after",
    )
