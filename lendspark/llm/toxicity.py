"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as its own hashed vector plus the scaled sums of its character grams'.
The network reads a window of words in both directions, and attention weights pool the
states into one logit. Windows overlap; a text's score is that of its highest window.
The network is fitted once on a bounded sample of labelled texts: each step takes the
highest window of every text in a batch, so a text's label needs to hold for one of its
windows only. Fitted weights are broadcast (their size is fixed by ``Shape``) and score
all texts, whole, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendspark.llm.common import bounded_batches, coded, in_share, mixed, ragged, releasing, slices, table, words_of

EDGE = ".,;:!?\"'()[]"


@dataclass(frozen=True)
class Shape:
    word_buckets: int = 1 << 16
    char_buckets: int = 1 << 16
    grams: tuple[int, ...] = (4, 6)
    width: int = 8
    hidden: int = 8
    window: int = 48
    stride: int = 36

    @property
    def inputs(self) -> int:
        return 2 * self.width + 1 + len(self.grams)


@dataclass(frozen=True)
class Training:
    """Bounds and settings of the fit. The sample is the only bounded part."""

    texts_per_class: int = 800
    text_chars: int = 4_000
    epochs: int = 4
    batch: int = 128
    rate: float = 0.02
    prior_weight: float = 10.0
    folds: int = 4
    seed: int = 7


Features = tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]


def word_features(words: pa.Array, shape: Shape) -> Features:
    """Of distinct words: bucket of the word; per gram length, buckets of all its grams and their number."""
    low = pc.utf8_trim(pc.utf8_lower(words), characters=EDGE)
    low = pc.utf8_rpad(pc.binary_join_element_wise("^", low, "$", ""), max(shape.grams), "$")
    sizes = pc.binary_length(low).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer("".join(low.to_pylist()).encode(), np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        marked = mixed((data + np.uint64(1)) * np.uint64(0x100000001B3) + place.astype(np.uint64))
        whole = np.add.reduceat(marked, starts) if len(sizes) else np.zeros(0, np.uint64)
    grams = []
    for n in shape.grams:
        counts = sizes - n + 1
        at = ragged(starts, counts)
        codes = np.full(len(at), n, np.uint64)
        for k in range(n):
            codes = codes << np.uint64(8) | data[at + k]
        grams.append(((mixed(codes) % np.uint64(shape.char_buckets)).astype(np.int64), counts))
    return (mixed(whole) % np.uint64(shape.word_buckets)).astype(np.int64), grams


def sigmoid(x: np.ndarray) -> np.ndarray:
    # Half of 1 + tanh(x / 2): no overflow at either end.
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters in ``p``; gates are ordered update, reset, candidate."""

    def __init__(self, shape: Shape, seed: int):
        r = np.random.default_rng(seed)
        d, h = shape.width, shape.hidden
        self.shape = shape
        normal = lambda *size, scale: (r.standard_normal(size) * scale).astype(np.float32)
        self.p = {"word": normal(shape.word_buckets, d, scale=0.1), "char": normal(shape.char_buckets, d, scale=0.1)}
        # Not trained: log odds of the labelled sample, as two more inputs.
        self.p |= {"word_odds": np.zeros(shape.word_buckets), "char_odds": np.zeros(shape.char_buckets)}
        for way in "fb":
            self.p |= {
                f"in_{way}": normal(shape.inputs, 3 * h, scale=shape.inputs**-0.5),
                f"bias_{way}": np.zeros(3 * h, np.float32),
                f"gate_{way}": normal(h, 2 * h, scale=h**-0.5),
                f"cand_{way}": normal(h, h, scale=h**-0.5),
            }
        self.p |= {
            "att": normal(2 * h, 2 * h, scale=(2 * h) ** -0.5),
            "att_v": normal(2 * h, scale=0.5),
            "out": normal(2 * h, scale=0.5),
            "out_b": np.zeros(1, np.float32),
        }

    def odds(self, features: Features, word: np.ndarray | None = None, char: np.ndarray | None = None) -> np.ndarray:
        """Log odds of each distinct word, and the scaled sums of its grams' log odds."""
        word = self.p["word_odds"] if word is None else word
        char = self.p["char_odds"] if char is None else char
        found = [word[features[0]]]
        for grams, counts in features[1]:
            total = np.add.reduceat(char[grams], np.cumsum(counts) - counts) if len(counts) else np.zeros(0)
            found.append(total / np.sqrt(counts))
        return 0.5 * np.stack(found, axis=1).astype(np.float32)

    def inputs(self, features: Features, odds: np.ndarray | None = None) -> np.ndarray:
        """Input of each distinct word: its vector, the scaled sums of its grams' vectors, the log odds."""
        word, grams = features
        d = self.shape.width
        x = np.zeros((len(word), self.shape.inputs), np.float32)
        if len(word):
            x[:, :d] = self.p["word"][word]
            for found, counts in grams:
                total = np.add.reduceat(self.p["char"][found], np.cumsum(counts) - counts, axis=0)
                x[:, d : 2 * d] += total / np.sqrt(counts)[:, None]
            x[:, 2 * d :] = self.odds(features) if odds is None else odds
        return x

    def _states(self, x: np.ndarray, valid: np.ndarray, way: str, keep: list | None) -> np.ndarray:
        """States of one direction; x: (time, rows, gates). Past the end a state stays as it is."""
        h = self.shape.hidden
        gate, cand = self.p[f"gate_{way}"], self.p[f"cand_{way}"]
        steps = range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((*x.shape[:2], h), np.float32)
        for t in steps:
            zr = sigmoid(x[t, :, : 2 * h] + state @ gate)
            z = zr[:, :h] * valid[t, :, None]
            r = zr[:, h:]
            c = np.tanh(x[t, :, 2 * h :] + (r * state) @ cand)
            if keep is not None:
                keep.append((t, state, z, r, c))
            state = state + z * (c - state)
            out[t] = state
        return out

    def forward(self, gates: dict[str, np.ndarray], valid: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """A logit per window. gates: per way (time, rows, 3h); valid: (time, rows)."""
        traces = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
        states = np.concatenate([self._states(gates[w], valid, w, traces[w]) for w in "fb"], axis=2)
        u = np.tanh(states @ self.p["att"])
        e = np.where(valid, u @ self.p["att_v"], -1e9)
        a = np.exp(e - e.max(axis=0)) * valid
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = np.einsum("tr,trk->rk", a, states)
        if keep is not None:
            keep |= {"states": states, "u": u, "a": a, "pooled": pooled, "traces": traces}
        return pooled @ self.p["out"] + self.p["out_b"][0]

    def backward(self, kept: dict, valid: np.ndarray, d_logit: np.ndarray) -> tuple[dict, dict]:
        """Gradients of the parameters behind the gates, and of the gates themselves."""
        p, h = self.p, self.shape.hidden
        states, u, a = kept["states"], kept["u"], kept["a"]
        g = {"out": kept["pooled"].T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["out"]
        d_a = np.einsum("rk,trk->tr", d_pooled, states)
        d_states = a[:, :, None] * d_pooled[None]
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        g["att_v"] = np.einsum("tr,trk->k", d_e, u)
        d_u = d_e[:, :, None] * p["att_v"] * (1 - u * u)
        g["att"] = np.einsum("tri,trj->ij", states, d_u)
        d_states = d_states + d_u @ p["att"].T
        d_gates = {}
        for at, way in ((0, "f"), (h, "b")):
            gate, cand = p[f"gate_{way}"], p[f"cand_{way}"]
            g_gate, g_cand = np.zeros_like(gate), np.zeros_like(cand)
            d_x = np.zeros((*states.shape[:2], 3 * h), np.float32)
            carried = np.zeros((states.shape[1], h), np.float32)
            for t, before, z, r, c in reversed(kept["traces"][way]):
                d = d_states[t, :, at : at + h] + carried
                d_c = d * z * (1 - c * c)
                d_rs = d_c @ cand.T
                # z is zero past the end, so its slope z (1 - z) is zero there too.
                d_zr = np.concatenate([d * (c - before) * z * (1 - z), d_rs * before * r * (1 - r)], axis=1)
                g_cand += (r * before).T @ d_c
                g_gate += before.T @ d_zr
                d_x[t, :, : 2 * h], d_x[t, :, 2 * h :] = d_zr, d_c
                carried = d * (1 - z) + d_rs * r + d_zr @ gate.T
            g[f"gate_{way}"], g[f"cand_{way}"] = g_gate, g_cand
            d_gates[way] = d_x * valid[:, :, None]
        return g, d_gates


def windows(codes: np.ndarray, rows: np.ndarray, texts: int, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word positions (time, window), which of them are real, and each window's text.

    Windows start every ``stride`` words until one reaches the end; an empty text has none.
    """
    sizes = np.bincount(rows, minlength=texts)
    starts = np.cumsum(sizes) - sizes
    count = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - shape.window) // shape.stride)), 0)
    owner = np.repeat(np.arange(texts), count)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = starts[owner] + rank * shape.stride
    at = begin[None, :] + np.arange(shape.window)[:, None]
    valid = at < (starts + sizes)[owner][None, :]
    return np.where(valid, at, 0), valid, owner


class Classifier:
    """The fitted network with its threshold at 0.5."""

    AT_ONCE = 2048

    def __init__(self, network: Network):
        self.network = network

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Highest window's probability per text, and how many windows it has."""
        net, shape = self.network, self.network.shape
        words, rows = words_of(texts)
        codes, distinct = coded(words)
        x = net.inputs(word_features(distinct, shape))
        tables = {w: x @ net.p[f"in_{w}"] + net.p[f"bias_{w}"] for w in "fb"}
        at, valid, owner = windows(codes, rows, len(texts), shape)
        best = np.full(len(texts), -np.inf)
        for k in range(0, len(owner), self.AT_ONCE):
            some = slice(k, k + self.AT_ONCE)
            own = codes[at[:, some]]
            logit = net.forward({w: tables[w][own] for w in "fb"}, valid[:, some])
            np.maximum.at(best, owner[some], logit)
        # A text without words has no window; the network's bias alone would be noise.
        return np.where(np.isfinite(best), sigmoid(np.where(np.isfinite(best), best, 0.0)), 0.0), np.bincount(
            owner, minlength=len(texts)
        )


def fit(texts: list[str], labels: list[int], shape: Shape = Shape(), training: Training = Training()) -> Classifier:
    """Fit on texts held in memory; ``distributed_sample`` bounds what arrives here."""
    net = Network(shape, training.seed)
    net.p["out_b"][0] = -2.0
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        # One class only: its constant answer.
        net.p["out"][:] = 0
        net.p["out_b"][0] = -4.0 if not len(y) or y[0] == 0 else 4.0
        return Classifier(net)
    words, rows = words_of(pa.array(texts, pa.string()))
    codes, distinct = coded(words)
    features = word_features(distinct, shape)
    # A text's own label must not reach its inputs: during training each fold of the texts
    # takes the log odds of the other folds. Scoring takes those of all.
    fold = np.arange(len(y)) % training.folds
    by_fold = [
        net.odds(features, *sample_odds(rows, codes, features, y, shape, training.prior_weight, fold != k))
        for k in range(training.folds)
    ]
    priors = np.stack(by_fold, axis=1).reshape(-1, 1 + len(shape.grams))
    net.p["word_odds"], net.p["char_odds"] = sample_odds(
        rows, codes, features, y, shape, training.prior_weight, np.ones(len(y), bool)
    )
    entries = codes * training.folds + fold[rows]
    at, valid, owner = windows(codes, rows, len(texts), shape)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    r = np.random.default_rng(training.seed)
    step = 0
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    for epoch in range(training.epochs):
        used_entries, back = np.unique(entries, return_inverse=True)
        x = net.inputs(features)[used_entries // training.folds]
        x[:, 2 * shape.width :] = priors[used_entries]
        tables = {w: x @ net.p[f"in_{w}"] + net.p[f"bias_{w}"] for w in "fb"}
        logits = np.concatenate(
            [
                net.forward({w: tables[w][back[at[:, k : k + 2048]]] for w in "fb"}, valid[:, k : k + 2048])
                for k in range(0, len(owner), 2048)
            ]
        )
        order = np.lexsort((logits, owner))
        top = order[np.append(np.diff(owner[order]) > 0, True)]
        # Beside each text's highest window, as many random windows of clean texts.
        calm = np.flatnonzero(y[owner] == 0)
        chosen = np.concatenate([top, r.choice(calm, min(len(calm), len(top)))])
        r.shuffle(chosen)
        rate = training.rate * 0.5 * (1 + np.cos(np.pi * epoch / training.epochs))
        for k in range(0, len(chosen), training.batch):
            some = chosen[k : k + training.batch]
            own, used = entries[at[:, some]], valid[:, some]
            names, back = np.unique(own, return_inverse=True)
            back = back.reshape(own.shape)
            odds, names = priors[names], names // training.folds
            grams = []
            for found, counts in features[1]:
                begin = (np.cumsum(counts) - counts)[names]
                grams.append((found[ragged(begin, counts[names])], counts[names]))
            x = net.inputs((features[0][names], grams), odds)
            gates = {w: (x @ net.p[f"in_{w}"] + net.p[f"bias_{w}"])[back] for w in "fb"}
            kept: dict = {}
            logit = net.forward(gates, used, kept)
            d_logit = ((sigmoid(logit) - y[owner[some]]) * balance[owner[some]] / len(some)).astype(np.float32)
            g, d_gates = net.backward(kept, used, d_logit)
            d_x = np.zeros_like(x)
            for w in "fb":
                per_name = np.zeros((len(names), 3 * shape.hidden), np.float32)
                np.add.at(per_name, back.ravel(), d_gates[w].reshape(-1, 3 * shape.hidden))
                g[f"in_{w}"], g[f"bias_{w}"] = x.T @ per_name, per_name.sum(axis=0)
                d_x += per_name @ net.p[f"in_{w}"].T
            step += 1
            for name, grad in g.items():
                adam(net.p[name], grad, moments[name], rate, step)
            # Vectors of words and trigrams: only the rows that took part move.
            word_rows, word_back = np.unique(features[0][names], return_inverse=True)
            grad = np.zeros((len(word_rows), shape.width), np.float32)
            np.add.at(grad, word_back, d_x[:, : shape.width])
            adam(net.p["word"], grad, moments["word"], rate, step, word_rows)
            gram_rows, gram_back = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
            scaled = [np.repeat(d_x[:, shape.width : 2 * shape.width] / np.sqrt(n)[:, None], n, axis=0) for _, n in grams]
            grad = np.zeros((len(gram_rows), shape.width), np.float32)
            np.add.at(grad, gram_back, np.concatenate(scaled))
            adam(net.p["char"], grad, moments["char"], rate, step, gram_rows)
    return Classifier(net)


def sample_odds(
    rows: np.ndarray, codes: np.ndarray, features: Features, y: np.ndarray, shape: Shape, weight: float, used: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of word buckets and of gram buckets over the texts that are ``used``."""
    keep = used[rows]
    rows, codes = rows[keep], codes[keep]
    seen = np.unique(rows * len(features[0]) + codes)
    rows, codes = seen // len(features[0]), seen % len(features[0])
    share = float(y[used].mean())
    word = log_odds(rows, features[0][codes], y, share, shape.word_buckets, weight)
    char = np.zeros(shape.char_buckets)
    for found, counts in features[1]:
        own = ragged((np.cumsum(counts) - counts)[codes], counts[codes])
        char += log_odds(np.repeat(rows, counts[codes]), found[own], y, share, shape.char_buckets, weight)
    return word, char


def log_odds(rows: np.ndarray, buckets: np.ndarray, y: np.ndarray, share: float, size: int, weight: float) -> np.ndarray:
    """Smoothed log of how much likelier a bucket's texts are labelled 1 than all texts are."""
    seen = np.unique(rows * size + buckets)
    labels = y[seen // size]
    toxic = np.bincount(seen % size, weights=labels, minlength=size)
    clean = np.bincount(seen % size, minlength=size) - toxic
    odds = (toxic + weight * share) / (clean + weight * (1 - share)) * (1 - share) / share
    return np.log(odds)


def adam(p: np.ndarray, g: np.ndarray, moments: tuple, rate: float, step: int, rows: np.ndarray | None = None) -> None:
    m, v = moments
    at = slice(None) if rows is None else rows
    m[at] = 0.9 * m[at] + 0.1 * g
    v[at] = 0.99 * v[at] + 0.01 * g * g
    p[at] -= rate * (m[at] / (1 - 0.9**step)) / (np.sqrt(v[at] / (1 - 0.99**step)) + 1e-6)


def labelled_sample(docs: DataFrame, labels: DataFrame, training: Training, held_out: int = 5) -> tuple[list[str], list[int]]:
    """At most ``texts_per_class`` texts of each label, none of them held out.

    Ids are drawn by a hash from the labels; texts longer than ``text_chars`` are not
    drawn. So the driver gets at most ``2 * texts_per_class * text_chars`` characters.
    """
    ids = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    ids = ids.where(~in_share(F.col("doc_id"), held_out, 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = [
        ids.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(training.texts_per_class)
        for label in (0, 1)
    ]
    # Bounded by the two limits above.
    chosen = F.broadcast(drawn[0].unionByName(drawn[1]))
    found = (
        docs.select("doc_id", "text").where(F.length("text") <= training.text_chars).join(chosen, "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).orderBy("doc_id").collect()
    )
    return [r["text"] for r in found], [r["toxic"] for r in found]


def score(docs: DataFrame, classifier: Classifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score, predicted and the number of windows for each row of ``docs``.

    Null, empty and blank texts have no window and score 0. Null and repeated ids keep
    their rows. Whole texts are read, however long. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found, count = shared.value.scores(batch.column("text"))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(found), pa.array((found >= 0.5).astype(np.int32)), pa.array(count)],
                ["doc_id", "score", "predicted", "n_windows"],
            )

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    bounded_batches(docs.sparkSession)
    return chosen.mapInArrow(releasing(run), f"doc_id {kind}, score double, predicted int, n_windows long")


def without_toxic(docs: DataFrame, classifier: Classifier, text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, that score below 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column, 1 << 20):
            yield batch.filter(pa.array(shared.value.scores(batch.column(text_column))[0] < 0.5))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(releasing(keep), docs.schema)


def trained(docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), training: Training = Training()) -> Classifier:
    return fit(*labelled_sample(docs, labels, training), shape, training)


def op9_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, trained(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("held_out", in_share(F.col("doc_id"), 5, 0))
