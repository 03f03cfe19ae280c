"""Periodic runs against a plain search, on random, planted and hard texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm import periodic


def plain(w):
    """Runs by trying every period at every place."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                part = w[i : i + length]
                if not any(part[d:] == part[: length - d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(i + 1, j)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def found(df):
    rows = periodic.digests(periodic.periodic_runs(df, stretch=True)).select(COLUMNS).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 6])
def test_random_words(alphabet):
    random.seed(alphabet)
    for _ in range(300):
        texts = []
        for _ in range(random.randint(1, 4)):
            n = random.randint(0, 90)
            w = [random.randrange(alphabet) for _ in range(n)]
            if n and random.random() < 0.7:
                a, p = random.randrange(n), random.randint(1, 21)
                w = [w[i] if i < a else w[a + (i - a) % min(p, n - a)] for i in range(n)]
            texts.append(w)
        codes = np.array([x for w in texts for x in w], np.int64)
        rows = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        begins = np.cumsum([0, *map(len, texts)])
        want = sorted((b + s, length, q) for b, w in zip(begins.tolist(), texts) for s, length, q in plain(w))
        got = sorted(zip(*(x.tolist() for x in periodic.stretches(codes, rows)), strict=True))
        assert got == want


def test_hard_texts(spark):
    # 10, 31 and 44 hash to a multiple of ten and are stretched; ids cover both kinds.
    spaced = "a\t b\x0b\x0ca\r\nb a b a b a b"
    texts = [
        None, "", " \n\t ", "a", "a " * 5, "a " * 6, "x " + "a b " * 4 + "y", spaced, "é é é é é é ü",
        "a b c " * 4 + "a", "p q " * 6 + "p p p p p p", "a " * 20_000,
        " ".join(f"w{i}" for i in range(30_000)), " ".join(f"w{i % 977}" for i in range(9_000)),
        "r s t u v r s t u v r s t u v r s t u v z " * 6,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i + 40, t) for i, t in enumerate(texts[:11])]
    rows += [(None, "a b " * 5), (6, texts[6]), (6, texts[6])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df = df.withColumn("runs", F.lit("x")).withColumn("crc", F.lit(1)).withColumn("n_words", F.lit(None).cast("int"))
    quick = [(i, t) for i, t in rows if len(t or "") < 5_000]
    got = found(df)
    assert [r for r in got if r[0] not in {11, 12, 13}] == sorted((expected(*r) for r in quick), key=str)
    by_id = {r[0]: r for r in got}
    assert by_id[11][1:6] == (1, 0, 20_000, 1, 20_000_000)
    if zlib.crc32(b"13") % 10:
        assert by_id[13][1:5] == (1, 0, 9_000, 977)


def test_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = found(docs)
    want = sorted((expected(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"] or "") < 8_000), key=str)
    ids = {r[0] for r in want}
    assert len(ids) > 100 and sum(r[1] for r in want) > 5
    assert [r for r in got if r[0] in ids] == want


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_outputs_are_real(spark):
    df = spark.createDataFrame([("k", "so so so so so so it goes on and on")], "name string, body string")
    row = periodic.periodic_runs(df, "name", "body").first()
    assert row["collapsed"] == "so it goes on and on"
    assert [tuple(r) for r in row["runs"]] == [(0, 6, 1)]
