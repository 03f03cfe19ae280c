"""Chosen-path similarity join of texts on their word shingles.

Texts with the same words are one class and are joined once. Every run samples a few of
a class's shingles, at a rate of 1 / (threshold * size), and follows each as a path: the
classes of a path share all its shingles. Paths with few classes are compared at once;
others sample again and split further. Pairs of a small path pass a size and a one-byte
min-hash filter; the texts of a path that is large to the end all pass. What passes is
kept as connecting edges. Components of many texts are split where a filter on the rarest
shingles, which drops no link, leaves nothing in common. Inside each component all texts
are compared exactly, in blocks: so no pair is dropped, and none but connecting ones is
written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendspark.llm.common import bounded_batches, coded, distinct_numbers, mixed, ngram_hashes, release, releasing, slices, string_hashes, table, words_of, written
from lendspark.llm.components import components

BINS = 64


@dataclass(frozen=True)
class Join:
    """``recall``: aimed at for a pair of equal sizes at the threshold that splits at every level.

    Where one set holds the other, the same runs find such a pair with a chance of 0.996.
    ``block_pairs``: components that take more pairs of blocks in all are split before.
    """

    threshold: float = 0.8
    shingle: int = 5
    levels: int = 4
    small: int = 32
    recall: float = 0.999
    block_chars: int = 2 << 20
    block_texts: int = 512
    block_pairs: int = 32

    @property
    def runs(self) -> int:
        """Runs until a pair at the threshold is missed by all with chance 1 - recall.

        A pair of equal sizes at Jaccard J shares 2 J / (1 + J) of its shingles, so its
        shared picks per level are Poisson with mean 2 / (1 + J), and it survives the
        levels as a branching process does.
        """
        mean, alive = 2 / (1 + self.threshold), 1.0
        for _ in range(self.levels):
            alive = 1 - math.exp(-mean * alive)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - alive))


def normal(text: Column) -> Column:
    """Lower case, words with single blanks between."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")))


def node_of(words: Column) -> Column:
    return F.unhex(F.md5(words))


def shingled(words: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of the texts, and the position of its text.

    A text of fewer words is one shingle.
    """
    found, rows = words_of(words)
    codes, distinct = coded(found)
    hashes = string_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    grams, at = ngram_hashes(hashes, rows, k)
    owner = rows[at]
    sizes = np.bincount(rows, minlength=len(words))
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    if len(short):
        first = np.cumsum(sizes) - sizes
        whole = [int(np.bitwise_xor.reduce(mixed(hashes[first[i] : first[i] + sizes[i]] + np.arange(1, sizes[i] + 1).astype(np.uint64)))) for i in short]
        grams, owner = np.append(grams, np.array(whole, np.uint64)), np.append(owner, short)
    return grams, owner


def sketches(docs: DataFrame, settings: Join, id_column: str, text_column: str) -> DataFrame:
    """Per row: its class, number of shingles, min-hash bytes, and picked shingles by level."""
    runs, levels = settings.runs, settings.levels
    seeds = mixed(np.arange(1, runs * levels + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            texts = batch.num_rows
            if texts >= 1 << 20:
                raise ValueError("a batch may hold fewer than 2 ** 20 rows")
            grams, owner = shingled(batch.column("words"), settings.shingle)
            # Distinct shingles of each text: 20 bits of its row, then 44 of the shingle's hash.
            keys = distinct_numbers(owner.astype(np.uint64) << np.uint64(44) | grams >> np.uint64(20))
            owner = (keys >> np.uint64(44)).astype(np.int64)
            count = np.bincount(owner, minlength=texts)
            bins = (keys >> np.uint64(38)).astype(np.int64)
            lowest = np.flatnonzero(np.diff(bins, prepend=-1))
            sketch = np.zeros(texts * BINS, np.uint8)
            token = mixed(keys & np.uint64((1 << 44) - 1))
            sketch[bins[lowest]] = (token[lowest] % np.uint64(255)).astype(np.uint8) + 1
            limit = (2.0**32 / (settings.threshold * np.maximum(count, 1)))[owner].clip(max=2.0**32 - 1).astype(np.uint32)
            picks = []
            for level in range(levels):
                chosen, value = [], []
                for r in range(runs):
                    with np.errstate(over="ignore"):
                        draw = ((token * seeds[level * runs + r]) >> np.uint64(32)).astype(np.uint32)
                    hit = np.flatnonzero(draw <= limit)
                    chosen.append(owner[hit])
                    value.append((np.uint64(r) << np.uint64(48)) | (token[hit] >> np.uint64(16)))
                who, what = np.concatenate(chosen), np.concatenate(value).astype(np.int64)
                order = np.argsort(who, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=texts))]).astype(np.int32)
                picks.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(what[order])))
            signature = pa.Array.from_buffers(
                pa.binary(), texts, [None, pa.py_buffer(np.arange(0, (texts + 1) * BINS, BINS, dtype=np.int32)), pa.py_buffer(sketch)]
            )
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("node"), pa.array(count.astype(np.int32)), signature, *picks],
                ["doc_id", "node", "size", "sketch", *(f"picks{k}" for k in range(levels))],
            )

    words = normal(F.col(text_column))
    chosen = docs.select(F.col(id_column).alias("doc_id"), words.alias("words"), node_of(words).alias("node"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"picks{k} array<long>" for k in range(levels))
    return chosen.mapInArrow(releasing(run), f"doc_id {kind}, node binary, size int, sketch binary, {lists}")


def paths(nodes: DataFrame, settings: Join) -> tuple[DataFrame, DataFrame]:
    """(path, node) of the small paths, and of those still large after the last level."""
    small, large = None, None
    open_paths = nodes.where("size > 0").select("node", F.explode("picks0").alias("pick"))
    open_paths = open_paths.select("node", F.shiftright("pick", 48).alias("run"), F.xxhash64("pick").alias("path"))
    for level in range(settings.levels):
        if level:
            # A text's picks travel as one array and are taken apart beside its paths.
            own = nodes.select("node", F.col(f"picks{level}").alias("picks"))
            same_run = F.filter("picks", lambda p: F.shiftright(p, 48) == F.col("run"))
            open_paths = large.join(own, "node").select("node", "run", "path", F.explode(same_run).alias("pick"))
            open_paths = open_paths.select("node", "run", F.xxhash64("path", "pick").alias("path"))
        sizes = open_paths.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # Written once for both of its readers.
        counted = written(open_paths.join(sizes, "path").select("path", "node", "run", "n"), "paths")
        now = counted.where(F.col("n") <= settings.small).select("path", "node")
        small = now if small is None else small.unionByName(now)
        large = counted.where(F.col("n") > settings.small).select("path", "node", "run")
        if large.isEmpty():
            break
    return small, large.select("path", "node")


def among(rows: DataFrame, chosen: DataFrame, key: str, buckets: int = 1024) -> DataFrame:
    """Rows of which few are not among the ``chosen`` keys: a bitmap of hashed keys tells.

    The bitmap has 4 KB a bucket, whatever the number of keys, and is broadcast; the more
    keys, the more rows pass, so a join has to follow.
    """
    bits = 8 * 4096
    spark = rows.sparkSession
    place = F.pmod(F.xxhash64(key), F.lit(buckets * bits))
    marks = chosen.select(place.alias("place")).groupBy(F.floor(F.col("place") / bits).alias("bucket"))
    marks = marks.agg(F.bitmap_construct_agg(F.col("place") % bits).alias("marks")).collect()
    table = spark.createDataFrame(marks, "bucket long, marks binary")
    at = (place % bits).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("marks"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0
    joined = rows.join(F.broadcast(table), F.floor(place / bits) == F.col("bucket"))
    return joined.where(bit).select(*rows.columns)


def candidates(nodes: DataFrame, settings: Join) -> DataFrame:
    """Edges (a, b) that connect every two texts which share a path and pass the filters.

    A small path gives a spanning forest of its pairs that pass, a large one ties all its
    texts to its least one: no path gives more edges than it has texts.
    """
    t = settings.threshold
    # Four standard deviations below the threshold; sets too small for the sketch pass.
    least = t - 4 * math.sqrt(t * (1 - t) / BINS)
    small, large = paths(nodes, settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (x.slice(at, 2048) for x in batches for at in range(0, x.num_rows, 2048))
        for batch in pieces:
            sizes = batch.column("sizes").flatten().to_numpy()
            marks = np.frombuffer(b"".join(batch.column("sketches").flatten().to_pylist()), np.uint8).reshape(-1, BINS)
            lengths = pc.list_value_length(batch.column("ids")).to_numpy()
            starts = np.cumsum(lengths) - lengths
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            # Paths of as many texts are compared at once.
            for n in np.unique(lengths[lengths > 1]).tolist():
                first, second = np.triu_indices(n, 1)
                own = starts[lengths == n]
                step = max(1, (1 << 14) // len(first))
                for begin in range(0, len(own), step):
                    a, b = (own[begin : begin + step, None] + k for k in (first, second))
                    fits = np.minimum(sizes[a], sizes[b]) >= t * np.maximum(sizes[a], sizes[b])
                    path, a, b = np.nonzero(fits)[0], a[fits], b[fits]
                    x, y = marks[a], marks[b]
                    equal, filled = ((x == y) & (x > 0)).sum(axis=1), ((x | y) > 0).sum(axis=1)
                    ok = (np.minimum(sizes[a], sizes[b]) < 2 * BINS) | (equal >= least * filled)
                    path, a, b = path[ok], a[ok], b[ok]
                    alone = np.bincount(path, minlength=1)[path] == 1
                    left.append(a[alone])
                    right.append(b[alone])
                    path, a, b = path[~alone], a[~alone], b[~alone]
                    ends = np.flatnonzero(np.diff(path, append=-1)) + 1
                    for low, high in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False):
                        at = own[begin + path[low]]
                        linked = np.zeros((n, n), bool)
                        linked[a[low:high] - at, b[low:high] - at] = True
                        edges = np.array(forest(linked | linked.T)) + at
                        left.append(edges[:, 0])
                        right.append(edges[:, 1])
            ids = batch.column("ids").flatten()
            ends = [ids.take(pa.array(np.concatenate(x))) for x in (left, right)]
            yield pa.record_batch(ends, ["a", "b"])

    # A small path has at most ``small`` texts.
    members = small.join(nodes.select("node", "size", "sketch"), "node").groupBy("path").agg(
        F.collect_list(F.struct("node", "size", "sketch")).alias("x")
    )
    members = members.select(F.col("x.node").alias("ids"), F.col("x.size").alias("sizes"), F.col("x.sketch").alias("sketches"))
    heads = large.groupBy("path").agg(F.min("node").alias("a"))
    tied = large.join(heads, "path").select("a", F.col("node").alias("b")).where("a <> b")
    edges = members.mapInArrow(releasing(run), "a binary, b binary").unionByName(tied)
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric relation."""
    free, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not free[root]:
            continue
        free[root] = False
        stack = [root]
        while stack:
            i = stack.pop()
            for j in np.flatnonzero(linked[i] & free).tolist():
                free[j] = False
                edges.append((i, j))
                stack.append(j)
    return edges


def weighed(texts: DataFrame, settings: Join) -> DataFrame:
    """(component, blocks, chars) of the texts' components."""
    totals = texts.groupBy("component").agg(F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.greatest(F.col("chars") / settings.block_chars, F.col("n") / settings.block_texts)).cast("int")
    return totals.where("n > 1").select("component", F.greatest(blocks, F.lit(1)).alias("blocks"), "chars")


def shingle_lists(texts: DataFrame, settings: Join) -> DataFrame:
    """(node, component, grams) of the texts, grams distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            grams, owner = shingled(batch.column("words"), settings.shingle)
            order = np.lexsort((grams, owner))
            grams, owner = grams[order], owner[order]
            new = np.ones(len(grams), bool)
            new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=batch.num_rows))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams[new].view(np.int64)))
            yield pa.record_batch([batch.column("node"), batch.column("component"), lists], ["node", "component", "grams"])

    chosen = texts.select("node", "component", "words")
    return chosen.mapInArrow(releasing(run), "node binary, component binary, grams array<long>")


def rare_ties(sets: DataFrame, settings: Join) -> DataFrame:
    """Edges (a, b) that connect every two linked texts of a component; few others.

    Of sets at the threshold t each has ceil(t * size) shingles of the other, so in any
    order they share one of the first size - ceil(t * size) + 1 of each. Here the rarest of
    the component come first; those of one text alone take places, but are never shared.
    Texts that share a place are tied in order of size, unless their sizes rule out a link.
    """
    t = settings.threshold
    # What rounding could take from a similarity at the threshold is no reason to drop it.
    least = lambda size: t * size - 1e-6
    size = F.size("grams").alias("size")
    rows = sets.select("node", "component", size, F.explode("grams").alias("gram"))
    rows = rows.select("node", "size", F.xxhash64("component", "gram").alias("token"))
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = rows.join(often, "token").groupBy("node", "size").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("x"))
    room = (F.size("x") - F.ceil(least(F.col("size"))) + 1).cast("int")
    places = shared.withColumn("room", room).where("room > 0")
    places = places.select("node", "size", F.explode(F.slice("x", 1, F.col("room"))).alias("x")).select("node", "size", "x.token")
    by_size = Window.partitionBy("token").orderBy("size", "node")
    places = places.withColumn("lower", F.lag("size").over(by_size))
    begins = F.coalesce(F.col("lower") < least(F.col("size")), F.lit(True))
    head = F.last(F.when(begins, F.col("node")), ignorenulls=True).over(by_size)
    return places.select(head.alias("a"), F.col("node").alias("b")).where("a <> b").distinct()


def split(texts: DataFrame, settings: Join) -> DataFrame:
    """The texts (node, words, chars, copies, component) with large components split.

    The candidates chain texts that share a passage or a few words, the more the larger the
    table, and comparing them grows with the square. Components of many blocks are formed
    anew from ``rare_ties``, so that no link is lost; texts without a tie leave.
    """
    before = None
    while True:
        large = written(weighed(texts, settings).where("blocks > 1").select("component", "blocks"), "large")
        pairs = large.agg(F.sum(F.col("blocks").cast("double") * (F.col("blocks") + 1) / 2)).first()[0] or 0
        # What stays together is close; splitting it again saves little.
        if pairs <= settings.block_pairs or (before is not None and pairs > before / 2):
            return texts
        before = pairs
        # A component of them has a block of texts at least.
        those = F.broadcast(large.select("component"))
        chained = texts.join(those, "component", "left_semi")
        sets = written(shingle_lists(chained, settings), "shingles")
        parts = components(rare_ties(sets, settings), "a", "b")
        parted = written(chained.drop("component").join(parts, "node"), "texts")
        texts = texts.join(those, "component", "left_anti").unionByName(parted)


def similarities(words: pa.Array, k: int, first: int = 0) -> np.ndarray:
    """Jaccard similarity of the texts' shingle sets, each with each.

    With ``first``, only of the first so many texts with the others; the rest is 0.
    """
    n = len(words)
    grams, owner = shingled(words, k)
    names, gram = np.unique(grams, return_inverse=True)
    pairs = distinct_numbers(owner.astype(np.int64) * len(names) + gram)
    owner, gram = pairs // len(names), pairs % len(names)
    sizes = np.bincount(owner, minlength=n).astype(np.float64)
    both = np.zeros((n, n))
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    # Shingles of one text alone are in no intersection.
    shared = np.bincount(gram, minlength=len(names)) > 1
    keep = shared[gram]
    owner, gram = owner[keep], (np.cumsum(shared) - 1)[gram[keep]]
    step = max(1, (8 << 20) // max(1, n))
    for low in range(0, int(shared.sum()), step):
        a, b = np.searchsorted(gram, [low, low + step])
        dense = np.zeros((n, min(step, int(shared.sum()) - low)), np.float32)
        dense[owner[a:b], gram[a:b] - low] = 1
        if first:
            both[:first, first:] += dense[:first] @ dense[first:].T
        else:
            both += dense @ dense.T
    if first:
        both[first:, :first] = both[:first, first:].T
    return both / (sizes[:, None] + sizes[None, :] - both)


def verified(texts: DataFrame, settings: Join) -> DataFrame:
    """Exact links of the texts (node, words, chars, copies, component) within each component.

    Components are compared in blocks of bounded text: each pair of blocks is one group,
    and small components share a group. A group returns its texts' numbers of linked
    rows, and edges that connect what is linked, never all pairs. Rows: node, linked,
    and an edge's other end ``b`` with its similarity, or null.
    """
    t, k = settings.threshold, settings.shingle
    totals = written(weighed(texts, settings), "totals")
    many = totals.where("blocks = 1").agg(F.sum("chars")).first()[0] or 0
    groups = max(1, math.ceil(many / settings.block_chars))
    # Broadcast: components of more than one block have a block of texts each.
    large = F.broadcast(totals.where("blocks > 1").select("component", "blocks"))
    dealt = texts.join(large, "component", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "partner"), F.greatest("own", "partner")
    one = F.col("blocks") == 1
    unit = F.when(one, F.pmod(F.xxhash64("component"), F.lit(groups))).otherwise(F.xxhash64("component", low, high))
    dealt = dealt.select(one.alias("one"), unit.alias("unit"), "component", low.alias("low"), high.alias("high"), "own", "node", "copies", "words")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("component", "low", "high", "own")]).combine_chunks()
        keys = list(zip(*(group.column(c).to_pylist() for c in ("component", "low", "high")), strict=True))
        node, linked, other, score = [], [], [], []
        start = 0
        while start < len(keys):
            stop = start
            while stop < len(keys) and keys[stop] == keys[start]:
                stop += 1
            part = group.slice(start, stop - start)
            _, lo, hi = keys[start]
            start = stop
            ids, own = part.column("node").to_pylist(), part.column("own").to_numpy()
            words = part.column("words").combine_chunks()
            words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
            first = int(np.count_nonzero(own == lo)) if lo != hi else 0
            if first == len(ids) or (lo != hi and not first):
                continue
            ok = (near := similarities(words, k, first)) >= t
            np.fill_diagonal(ok, False)
            total = ok @ part.column("copies").to_numpy()
            edges = dict((j, i) for i, j in forest(ok))
            for i in np.flatnonzero(total).tolist():
                node.append(ids[i])
                linked.append(int(total[i]))
                at = edges.get(i)
                other.append(None if at is None else ids[at])
                score.append(None if at is None else float(near[i, at]))
            del near, ok
        release()
        return pa.table(
            [pa.array(node, pa.binary()), pa.array(linked, pa.int64()), pa.array(other, pa.binary()), pa.array(score, pa.float64())],
            ["node", "linked", "b", "similarity"],
        )

    return dealt.groupBy("one", "unit").applyInArrow(run, "node binary, linked long, b binary, similarity double")


@dataclass(frozen=True)
class Joined:
    """``members``: doc_id, node, size per row; ``classes``: node, copies, first_id;
    ``links``: a, b, similarity that connect all linked texts; ``counts``: node, linked rows."""

    members: DataFrame
    classes: DataFrame
    links: DataFrame
    counts: DataFrame


def jaccard_join(
    docs: DataFrame, settings: Join = Join(), id_column: str = "doc_id", text_column: str = "text"
) -> Joined:
    """All links between different texts of ``docs``, and which rows each text has.

    Null, empty and blank texts have no shingle and link to nothing. Texts that differ in
    case or white space alone are one class. Null and repeated ids are kept as rows;
    other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    rows = written(sketches(docs, settings, id_column, text_column), "sketches")
    kept = ["size", "sketch", *(f"picks{k}" for k in range(settings.levels))]
    members = rows.select("doc_id", "node", "size")
    nodes = rows.groupBy("node").agg(F.first(F.struct(*kept)).alias("x")).select("node", "x.*")
    nodes = written(nodes, "nodes")
    classes = members.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"))
    # Any two texts that could be linked are in one component of the candidates.
    near = components(candidates(nodes, settings), "a", "b")
    near = written(near.join(classes.select("node", "copies"), "node"), "candidates")
    words = normal(F.col(text_column))
    texts = docs.select(node_of(words).alias("node"), words.alias("words"))
    texts = among(texts, near, "node").join(near.select("node").hint("merge"), "node", "left_semi")
    texts = texts.groupBy("node").agg(F.first("words").alias("words")).withColumn("chars", F.length("words"))
    texts = split(written(texts.join(near, "node"), "texts"), settings)
    found = written(verified(texts, settings), "links")
    links = found.where("b is not null").select(F.col("node").alias("a"), "b", "similarity")
    return Joined(members, classes, links, found.groupBy("node").agg(F.sum("linked").alias("linked")))


def resolved(joined: Joined) -> DataFrame:
    """(node, copies, first_id, component) of every text; alone, a text is its own component."""
    found = components(joined.links, "a", "b")
    facts = joined.classes.join(found, "node", "left")
    return written(facts.withColumn("component", F.coalesce("component", "node")), "classes")


def classified(joined: Joined) -> DataFrame:
    """doc_id, class_id (least id of its component), n_links (rows linked) of every row.

    Copies count as links of each other; a text without words is a class of its own and
    has none.
    """
    facts = resolved(joined)
    heads = facts.groupBy("component").agg(F.min("first_id").alias("class_id"))
    n_links = F.col("copies") - 1 + F.coalesce("linked", F.lit(0))
    facts = facts.join(heads, "component").join(joined.counts, "node", "left").select("node", "class_id", n_links.alias("n_links"))
    rows = joined.members
    out = rows.where("size > 0").join(facts, "node").select("doc_id", "class_id", "n_links")
    alone = rows.where("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def one_per_class(
    docs: DataFrame, settings: Join = Join(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs``, whole, with one row of each class: that of the least id.

    Texts without words are kept. A repeated row is kept once.
    """
    joined = jaccard_join(docs, settings, id_column, text_column)
    facts = resolved(joined)
    kept = facts.groupBy("component").agg(F.min_by("node", F.struct("first_id", "node")).alias("kept_node"))
    ids = joined.members.join(kept, joined.members["node"] == kept["kept_node"])
    ids = ids.groupBy("kept_node").agg(F.min("doc_id").alias("kept_id"))
    same = joined.members.join(ids, (F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
    counts = written(same.groupBy("kept_node", "kept_id").agg(F.count(F.lit(1)).alias("times")), "kept")
    words = normal(F.col(text_column))
    # Names that no column of the rows has.
    names = {}
    for name in ("kept_node", "kept_id", "times"):
        names[name] = name
        while names[name] in docs.columns:
            names[name] += "_"
    counts = counts.withColumnsRenamed(names)
    node, kept_id, times = (F.col(names[c]) for c in ("kept_node", "kept_id", "times"))
    of_row = (node_of(words) == node) & F.col(id_column).eqNullSafe(kept_id)
    full = docs.where(words != "")
    out = docs.where(words == "").unionByName(full.join(counts.where(times == 1), of_row, "left_semi"))
    repeated = counts.where(times > 1)
    if not repeated.isEmpty():
        rows = full.join(repeated, of_row, "left_semi").withColumn(names["kept_node"], node_of(words))
        out = out.unionByName(rows.dropDuplicates([names["kept_node"]]).drop(names["kept_node"]))
    return out


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(jaccard_join(table(spark, sf_dir, "documents")))
