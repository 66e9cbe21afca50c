"""N-gram Jaccard join with a MinHash LSH forest.

Documents become sets of hashed 5-word shingles; equal sets are one class of
copies (``node``).  Each node has one key per prefix tree: eight symbols of
eight bits, the first symbol highest, so that ordering the keys is the trie and
a shift shortens a prefix.  Matched prefixes are shortened from full length
until a pair at the threshold is found with the target recall.  Nodes that
share a shortened prefix in some tree are candidates, and every candidate pair
is verified on the exact shingle sets.

Nothing is expanded to all pairs: trees are stars around each prefix's smallest
node, candidate components are verified inside tasks that hold a bounded number
of shingles, and components beyond that bound are verified prefix by prefix in
pairs of bounded blocks (a pair counts in the first tree where it meets).  Tasks
return link counts and a spanning forest only.

Results per row: ``class_id`` (smallest id of its connected near-duplicates),
``copies`` (rows with an equal shingle set) and ``n_links`` (other rows whose
similarity reaches the threshold).  Nodes are 64-bit fingerprints of the sets.

Defined results: texts of fewer words than a shingle are one shingle; texts
without words (null, empty) link to nothing and are their own class; repeated
rows are copies; null ids never become a class id unless the class has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordbytes as W
from .tables import lookup, stored, unused

TREES = 24
SYMBOLS = 8
#: Shingles and nodes that one verifying task holds per block.
BLOCK_SHINGLES = 2_000_000
BLOCK_NODES = 512
_RNG = np.random.default_rng(20240229)
_MUL = _RNG.integers(0, 1 << 31, TREES * SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, TREES * SYMBOLS, dtype=np.uint32)
_SYMBOL = np.uint32(0x9E3779B1)


def prefix_length(threshold: float, recall: float, trees: int = TREES, symbols: int = SYMBOLS) -> int:
    """Shorten the prefix until a pair at the threshold meets in some tree with the target recall."""
    for length in range(symbols, 0, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    return 1


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    return np.unique(W.windows(h, min(width, len(h)))) if len(h) else np.zeros(0, np.uint64)


def fingerprint(s: np.ndarray) -> int:
    total = W.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(W.mix(np.array([total]))[0].astype(np.int64))


def tree_keys(sets: list[np.ndarray]) -> np.ndarray:
    """TREES keys for each non-empty set."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    keys = np.zeros((len(sets), TREES), np.uint64)
    for k in range(TREES * SYMBOLS):
        least = np.minimum.reduceat(low * _MUL[k] + _ADD[k], starts)
        symbol = ((least * _SYMBOL) >> np.uint32(24)).astype(np.uint64)
        keys[:, k // SYMBOLS] |= symbol << np.uint64(8 * (SYMBOLS - 1 - k % SYMBOLS))
    return keys


def signatures(df: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """Per row: id, th (hash of the text), node, n (shingles), trees; node is null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 250):
                rows = batch.slice(lo, 250)
                raw, off = W.text_bytes(rows.column(2))
                w = W.words(raw, off, W.ALNUM)
                at = w.bounds
                sets = [shingles(w.hashes[at[i]:at[i + 1]], width) for i in range(rows.num_rows)]
                full = [i for i, s in enumerate(sets) if len(s)]
                node: list = [None] * len(sets)
                trees: list = [None] * len(sets)
                if full:
                    keys = tree_keys([sets[i] for i in full]).view(np.int64)
                    for i, k in zip(full, keys, strict=True):
                        node[i], trees[i] = fingerprint(sets[i]), k
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(node, pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(trees, pa.list_(pa.int64()))],
                    names=["id", "th", "node", "n", "trees"])

    kind = df.schema[id_col].dataType.simpleString()
    return _keyed(df, id_col, text).mapInArrow(run, f"id {kind}, th long, node long, n long, trees array<long>")


def _keyed(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("th"), F.col(text).alias("t"))


def _sets(df: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of rows (id, th, t) that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 250):
                raw, off = W.text_bytes(batch.slice(lo, 250).column(2))
                w = W.words(raw, off, W.ALNUM)
                at = w.bounds
                sets = [s for i in range(len(at) - 1) if len(s := shingles(w.hashes[at[i]:at[i + 1]], width))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"])

    return df.select("id", "th", "t").mapInArrow(run, "node long, shingles binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node with an edge (a, b): root is the component's smallest node."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")),
                    f"{name}-labels")
    while True:
        seen = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("least")))
        moved = labels.join(seen, F.col("node") == F.col("a")).select(
            "node", F.least("root", "least").alias("root"), F.col("root").alias("old"))
        hop = moved.select(F.col("node").alias("via"), F.col("root").alias("far"))
        now = stored(moved.join(hop, F.col("root") == F.col("via")).select(
            "node", F.least("root", "far").alias("root"), "old"), f"{name}-labels")
        labels = now.select("node", "root")
        if now.where("root <> old").isEmpty():
            return labels


def candidates(members: DataFrame) -> DataFrame:
    """(node, root) of every node of ``members`` (node, lead): components of the stars around the leads.

    A node joins its leads (at most one per tree) to the smallest of them, so
    only leads enter the search for components; each node follows its smallest lead.
    """
    led = stored(members.groupBy("node").agg(F.collect_set("lead").alias("leads")).select(
        "node", F.array_min("leads").alias("head"), "leads"), "leads")
    links = led.select(F.col("head").alias("a"), F.explode("leads").alias("b")).where("a <> b").distinct()
    heads = led.groupBy("head").agg(F.count(F.lit(1)).alias("held"))
    rooted = components(links, "candidates").withColumnRenamed("node", "head")
    table = stored(heads.join(rooted, "head", "left").withColumn("root", F.coalesce("root", "head")), "heads")
    return stored(lookup(led.select("node", "head"), table, "head", "held", F.xxhash64("node")).select("node", "root"),
                  "candidates")


def _intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[i] and b[i]."""
    if len(a) <= 4:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                         for i, j in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    held = shared[column]
    owner, column = owner[held], number[column[held]]
    total = np.zeros(len(a), np.int64)
    for lo in range(0, int(shared.sum()), 1 << 15):
        here = (column >= lo) & (column < lo + (1 << 15))
        bits = np.zeros((len(sets), 1 << 15), bool)
        bits[owner[here], column[here] - lo] = True
        packed = np.packbits(bits, axis=1)[:, :-(-min(1 << 15, int(shared.sum()) - lo) // 8)]
        for p in range(0, len(a), 8192):
            total[p:p + 8192] += np.bitwise_count(packed[a[p:p + 8192]] & packed[b[p:p + 8192]]).sum(axis=1, dtype=np.int64)
    return total


def _verify(tree: int, side: np.ndarray, node: np.ndarray, copies: np.ndarray, keys: np.ndarray,
            sets: list[np.ndarray], shift: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node (copies counted) and its smallest linked node; tree -1: pairs of every tree."""
    prefix = keys >> np.uint64(shift)
    a, b = np.triu_indices(len(node), 1)
    apart = (side[a] == 2) | (side[a] != side[b])
    a, b = a[apart], b[apart]
    if tree < 0:
        meet = np.zeros(len(a), bool)
        for t in range(prefix.shape[1]):
            meet |= prefix[a, t] == prefix[b, t]
    else:
        meet = np.ones(len(a), bool)
        for t in range(tree):
            meet &= prefix[a, t] != prefix[b, t]
    a, b = a[meet], b[meet]
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    if len(a):
        size = np.array([len(s) for s in sets], np.int64)
        common = _intersections(sets, a, b)
        near = common >= threshold * (size[a] + size[b] - common) - 1e-9
        a, b = a[near], b[near]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        while len(a):
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            root = root[root]
            if (before == root).all():
                break
    return links, node[root]


def _verified(groups: DataFrame, shift: int, threshold: float) -> DataFrame:
    """(node, links, root) per group of rows (tree, prefix, left, right, side, node, copies, trees, shingles)."""

    def flush(rows: list[dict]) -> Iterator[tuple[int, int, int]]:
        rows = sorted({(r["node"], r["side"]): r for r in rows}.values(), key=lambda r: r["node"])
        if len(rows) < 2:
            return
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        node = np.array([r["node"] for r in rows], np.int64)
        links, root = _verify(rows[0]["tree"], np.array([r["side"] for r in rows]), node,
                              np.array([r["copies"] for r in rows], np.int64),
                              np.array([r["trees"] for r in rows], np.int64).view(np.uint64), sets, shift, threshold)
        for i in np.flatnonzero(links).tolist():
            yield int(node[i]), int(links[i]), int(root[i])

    def batchify(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                          names=["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        at = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                done: list[tuple[int, int, int]] = []
                for r in batch.slice(lo, 500).to_pylist():
                    here = (r["tree"], r["prefix"], r["left"], r["right"])
                    if here != at:
                        done.extend(flush(held))
                        held, at = [], here
                    held.append(r)
                yield batchify(done)
        yield batchify(list(flush(held)))

    key = ["tree", "prefix", "left", "right"]
    return groups.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "node long, links long, root long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5, threshold: float = 0.8,
                    recall: float = 0.9995) -> DataFrame:
    """Per row: id_col, text_hash, class_node, class_id, copies, n_links (see the module).

    ``class_node`` tells classes apart where ids repeat; it is null without words.
    """
    shift = 8 * (SYMBOLS - prefix_length(threshold, recall))
    rows = stored(signatures(df, id_col, text, width), "signatures")
    nodes = stored(rows.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "th"))).alias("rep"),
        F.min("th").alias("any"), F.first("n").alias("n"), F.first("trees").alias("trees")), "nodes")
    forest = nodes.select("node", "n", F.posexplode("trees").alias("tree", "key")).select(
        "node", "n", "tree", F.shiftrightunsigned("key", shift).alias("prefix"))
    shared = forest.groupBy("tree", "prefix").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("weight"), F.min("node").alias("lead")).where("members > 1")
    members = stored(forest.drop("n").join(shared, ["tree", "prefix"]), "prefixes")
    near = candidates(members)
    known = nodes.join(near, "node")
    size = known.groupBy("root").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("m"))
    fits = (F.col("w") <= 2 * BLOCK_SHINGLES) & (F.col("m") <= 2 * BLOCK_NODES)
    whole = (near.join(size.where(fits), "root").select(
        F.lit(-1).alias("tree"), F.col("root").alias("prefix"), F.lit(0).alias("left"), F.lit(0).alias("right"),
        F.lit(2).alias("side"), "node"))
    blocks = F.greatest(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK_NODES)).cast("int")
    big = members.join(near.join(size.where(~fits), "root").select("node"), "node", "left_semi").select(
        "tree", "prefix", "node", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("own"))
    big = big.select("tree", "prefix", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    split = big.select("tree", "prefix", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
                       side.alias("side"), "node")
    # texts of one row per candidate node, cut into shingles again
    reps = known.select(F.col("rep.id").alias("rid"), F.coalesce("rep.th", "any").alias("rth"))
    keyed = _keyed(df, id_col, text)
    texts = keyed.join(reps, keyed["id"].eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth")), "left_semi")
    sets = stored(_sets(texts, width), "shingles").join(known.select("node", "copies", "trees"), "node")
    groups = whole.unionByName(split).join(sets, "node")
    found = stored(_verified(groups, shift, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")), "classes")
    rooted = nodes.select("node", "copies", F.col("rep.id").alias("first_id")).join(classes, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    table = stored(rooted.join(smallest, "root").join(links, "node", "left").select(
        "node", "copies", "root", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    joined = lookup(rows.select("id", "th", "node"), table, "node", "copies", F.xxhash64("id", "th"))
    return joined.select(
        F.col("id").alias(id_col), F.col("th").alias("text_hash"), F.col("root").alias("class_node"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` that represent their class: the one with the smallest id (a repeated row stays once)."""
    alone = F.concat_ws("/", F.lit("row"), F.col(id_col).cast("string"), F.col("text_hash").cast("string"))
    chosen = found.groupBy(F.coalesce(F.col("class_node").cast("string"), alone).alias("g")).agg(
        F.min(F.struct(F.col(id_col).isNull().alias("no"), F.col(id_col).alias("i"), F.col("text_hash").alias("h"))).alias("c")
    ).select(F.col("c.i").alias(i := unused("class_first", df)), F.col("c.h").alias(h := unused("class_hash", df)))
    kept = df.join(chosen, F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(F.col(text)) == F.col(h)), "left_semi")
    twice = found.groupBy(F.col(id_col).alias("a"), F.col("text_hash").alias("b")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if twice.isEmpty():
        return kept
    return kept.dropDuplicates([id_col, text])
