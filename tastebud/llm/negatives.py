"""Hard negatives by exact search in a multiway hyperplane tree.

Every node of the tree holds split points and deals its vectors to the nearest
one; for each split point and each sibling subtree it knows the smallest and
the largest distance between them.  A search asks for rows whose inner product
with the query lies in a window; with the norms of a subtree that window is an
annulus of distances around the query.  A sibling goes where, by the triangle
inequality, the distances that its rows have to some split point cannot meet
the annulus.  Leaves are scanned exactly, so nothing is lost whatever the data.

The split points are chosen on a sample of at most ``SAMPLE`` rows; all rows
are indexed, ranges and norms come from all rows.  Rows are range-partitioned
by (leaf, distance to the leaf's point) into buckets of about ``BUCKET_ROWS``,
so a leaf that holds a third of all rows becomes many buckets.  Queries meet a
bucket in slices of about ``SLICE_QUERIES``.  Each search looks at the query's
own bucket first; what it finds there narrows the window for all the others.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; vectors of unequal length are padded with zeros, so an
empty one has score 0; rows without an id may be found but come last among
ties and are no anchors unless ``is_anchor`` says so; each repeated row is a
row of its own; an anchor without positives, or a positive without negatives,
gives no row; an empty table gives an empty table; other columns are not read,
whatever their names.  Components whose scores might leave 2**56 raise ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

#: Rows on which split points are chosen; bound of the tree's size.
SAMPLE = 4096
#: Split points of a node, and sampled rows that a leaf may have.
FANOUT, LEAF_SAMPLE = 8, 32
#: Rows of a block (scanned at once), of a bucket (joined at once), and queries that meet a bucket in one task.
BLOCK_ROWS, BUCKET_ROWS, SLICE_QUERIES = 2048, 8192, 4096
#: Queries whose scores are held at once.
CHUNK = 256
_FAR = 1 << 60


@dataclass
class Node:
    points: np.ndarray                                  # split points
    children: list[int]                                 # a node, or -1 - leaf
    lo: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))    # [point, child]: least distance to the child's rows
    hi: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    norm_lo: np.ndarray = field(default_factory=lambda: np.zeros(0))    # [child]: least squared norm
    norm_hi: np.ndarray = field(default_factory=lambda: np.zeros(0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between all rows of ``a`` and ``b``."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def reachable(d: np.ndarray, lo: np.ndarray, hi: np.ndarray, norm: np.ndarray, norm_lo, norm_hi, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per query: whether rows at ``lo``..``hi`` from the points may have a score in the query's window.

    ``d`` [query, point] distances to the points, ``norm`` the queries' squared norms; rounding is allowed for.
    """
    inner, outer = norm + norm_lo - 2 * high, norm + norm_hi - 2 * low
    slack = 1e-9 * (norm + norm_hi + np.abs(low) + np.abs(high)) + 1e-6
    alive = outer + slack >= 0
    inner, outer = np.sqrt(np.maximum(inner - slack, 0)), np.sqrt(np.maximum(outer + slack, 0))
    room = 1e-6 * (1 + d + hi + np.sqrt(norm)[:, None])
    nearest, farthest = np.maximum(np.maximum(d - hi, lo - d), 0) - room, d + hi + room
    return alive & (nearest <= outer[:, None]).all(1) & (farthest >= inner[:, None]).all(1)


class Tree:
    """Split points, and, once ``set_ranges`` has been called, what is below each of them."""

    def __init__(self, sample: np.ndarray, seed: int = 0) -> None:
        self.nodes: list[Node] = []
        self.paths: list[list[tuple[int, int]]] = []    # per leaf: (node, child) from the root
        self.buckets: dict[int, tuple[int, int]] = {}
        self._random = np.random.default_rng(seed)
        self.root = self._grow(np.unique(sample, axis=0).astype(float), [])

    def _grow(self, rows: np.ndarray, path: list[tuple[int, int]]) -> int:
        if len(rows) <= LEAF_SAMPLE:
            self.paths.append(path)
            return -len(self.paths)
        # of a few random rows, each next point is the farthest from those chosen
        some = rows[np.sort(self._random.choice(len(rows), min(len(rows), 3 * FANOUT), replace=False))]
        chosen, gap = [0], distances(some, some[:1])[:, 0]
        while len(chosen) < FANOUT:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(some, some[chosen[-1:]])[:, 0])
        node = Node(some[chosen], [])
        at = len(self.nodes)
        self.nodes.append(node)
        own = distances(rows, node.points).argmin(1)
        for j in range(FANOUT):
            node.children.append(self._grow(rows[own == j], [*path, (at, j)]))
        return at

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        out = np.zeros(len(rows), np.int64)

        def down(at: int, idx: np.ndarray) -> None:
            if at < 0:
                out[idx] = -1 - at
                return
            own = distances(rows[idx], self.nodes[at].points).argmin(1)
            for j in np.unique(own):
                down(self.nodes[at].children[j], idx[own == j])

        if len(rows):
            down(self.root, np.arange(len(rows)))
        return out

    def points_of(self, leaf: int) -> np.ndarray:
        """All split points of the nodes above a leaf, from the root."""
        path = self.paths[leaf]
        return np.concatenate([self.nodes[n].points for n, _ in path]) if path else np.zeros((0, 0))

    def set_ranges(self, leaves: dict[int, tuple[np.ndarray, np.ndarray, float, float, int, int]]) -> None:
        """Per leaf with rows: distances to ``points_of``, squared norms, first and last bucket."""
        for n in self.nodes:
            n.lo, n.hi = np.full((FANOUT, FANOUT), np.inf), np.full((FANOUT, FANOUT), -np.inf)
            n.norm_lo, n.norm_hi = np.full(FANOUT, np.inf), np.full(FANOUT, -np.inf)
        for leaf, (lo, hi, norm_lo, norm_hi, first, last) in leaves.items():
            self.buckets[leaf] = (first, last)
            for depth, (at, j) in enumerate(self.paths[leaf]):
                n, part = self.nodes[at], slice(depth * FANOUT, (depth + 1) * FANOUT)
                n.lo[:, j], n.hi[:, j] = np.minimum(n.lo[:, j], lo[part]), np.maximum(n.hi[:, j], hi[part])
                n.norm_lo[j], n.norm_hi[j] = min(n.norm_lo[j], norm_lo), max(n.norm_hi[j], norm_hi)

    def surviving(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[list[int]]:
        """Per query: the leaves that no range has eliminated."""
        out: list[list[int]] = [[] for _ in rows]
        norm = (rows * rows).sum(1)

        def down(at: int, idx: np.ndarray) -> None:
            if at < 0:
                if -1 - at in self.buckets:
                    for i in idx:
                        out[i].append(-1 - at)
                return
            n = self.nodes[at]
            d = distances(rows[idx], n.points)
            for j, child in enumerate(n.children):
                if n.norm_hi[j] >= 0:
                    alive = reachable(d, n.lo[:, j], n.hi[:, j], norm[idx], n.norm_lo[j], n.norm_hi[j], low[idx], high[idx])
                    if alive.any():
                        down(child, idx[alive])

        if len(rows):
            down(self.root, np.arange(len(rows)))
        return out


def _vectors(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Fixed-width binaries as a matrix."""
    if not width:
        return np.zeros((len(column), 0), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


_BLOCKS = ("bucket int, leaf int, n int, rows binary, ids binary, named binary, labels binary, anchors binary, v binary, norm_lo double, "
           "norm_hi double, lo array<double>, hi array<double>")
_ARROW = {"bucket": pa.int32(), "leaf": pa.int32(), "n": pa.int32(), **dict.fromkeys(["rows", "ids", "named", "labels", "anchors", "v"], pa.binary()),
          "norm_lo": pa.float64(), "norm_hi": pa.float64(), "lo": pa.list_(pa.float64()), "hi": pa.list_(pa.float64())}
_FOUND = "row long, w int, score long, id long, hit long"


class Index:
    """All rows of a table in blocks, and the tree over them."""

    def __init__(self, df: DataFrame, key: str, vector: str, label: Column, is_anchor: Column, scale: int) -> None:
        finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))  # noqa: E731  NaN is larger
        used = label.isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))
        rows = df.where(used).select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                                     F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
                                     F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v"))
        self.rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
        size = F.greatest(F.array_max("v"), -F.array_min("v"))
        got = self.rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(size).alias("size"),
                            F.min(F.array_min("v")).alias("least"), F.count_if("anchor").alias("anchors")).first()
        self.n, self.width, self.anchors = got["n"], got["width"] or 0, got["anchors"]
        largest = max(abs(got["size"] or 0), abs(got["least"] or 0))
        self.bound = max(1, self.width) * largest * largest
        if self.bound >= 1 << 56:
            raise ValueError("components are so large that scores might not fit in 64 bits")
        self.kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
        self.tree = Tree(self._sample())
        self.blocks = stored(self._cut(), "vector-blocks")
        self._measure()

    def _sample(self) -> np.ndarray:
        """At most SAMPLE rows, evenly by hash."""
        share = min(1.0, 2 * SAMPLE / max(1, self.n))
        dice = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
        got = self.rows.where(dice < int(share * (1 << 30))).orderBy(dice, "row").limit(SAMPLE).select("v").collect()
        out = np.zeros((len(got), self.width))
        for i, r in enumerate(got):
            out[i, :len(r["v"])] = r["v"]
        return out

    def _cut(self) -> DataFrame:
        tree, kind, width = self.tree, self.kind, self.width

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = np.zeros((b.num_rows, width), kind)
                lists = b.column("v")
                sizes = np.diff(lists.offsets.to_numpy())
                v[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
                x = v.astype(float)
                leaf, near = tree.leaf(x), np.zeros(len(x))
                for n in np.unique(leaf):
                    if tree.paths[n]:
                        at, j = tree.paths[n][-1]
                        near[leaf == n] = distances(x[leaf == n], tree.nodes[at].points[j:j + 1])[:, 0]
                flat = v.tobytes()
                step = v.itemsize * width
                packed = [flat[i * step:(i + 1) * step] for i in range(len(v))]
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), b.column("label"), b.column("anchor"),
                                                  pa.array(leaf.astype(np.int32)), pa.array(near), pa.array(packed, pa.binary())],
                                                 names=["row", "id", "label", "anchor", "leaf", "near", "v"])

        def block(leaf: int, part: pa.Table) -> pa.RecordBatch:
            v = _vectors(part["v"].combine_chunks(), kind, width)
            x = v.astype(float)
            d, norm = distances(x, tree.points_of(leaf)) if tree.paths[leaf] else np.zeros((len(x), 0)), (x * x).sum(1)
            ids = part["id"].combine_chunks()
            row = {"bucket": TaskContext.get().partitionId(), "leaf": leaf, "n": len(x), "rows": part["row"].to_numpy().tobytes(),
                   "ids": ids.fill_null(0).to_numpy().tobytes(), "named": ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
                   "labels": part["label"].to_numpy().tobytes(), "anchors": part["anchor"].to_numpy().tobytes(), "v": v.tobytes(),
                   "norm_lo": norm.min(), "norm_hi": norm.max(), "lo": d.min(0), "hi": d.max(0)}
            return pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in _ARROW.items()], names=list(_ARROW))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            leaf, n = -1, 0
            for b in batches:
                own = b.column("leaf").to_numpy()
                edges = np.flatnonzero(np.diff(own)) + 1
                for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(own)], strict=True):
                    while a < z:
                        if held and (own[a] != leaf or n == BLOCK_ROWS):
                            yield block(leaf, pa.Table.from_batches(held))
                            held, n = [], 0
                        take = min(z - a, BLOCK_ROWS - n)
                        held.append(b.slice(a, take))
                        leaf, n, a = int(own[a]), n + take, a + take
            if held:
                yield block(leaf, pa.Table.from_batches(held))

        dealt = self.rows.select("row", "id", "label", "anchor", "v").mapInArrow(
            assign, "row long, id long, label long, anchor boolean, leaf int, near double, v binary")
        buckets = -(-max(1, self.n) // BUCKET_ROWS)
        order = ["leaf", "near", "row"]
        return dealt.repartitionByRange(buckets, *order).sortWithinPartitions(*order).mapInArrow(cut, _BLOCKS)

    def _measure(self) -> None:
        """Ranges and norms of every leaf; their number is bounded by the sample."""
        ranges = self.blocks.select("leaf", F.posexplode(F.arrays_zip("lo", "hi")).alias("at", "x")).groupBy("leaf", "at").agg(
            F.min("x.lo").alias("lo"), F.max("x.hi").alias("hi")).groupBy("leaf").agg(
            F.sort_array(F.collect_list(F.struct("at", "lo", "hi"))).alias("x"))
        sizes = self.blocks.groupBy("leaf").agg(*[f(c).alias(a) for f, c, a in (
            (F.min, "norm_lo", "norm_lo"), (F.max, "norm_hi", "norm_hi"), (F.min, "bucket", "first"), (F.max, "bucket", "last"))])
        of = {r["leaf"]: r["x"] for r in ranges.collect()}
        self.tree.set_ranges({r["leaf"]: (*[np.array([x[c] for x in of.get(r["leaf"], [])]) for c in ("lo", "hi")],
                                          r["norm_lo"], r["norm_hi"], r["first"], r["last"]) for r in sizes.collect()})

    def queries(self) -> DataFrame:
        """Anchors: row, id, label, v and home (their bucket)."""
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    at = np.flatnonzero(np.frombuffer(r["anchors"], bool))
                    if len(at):
                        step = len(r["v"]) // r["n"]
                        of = lambda c, t, r=r, at=at: np.frombuffer(r[c], t)[at]
                        named = of("named", bool)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(of("rows", np.int64)), pa.array(of("ids", np.int64), mask=~named), pa.array(of("labels", np.int64)),
                             pa.array([r["v"][i * step:(i + 1) * step] for i in at], pa.binary()),
                             pa.array([r["bucket"]] * len(at), pa.int32())], names=["row", "id", "label", "v", "home"])

        return stored(self.blocks.mapInArrow(pick, "row long, id long, label long, v binary, home int"), "anchors")

    def reached(self, queries: DataFrame) -> DataFrame:
        """``queries`` (v, home, low and high of each window) with all other buckets that they have to look into."""
        tree, kind, width = self.tree, self.kind, self.width

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = _vectors(b.column("v"), kind, width).astype(float)
                low = np.array([min(w) for w in b.column("low").to_pylist()], float)
                high = np.array([max(w) for w in b.column("high").to_pylist()], float)
                out = []
                for leaves, home in zip(tree.surviving(x, low, high), b.column("home").to_pylist(), strict=True):
                    spans = [np.arange(first, last + 1) for first, last in map(tree.buckets.__getitem__, leaves)]
                    found = np.unique(np.concatenate(spans)) if spans else np.zeros(0, np.int64)
                    out.append(found[found != home])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int32()))], names=[*b.schema.names, "buckets"])

        schema = queries.withColumn("buckets", F.array(F.lit(0))).schema
        return queries.mapInArrow(descend, schema).withColumn("bucket", F.explode("buckets")).drop("buckets")

    def search(self, probes: DataFrame, same: bool, k: int) -> DataFrame:
        """The best ``k`` rows of ``bucket`` for every window of every probe, of the probe's label or of the others."""
        tree, kind, width, bound = self.tree, self.kind, self.width, self.bound
        dtype = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64

        def look(blocks: pa.Table, asked: pa.Table) -> pa.Table:
            out: dict[str, list[np.ndarray]] = {c: [] for c in ("row", "w", "score", "id", "hit", "named")}
            if blocks.num_rows and asked.num_rows:
                held = blocks.to_pylist()
                for at in range(0, asked.num_rows, CHUNK):
                    _scan(held, asked.slice(at, CHUNK), out)
            joined = {c: np.concatenate(x) if x else np.zeros(0, bool if c == "named" else np.int64) for c, x in out.items()}
            return pa.table({"row": joined["row"], "w": pa.array(joined["w"], pa.int32()), "score": joined["score"],
                             "id": pa.array(joined["id"], pa.int64(), mask=~joined["named"]), "hit": joined["hit"]})

        def _scan(held: list[dict], asked: pa.Table, out: dict[str, list[np.ndarray]]) -> None:
            v = _vectors(asked["v"].combine_chunks(), kind, width)
            x, rows, labels = v.astype(float), asked["row"].to_numpy(), asked["label"].to_numpy()
            windows = max(map(len, asked["low"].to_pylist()))
            pad = lambda c, empty: np.array([[*w, *[empty] * (windows - len(w))] for w in asked[c].to_pylist()], np.int64).clip(
                -bound - 1, bound + 1)
            low, high = pad("low", _FAR), pad("high", -_FAR)
            least, most = low.min(1), high.max(1)
            norm = (x * x).sum(1)
            alive = []
            for b in held:
                points = tree.points_of(b["leaf"])
                if not len(points) or reachable(distances(x, points), np.array(b["lo"]), np.array(b["hi"]), norm, b["norm_lo"], b["norm_hi"],
                                                least.astype(float), most.astype(float)).any():
                    alive.append(b)
            if not alive:
                return
            of = lambda c, t: np.concatenate([np.frombuffer(b[c], t) for b in alive])
            hits, ids, named, own = of("rows", np.int64), of("ids", np.int64), of("named", bool), of("labels", np.int64)
            data = np.concatenate([_vectors(pa.array([b["v"]]), kind, width * b["n"]).reshape(b["n"], width) for b in alive])
            score = v.astype(dtype) @ data.astype(dtype).T
            fits = labels[:, None] == own[None, :]
            fits = fits & (rows[:, None] != hits[None, :]) if same else ~fits
            below = np.array(-bound - 2, dtype) if dtype is np.int64 else np.array(-np.inf, dtype)
            for w in range(windows):
                ok = fits & (score >= low[:, w:w + 1].astype(dtype)) & (score <= high[:, w:w + 1].astype(dtype))
                if not ok.any():
                    continue
                if score.shape[1] > k:
                    kth = np.partition(np.where(ok, score, below), score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                    ok &= score >= kth[:, None]
                i, j = np.nonzero(ok)
                value = score[i, j].astype(np.int64)
                order = np.lexsort((hits[j], ids[j], ~named[j], -value, i))
                i, j, value = i[order], j[order], value[order]
                first = np.searchsorted(i, i)
                keep = np.arange(len(i)) - first < k
                i, j, value = i[keep], j[keep], value[keep]
                for c, part in (("row", rows[i]), ("w", np.full(len(i), w)), ("score", value), ("id", ids[j]), ("hit", hits[j]), ("named", named[j])):
                    out[c].append(part)

        slices = -(-max(1, self.anchors) // SLICE_QUERIES)
        asked = probes.select("bucket", "row", "label", "v", "low", "high", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"))
        held = self.blocks.select(*[F.col(c).alias(c) for c in ("bucket", "leaf", "n", "rows", "ids", "named", "labels", "v", "norm_lo", "norm_hi", "lo", "hi")],
                                  F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
        return held.groupBy("bucket", "slice").cogroup(asked.groupBy("bucket", "slice")).applyInArrow(look, _FOUND)

    def best(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """The best ``k`` rows for every window (w) of every query: own bucket first, then all others that may beat it."""
        home = stored(top(self.search(queries.withColumn("bucket", F.col("home")), same, k), k), "found-at-home")
        full = home.groupBy("row", "w").agg(F.count(F.lit(1)).alias("got"), F.min("score").alias("worst")).where(F.col("got") == k)
        worst = full.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("w", "worst"))).alias("worst"))
        raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("worst", i), x)))
        rest = queries.join(worst, "row", "left").withColumn("low", F.when(F.col("worst").isNull(), F.col("low")).otherwise(raised)).drop("worst")
        others = self.search(self.reached(rest), same, k)
        return stored(top(home.select(*others.columns).unionByName(others), k), "found")


def top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query's window, ranked from 1."""
    by = Window.partitionBy("row", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"), "hit")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def mine(df: DataFrame, key: str, vector: str, label: Column, is_anchor: Column, scale: int = 256, n_positives: int = 5, n_negatives: int = 10,
         low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of ``floor(scale * x)``.  For each anchor and each of its first ``n_positives`` rows of the same
    label: the first ``n_negatives`` rows of other labels that score ``low`` to ``high`` percent of the positive.
    """
    index = Index(df, key, vector, label, is_anchor, scale)
    anchors = index.queries()
    bounds = lambda lo, hi: {"low": F.array(F.lit(lo).cast("long")), "high": F.array(F.lit(hi).cast("long"))}
    positives = index.best(anchors.drop("id").withColumns(bounds(-_FAR, _FAR)), True, n_positives).select(
        "row", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    floor = lambda x: F.call_function("div", x - F.pmod(x, F.lit(100).cast("long")), F.lit(100))
    ranged = positives.withColumns({"lo": -floor(-low * F.col("positive_score")), "hi": floor(high * F.col("positive_score"))}).where("lo <= hi")
    ranged = ranged.withColumn("w", F.row_number().over(Window.partitionBy("row").orderBy("rank")) - 1)
    each = ranged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("w", "lo", "hi"))).alias("x")).select(
        "row", F.col("x.lo").alias("low"), F.col("x.hi").alias("high"))
    negatives = index.best(anchors.drop("id").join(each, "row"), False, n_negatives)
    named = ranged.select("row", "w", "positive_id", "positive_score").join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return negatives.join(named, ["row", "w"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                                                      F.col("score").alias("negative_score"))
