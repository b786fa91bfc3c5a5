"""Histogram gradient boosting as Spark jobs (M3, M4) and the cross-validated fits of the search (M6).

Feature values become bin numbers once (one byte each), written below the shared checkpoint folder.  A tree grows from
aggregates ``(node, feature, bin) -> sum of gradients, rows``: one job over cached blocks of rows for each batch of nodes, with
the rows counted for the smaller child only and the sibling got by subtraction.  Gradients are summed as scaled integers, so a sum, and
with it the model, does not depend on partitions or on which task is run again.  The driver holds histograms of the
nodes in hand (nodes x features x 256 numbers) and the trees.

Growth is by level to a depth, or by leaf: always the leaf of the largest gain, until the leaf limit.  The latter asks
for a batch of leaves that may come next and then takes the splits in exact best-first order; a leaf that never
comes is left a leaf.  The gain of a split and the value of a leaf are those of the second-order expansion with an L2 penalty:
``G^2 / (H + l2)`` gained over the parent, ``-G / (H + l2)``; for squared error H is the number of rows.

Several fits run in the same jobs: fits on all folds but one, over their own prepared features, and fits of different
parameters.  A row carries one byte vector for each prepared version of its features.
"""

from __future__ import annotations

import heapq
import json
import math
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlens.functions.exprs import c
from finlens.session import ensure_checkpoint_dir, scratch_path, ship_library

BINS = 255
BIN_ROWS = 100_000      # rows that bin edges are taken from, about, chosen by hash; all rows if there are fewer
PART_BYTES = 1 << 20    # of binned rows in a partition, before compression
REFRESH = 10            # trees after which the rows' predictions are checkpointed
_WORD = 1 << 32


@dataclass(frozen=True)
class Boost:
    """Parameters of a fit.  max_depth or num_leaves below 1: no such limit.  num_leaves above 0 grows by leaf."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    max_depth: int = 6
    num_leaves: int = 0
    l2: float = 1.0
    min_gain: float = 0.0
    min_rows: int = 1        # in a leaf
    subsample: float = 1.0   # share of the rows that a tree learns from, by hash of the row's key
    seed: int = 42


@dataclass
class Tree:
    """Nodes as arrays; a leaf has feature -1.  Rows with a bin up to ``bin`` (a value up to ``threshold``) go left."""

    feature: list[int]
    bin: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def arrays(self):
        return np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.right), np.array(self.value)


@dataclass
class Ensemble:
    base: float
    trees: list[Tree]


@dataclass
class Binned:
    """rows: (h, y, fold, bins): a 32-bit hash of the key, the label, the fold, a byte for each version's features."""

    rows: DataFrame
    edges: list[list[np.ndarray]]  # by version and feature, ascending
    width: int                     # features of a version
    parts: int = 1                 # partitions that the rows fill


@dataclass(frozen=True)
class Fit:
    """A fit over one version of the features, without the rows of ``held`` (a fold; None: all rows)."""

    boost: Boost
    version: int = 0
    held: int | None = None


def row_hash(key: Column) -> Column:
    """The first 32 bits of the key's md5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")


def drawn(h: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Rows that a tree learns from."""
    if share >= 1.0:
        return np.ones(len(h), bool)
    odd = np.uint64((2 * (tree * 1_000_003 + seed) + 1) * 2654435761 % _WORD)
    return (h.astype(np.uint64) * odd) % np.uint64(_WORD) < np.uint64(int(share * _WORD))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Values at every ``1 / bins`` of the sorted ones, the greatest only where values are missing: ``x <= edge`` leaves rows on
    both sides."""
    v = np.sort(values[~np.isnan(values)])
    n = np.arange(len(v), dtype=np.int64)
    e = np.unique(v[(n + 1) * bins // max(len(v), 1) > n * bins // max(len(v), 1)])
    return e if len(v) < len(values) else e[e < v[-1]] if len(v) else e


def bin_rows(df: DataFrame, versions: Sequence[str], label: str, key: Column | None = None, fold: str | None = None,
             held: Sequence[int | None] = (), bins: int = BINS, most: int = BIN_ROWS) -> Binned:
    """Bin the array columns ``versions`` of df.  A version's edges come from rows outside its fold in ``held``.  Rows without a label are left
    out; a missing value counts as greater than all others."""
    spark = df.sparkSession
    ship_library(spark)
    held = list(held) or [None] * len(versions)
    key = key if key is not None else F.concat_ws("|", *[c(v).cast("string") for v in versions], c(label).cast("string"))
    rows = df.where(c(label).isNotNull() & ~F.isnan(c(label).cast("double"))).select(
        row_hash(key).alias("h"), c(label).cast("double").alias("y"), (c(fold).cast("int") if fold else F.lit(None).cast("int")).alias("fold"),
        *[c(v).cast("array<double>").alias(f"z{i}") for i, v in enumerate(versions)])
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        # by a second hash, as h picks the rows of a tree
        share = min(_WORD, -(-_WORD * most // max(n, 1)))
        some = rows.where(F.pmod(F.xxhash64("h"), F.lit(_WORD)) < share).limit(2 * most).toPandas()
        width = len(some["z0"].iloc[0]) if len(some) else 0
        edges = []
        for i, k in enumerate(held):
            own = some if k is None else some[some["fold"] != k]
            z = np.array(own[f"z{i}"].tolist(), float).reshape(len(own), width) if len(own) else np.zeros((0, width))
            edges.append([_edges(z[:, f], bins) for f in range(width)])

        def run(batches):
            for b in batches:
                out = np.zeros((b.num_rows, len(edges) * width), np.uint8)
                for i, by_feature in enumerate(edges):
                    z = np.array([[np.nan if x is None else x for x in r] for r in b.column(3 + i).to_pylist()], float).reshape(b.num_rows, width)
                    for f, e in enumerate(by_feature):
                        out[:, i * width + f] = np.searchsorted(e, z[:, f], side="left")
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([r.tobytes() for r in out], pa.binary())], names=["h", "y", "fold", "bins"])
        path = scratch_path(spark, f"binned-{uuid.uuid4().hex[:12]}")
        parts = max(1, -(-n * (len(edges) * width + 20) // PART_BYTES))
        rows.mapInArrow(run, "h long, y double, fold int, bins binary").repartition(parts, "h").write.parquet(path)
    finally:
        rows.unpersist()
    return Binned(spark.read.schema("h long, y double, fold int, bins binary").parquet(path), edges, width, parts)


def _walk(bins: np.ndarray, feature, threshold, left, right) -> np.ndarray:
    """The node that each row of bins (or of values, with thresholds) ends in."""
    at = np.zeros(len(bins), np.int64)
    while True:
        f = feature[at]
        inner = np.flatnonzero(f >= 0)
        if not len(inner):
            return at
        a, f = at[inner], f[inner]
        down = bins[inner, f] <= threshold[a]
        at[inner] = np.where(down, left[a], right[a])


def _state(batch, version: int, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return raw[:, version * width : (version + 1) * width]


class _Growing:
    """A tree in the making: nodes with their histograms, splits found, and which nodes the next job must count."""

    def __init__(self, boost: Boost, edges: list[np.ndarray], scale: float):
        self.b, self.edges, self.scale = boost, edges, scale
        self.feature, self.bin, self.left, self.right, self.depth = [-1], [0], [-1], [-1], [0]
        self.hist: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.best: dict[int, tuple[float, int, int]] = {}
        self.total: dict[int, tuple[float, int]] = {}
        self.want = [0]                              # nodes to count
        self.pairs: list[tuple[int, int, int]] = []  # (parent, counted child, its sibling)
        self.split: set[int] = set()

    def take(self, counted: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        for node in self.want:
            self._learn(node, counted[node])
        for parent, small, other in self.pairs:
            g, n = self.hist[parent]
            self._learn(other, (g - self.hist[small][0], n - self.hist[small][1]))
            del self.hist[parent]
        self.want, self.pairs = [], []
        self._next()

    def _learn(self, node: int, hist) -> None:
        g, n = hist
        self.hist[node] = hist
        total_g, total_n = int(g[0].sum()), int(n[0].sum())
        self.total[node] = (total_g / self.scale, total_n)
        if self.b.max_depth > 0 and self.depth[node] >= self.b.max_depth:
            return
        gl, nl = np.cumsum(g, 1), np.cumsum(n, 1)
        gr, nr = total_g - gl, total_n - nl
        score = lambda s, m: np.square(s / self.scale) / np.maximum(m + self.b.l2, 1e-300)
        gain = 0.5 * (score(gl, nl) + score(gr, nr) - score(np.int64(total_g), total_n))
        usable = (nl >= max(self.b.min_rows, 1)) & (nr >= max(self.b.min_rows, 1))
        for f, e in enumerate(self.edges):
            usable[f, len(e):] = False
        gain = np.where(usable, gain, -np.inf)
        at = int(np.argmax(gain))  # of equal gains, the first feature and the least edge
        if gain.flat[at] > self.b.min_gain and gain.flat[at] > 1e-12:
            self.best[node] = (float(gain.flat[at]), at // g.shape[1], at % g.shape[1])

    def _open(self, node: int) -> None:
        """Give a node its two children and ask for the smaller one."""
        _, f, b = self.best[node]
        nl = int(self.hist[node][1][f, : b + 1].sum())
        l, r = len(self.feature), len(self.feature) + 1
        self.feature[node], self.bin[node], self.left[node], self.right[node] = f, b, l, r
        for _ in range(2):
            self.feature.append(-1), self.bin.append(0), self.left.append(-1), self.right.append(-1), self.depth.append(self.depth[node] + 1)
        small, other = (l, r) if nl * 2 <= self.total[node][1] else (r, l)
        # sums of the children, known without a count
        gl = int(self.hist[node][0][f, : b + 1].sum()) / self.scale
        g, n = self.total[node]
        self.total[l], self.total[r] = (gl, nl), (g - gl, n - nl)
        self.want.append(small)
        self.pairs.append((node, small, other))

    def _next(self) -> None:
        leaves = self.b.num_leaves
        if leaves < 1:
            for node in [k for k in self.best if self.feature[k] < 0]:
                self.split.add(node)
                self._open(node)
            if self.b.max_depth > 0 and all(self.depth[k] >= self.b.max_depth for k in self.want):
                self.want, self.pairs = [], []  # children at the last level need no counts
            return
        # the exact order: the leaf of the largest gain first; stop where a child's gain is not known yet
        heap, count, self.split = [(-self.best[0][0], 0)] if 0 in self.best else [], 1, set()
        while heap and count < leaves:
            if self.feature[heap[0][1]] < 0 and count + 1 < leaves and not self._childless(heap[0][1]):
                for _, node in heapq.nsmallest(leaves - count, heap):
                    if self.feature[node] < 0 and not self._childless(node):
                        self._open(node)
                return
            _, node = heapq.heappop(heap)
            if self.feature[node] < 0:
                self._open(node)
            self.split.add(node)
            count += 1
            for child in (self.left[node], self.right[node]):
                if child in self.best:
                    heapq.heappush(heap, (-self.best[child][0], child))
        self.want, self.pairs = [], []

    def _childless(self, node: int) -> bool:
        """Children of this node cannot be split, so they need no counts."""
        return self.b.max_depth > 0 and self.depth[node] + 1 >= self.b.max_depth

    def tree(self) -> Tree:
        """The nodes reached by the splits taken, numbered from the root."""
        t, number, todo = Tree([], [], [], [], [], []), {}, [0]
        while todo:
            node = todo.pop(0)
            number[node] = len(t.feature)
            inner = node in self.split
            f, b = (self.feature[node], self.bin[node]) if inner else (-1, 0)
            g, n = self.total[node]
            t.feature.append(f), t.bin.append(b), t.threshold.append(float(self.edges[f][b]) if inner else 0.0)
            t.left.append(self.left[node] if inner else -1), t.right.append(self.right[node] if inner else -1)
            t.value.append(0.0 if inner else -self.b.learning_rate * g / max(n + self.b.l2, 1e-300))
            todo += [self.left[node], self.right[node]] if inner else []
        t.left, t.right = [number.get(x, -1) for x in t.left], [number.get(x, -1) for x in t.right]
        return t


def boost(data: Binned, fits: Sequence[Fit]) -> list[Ensemble]:
    """Fit all of ``fits`` in the same jobs.  Without rows, or without a row outside the fold, a fit has no trees and a base of 0."""
    spark, width = data.rows.sparkSession, data.width
    ship_library(spark)
    by_fold = data.rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.min("y").alias("lo"), F.max("y").alias("hi")).collect()
    out, live = [], []
    for k, fit in enumerate(fits):
        own = [r for r in by_fold if fit.held is None or r["fold"] != fit.held]
        n = sum(r["n"] for r in own)
        out.append(Ensemble(round(math.fsum(r["s"] for r in own) / n, 12) if n else 0.0, []))
        if n and fit.boost.n_estimators > 0 and width:
            live.append(k)
    if not live:
        return out
    total = sum(r["n"] for r in by_fold)
    spread = max(max(r["hi"] for r in by_fold) - min(r["lo"] for r in by_fold), 1e-300)
    # integers that cannot overflow: gradients stay within 4 spreads, rows times the largest within 2^62
    scale = 2.0 ** min(40, 59 - total.bit_length()) / spread
    limit = 4.0 * spread * scale
    done = [0] * len(fits)        # trees already in the rows' predictions
    ensure_checkpoint_dir(spark)
    blocks = _blocks(data.rows, [e.base for e in out]).persist(StorageLevel.MEMORY_AND_DISK)
    kept, refreshes = [blocks], 0
    growing = {k: _Growing(fits[k].boost, data.edges[fits[k].version], scale) for k in live}
    try:
        while growing:
            slots = [(k, node) for k in sorted(growing) for node in growing[k].want]
            counted = _count(blocks, fits, out, done, growing, slots, width, scale, limit)
            for old in kept[:-1]:
                old.unpersist()  # that job has read the blocks with the newer predictions
            del kept[:-1]
            for k in list(growing):
                own = {node: counted[i] for i, (j, node) in enumerate(slots) if j == k}
                growing[k].take(own)
                while not growing[k].want:
                    t = growing[k].tree()
                    out[k].trees.append(t)
                    if len(out[k].trees) >= fits[k].boost.n_estimators or len(t.feature) == 1 and fits[k].boost.subsample >= 1.0:
                        del growing[k]  # enough trees, or nothing left to split
                        break
                    growing[k] = _Growing(fits[k].boost, data.edges[fits[k].version], scale)
            if growing and sum(len(out[k].trees) - done[k] for k in growing) >= len(growing):
                refreshes += 1
                blocks = _refreshed(blocks, fits, out, done, width, refreshes % REFRESH == 0)
                kept.append(blocks)
    finally:
        for old in kept:
            old.unpersist()
    return out


def _blocks(rows: DataFrame, start: list[float]) -> RDD:
    """The rows as blocks (h, y, fold, bins, predictions of every fit) of arrays, one for each Arrow batch.  The hundreds of small jobs of
    a fit run over these: a job over rows would be planned, and its rows taken apart, each time."""
    def pack(batches):
        for b in batches:
            if b.num_rows:
                own = [b.column(0).to_numpy().tobytes(), b.column(1).to_numpy().tobytes(), b.column(2).fill_null(-1).to_numpy().tobytes(), b"".join(b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in own], names=["h", "y", "fold", "bins"])

    def block(r):
        h, y, fold = (np.frombuffer(x, t) for x, t in zip(r[:3], (np.int64, np.float64, np.int32), strict=True))
        return h, y, fold, np.frombuffer(r[3], np.uint8).reshape(len(y), -1), np.tile(np.array(start), (len(y), 1))
    return rows.mapInArrow(pack, "h binary, y binary, fold binary, bins binary").rdd.map(block)


def _added(bins_of, fits, out, done, p: np.ndarray, k: int) -> np.ndarray:
    """Predictions of fit k: the stored ones and the trees since."""
    got = p[:, k].copy()
    for t in out[k].trees[done[k]:]:
        f, b, l, r, v = t.arrays()
        got += v[_walk(bins_of(fits[k].version), f, b, l, r)]
    return got


def _versions(bins: np.ndarray, width: int):
    return lambda v: bins[:, v * width : (v + 1) * width]


def _count(blocks, fits, out, done, growing, slots, width, scale, limit) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sums of gradients and rows for each asked node, feature and bin: one job."""
    now = {k: (np.array(g.feature), np.array(g.bin), np.array(g.left), np.array(g.right), len(out[k].trees)) for k, g in growing.items()}
    recent = [Ensemble(e.base, e.trees[done[k]:] if k in growing else []) for k, e in enumerate(out)]
    fresh = [0] * len(fits)
    place = {k: {node: i for i, (j, node) in enumerate(slots) if j == k} for k in growing}
    size, n_slots = width * 256, len(slots)

    def run(part):
        g_sum, n_sum = np.zeros(n_slots * size, np.int64), np.zeros(n_slots * size, np.int64)
        for h, y, fold, bins, p in part:
            bins_of = _versions(bins, width)
            for k, (f, t, l, r, tree) in now.items():
                use = drawn(h, tree, fits[k].boost.seed, fits[k].boost.subsample)
                if fits[k].held is not None:
                    use &= fold != fits[k].held
                node_slot = np.full(len(f), -1)
                for node, i in place[k].items():
                    node_slot[node] = i
                slot = node_slot[_walk(bins_of(fits[k].version), f, t, l, r)]
                at = np.flatnonzero(use & (slot >= 0))
                if not len(at):
                    continue
                g = np.rint(np.clip((_added(bins_of, fits, recent, fresh, p, k)[at] - y[at]) * scale, -limit, limit)).astype(np.int64)
                key = (slot[at] * size)[:, None] + np.arange(width)[None, :] * 256 + bins_of(fits[k].version)[at]
                np.add.at(g_sum, key.ravel(), np.repeat(g, width))
                n_sum += np.bincount(key.ravel(), minlength=len(n_sum))
        for i in range(n_slots):
            yield i, (g_sum[i * size : (i + 1) * size], n_sum[i * size : (i + 1) * size])

    sums = blocks.mapPartitions(run)
    if (parts := blocks.getNumPartitions()) > 1:
        sums = sums.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(parts, n_slots))
    sums = dict(sums.collect())  # slots x features x bins
    return [(sums[i][0].reshape(width, 256), sums[i][1].reshape(width, 256)) for i in range(n_slots)]


def _refreshed(blocks, fits, out, done, width, checkpoint: bool) -> RDD:
    """Blocks with the predictions of all finished trees, made by the next job, so that it is the last one to walk these trees;
    checkpointed now and then, so that the lineage does not grow."""
    recent = [Ensemble(e.base, e.trees[done[k]:]) for k, e in enumerate(out)]
    fresh = [0] * len(fits)

    def run(block):
        h, y, fold, bins, p = block
        bins_of = _versions(bins, width)
        return h, y, fold, bins, np.stack([_added(bins_of, fits, recent, fresh, p, k) for k in range(len(fits))], 1)
    new = blocks.map(run).persist(StorageLevel.MEMORY_AND_DISK)
    if checkpoint:
        new.checkpoint()
    for k, e in enumerate(out):
        done[k] = len(e.trees)
    return new


def held_out_scores(data: Binned, fits: Sequence[Fit], models: Sequence[Ensemble]) -> list[dict]:
    """n, r2, mae, mse of each fit on the rows of its fold, in one job."""
    width = data.width

    def run(batches):
        for b in batches:
            fold, y, versions, out = b.column(2).fill_null(-1).to_numpy(), b.column(1).to_numpy(), {}, []
            for k, fit in enumerate(fits):
                at = np.flatnonzero(fold == fit.held)
                if not len(at):
                    continue
                bins = versions.setdefault(fit.version, _state(b, fit.version, width))[at]
                p = np.full(len(at), models[k].base)
                for t in models[k].trees:
                    f, e, l, r, v = t.arrays()
                    p += v[_walk(bins, f, e, l, r)]
                d = y[at] - p
                out.append((k, len(at), y[at].sum(), np.square(y[at]).sum(), np.square(d).sum(), np.abs(d).sum()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate([pa.int32(), pa.int64()] + [pa.float64()] * 4)],
                                             names=["k", "n", "s", "q", "e", "a"])
    sums = [F.sum(x).alias(x) for x in "nsqea"]
    got = {r["k"]: r for r in data.rows.mapInArrow(run, "k int, n long, s double, q double, e double, a double").groupBy("k").agg(*sums).collect()}
    out = []
    for k in range(len(fits)):
        r = got.get(k)
        if r is None:
            out.append({"n": 0, "r2": None, "mae": None, "mse": None})
            continue
        spread = r["q"] - r["s"] ** 2 / r["n"]
        r2 = 1 - r["e"] / spread if spread > 1e-12 * max(r["q"], 1e-300) else float(r["e"] == 0)
        out.append({"n": r["n"], "r2": r2, "mae": r["a"] / r["n"], "mse": r["e"] / r["n"]})
    return out


# -- as pyspark.ml stages -----------------------------------------------------------------------
class HistogramBooster(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Histogram gradient boosting over a vector column.  ``keyCol`` names the column whose hash draws a tree's rows."""

    keyCol = Param(Params._dummy(), "keyCol", "row key (empty: the row's values)", typeConverter=TypeConverters.toString)

    def __init__(self, boost: Boost | None = None, featuresCol="features", labelCol="label", predictionCol="prediction", keyCol=""):
        super().__init__()
        self.boost = boost or Boost()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, keyCol=keyCol)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.boost = replace(self.boost)
        return that

    def _fit(self, df):
        fc, key = self.getFeaturesCol(), self.getOrDefault("keyCol")
        z = df.withColumn("__z", vector_to_array(c(fc)))
        data = bin_rows(z, ["__z"], self.getLabelCol(), key=c(key) if key and key in df.columns else None)
        model = boost(data, [Fit(self.boost)])[0]
        return HistogramBoosterModel(featuresCol=fc, predictionCol=self.getPredictionCol(), trees=dumps(model), boost=json.dumps(asdict(self.boost)))


def dumps(model: Ensemble) -> str:
    return json.dumps({"base": model.base, "trees": [asdict(t) for t in model.trees]})


def loads(text: str) -> Ensemble:
    d = json.loads(text)
    return Ensemble(d["base"], [Tree(**t) for t in d["trees"]])


class HistogramBoosterModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Scores through thresholds on the values; the trees are a text parameter, so the default ML writer keeps them."""

    trees = Param(Params._dummy(), "trees", "fitted trees as JSON", typeConverter=TypeConverters.toString)
    boost = Param(Params._dummy(), "boost", "parameters of the fit as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol=None, predictionCol=None, trees=None, boost=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def ensemble(self) -> Ensemble:
        return loads(self.getOrDefault("trees"))

    @property
    def getNumTrees(self) -> int:
        return len(self.ensemble.trees)

    def _transform(self, df):
        ship_library(df.sparkSession)
        model = df.sparkSession.sparkContext.broadcast(self.ensemble)

        @F.pandas_udf("double")
        def score(z: pd.Series) -> pd.Series:
            e = model.value
            if not len(z):
                return pd.Series([], dtype=float)
            x = np.array(z.tolist(), float)
            x = np.where(np.isnan(x), np.inf, x)
            out = np.full(len(x), e.base)
            for t in e.trees:
                out += np.array(t.value)[_walk(x, np.array(t.feature), np.array(t.threshold), np.array(t.left), np.array(t.right))]
            return pd.Series(out)
        return df.withColumn(self.getPredictionCol(), score(vector_to_array(c(self.getFeaturesCol()))))
