"""Embedding near-duplicates by product quantisation.

Vectors are scaled to length 1; equal ones are one class.  Coarse centroids and residual codebooks are fitted on a
bounded sample; every class is indexed: its list, its residual's codes, and the length of its quantisation error.
Neighbouring lists are packed into tiles of bounded size.  A class is compared with its own tile and with every tile
that holds a list which geometry does not rule out (the plane between two centres, the list's radius); both are
necessary conditions, and of two tiles one asks the other, so no link is lost and none is met twice.  Inside a tile,
asymmetric table lookups give the cosine to the coded vector; as the true cosine differs by no more than the error's
length, no link is lost there either.  What remains is decided by the exact cosine.
Blocks of a tile are compared in tasks; a task returns a row for each linked class (its link count and a spanning
tree's edge), never the pairs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.classify import GRAIN, bounded_sample
from finlens.llm.components import components
from finlens.llm.kit import arrow_map, stored


@dataclass(frozen=True)
class Index:
    centres: np.ndarray    # lists x dims
    codebooks: np.ndarray  # parts x codes x dims of a part (zero-padded)
    cuts: list[tuple[int, int]]


@dataclass(frozen=True)
class Layout:
    first: np.ndarray   # of each list: its first tile,
    spread: np.ndarray  # the number of tiles that its classes are dealt over (1 unless the list is over a tile's size),
    radius: np.ndarray  # and the distance of its farthest class from the centre
    lists: np.ndarray   # the lists tile by tile; a tile's begin at cuts[tile]
    cuts: np.ndarray


def _along(c: np.ndarray) -> np.ndarray:
    """The centres in an order that keeps near ones together: halved again and again along the widest direction."""
    out, open_ = [], [np.arange(len(c))]
    while open_:
        k = open_.pop()
        if len(k) <= 2:
            out.append(k)
            continue
        x = c[k] - c[k].mean(0)
        k = k[np.argsort(x @ np.linalg.eigh(x.T @ x)[1][:, -1], kind="stable")]
        open_ += [k[len(k) // 2 :], k[: len(k) // 2]]
    return np.concatenate(out)


def _layout(index: Index, sizes: dict[int, int], far: dict[int, float], most: int) -> Layout:
    """Lists packed in order into tiles of about ``most`` classes; a larger list has tiles of its own."""
    n = len(index.centres)
    first, spread, radius = np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, -1.0)
    tiles: list[list[int]] = []
    room = 0
    for k in (k for k in _along(index.centres).tolist() if k in sizes):
        radius[k], spread[k] = far[k], -(-sizes[k] // most)
        if spread[k] > 1 or sizes[k] > room:
            first[k], room = len(tiles), most if spread[k] == 1 else 0
            tiles += [[] for _ in range(spread[k])]
        else:
            first[k] = len(tiles) - 1
        for t in tiles[first[k] :]:
            t.append(k)
        room -= min(room, sizes[k])
    return Layout(first, spread, radius, np.array([k for t in tiles for k in t], np.int64), np.cumsum([0, *map(len, tiles)])[:-1])


def _rows(column) -> np.ndarray:
    """A list column of equally long lists as a matrix."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1)


def _k_means(x: np.ndarray, k: int, rng, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if (n == 0).any():
            c[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray, block: int = 4096) -> np.ndarray:
    half = (c**2).sum(1) / 2
    return np.concatenate([(half - x[i : i + block] @ c.T).argmin(1) for i in range(0, len(x), block)]) if len(x) else np.zeros(0, np.int64)


def _unit(column) -> tuple[np.ndarray, list]:
    """Of a list column: which rows are usable, and their unit vectors in double precision (None for others)."""
    out = []
    for v in column.to_pylist():
        x = np.array(v, np.float64) if v and None not in v else np.zeros(0)
        top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
        if top and not 1e-100 < top < 1e100:  # squares would overflow or vanish
            x = x / top
        out.append(x / np.sqrt((x**2).sum()) if top else None)
    return np.array([x is not None for x in out], bool), out


@dataclass(frozen=True)
class VectorLinks:
    cosine: float = 0.9
    sample: int = 20_000   # classes that the index is fitted on, about; never over twice as many
    lists: int = 0         # 0: about the square root of the number of classes, 4096 at most
    parts: int = 8
    codes: int = 256
    probes: int = 24       # limits nothing any more: every list within reach is visited
    block: int = 8192      # classes of a tile, about
    seed: int = 11

    def _classes(self, vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        """(id, key, dim, unit): key and unit are null for vectors that link with nothing."""
        def run(batches):
            for b in batches:
                ok, units = _unit(b.column(1))
                keys = [hashlib.blake2b(u.tobytes(), digest_size=16).digest() if u is not None else None for u in units]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(keys, pa.binary()), pa.array([0 if u is None else len(u) for u in units], pa.int32()),
                     pa.array(units, pa.list_(pa.float64()))], names=["id", "key", "dim", "unit"])
        kind = dict(vectors.dtypes)[id_col]
        return arrow_map(vectors.select(id_col, vec_col), run, f"id {kind}, key binary, dim int, unit array<double>")

    def _fit(self, classes: DataFrame, n: int, dim: int) -> Index:
        rows = bounded_sample(classes.select("key", "unit"), self.sample, "key").toPandas()
        x = np.stack(rows.sort_values("key")["unit"].to_numpy())
        rng = np.random.default_rng(self.seed)
        centres = _k_means(x, min(self.lists or min(4096, max(1, int(n**0.5))), len(x)), rng)
        rest = x - centres[_nearest(x, centres)]
        parts = min(self.parts, dim)
        cuts = [(dim * i // parts, dim * (i + 1) // parts) for i in range(parts)]
        wide = max(b - a for a, b in cuts)
        books = np.zeros((parts, min(self.codes, len(x)), wide))
        for i, (a, b) in enumerate(cuts):
            books[i, :, : b - a] = _k_means(rest[:, a:b], books.shape[1], rng)
        return Index(centres, books, cuts)

    def _indexed(self, classes: DataFrame, index: Index) -> DataFrame:
        """(node, times, unit, home, codes, err, far) of every class; far is the distance to the list's centre."""
        table = classes.sparkSession.sparkContext.broadcast(index)

        def run(batches):
            x_ = table.value
            for b in batches:
                if not b.num_rows:
                    continue
                x = _rows(b.column(2))
                home = _nearest(x, x_.centres)
                rest = x - x_.centres[home]
                codes, coded = np.zeros((len(x), len(x_.cuts)), np.uint8), np.zeros_like(x)
                for i, (lo, hi) in enumerate(x_.cuts):
                    codes[:, i] = _nearest(rest[:, lo:hi], x_.codebooks[i, :, : hi - lo])
                    coded[:, lo:hi] = x_.codebooks[i, codes[:, i], : hi - lo]
                err = np.sqrt(((rest - coded) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(home.astype(np.int32)), pa.array([r.tobytes() for r in codes], pa.binary()),
                     pa.array(err), pa.array(np.sqrt((rest**2).sum(1)))], names=["node", "times", "unit", "home", "codes", "err", "far"])
        return arrow_map(classes.select("node", "times", "unit"), run, f"node {dict(classes.dtypes)['node']}, times long, unit array<double>, home int, codes binary, err double, far double")

    def _tiled(self, rows: DataFrame, index: Index, layout: Layout, asks: bool) -> DataFrame:
        """Rows with their tile, or (asks) a row for each tile that a class is to be compared with."""
        table, reach = rows.sparkSession.sparkContext.broadcast((index.centres, layout)), float(np.sqrt(2 - 2 * self.cosine))
        names = ["node", "times", "unit", "home", "codes", "err", "own"]
        kinds = dict(rows.dtypes) | {"own": "int"}

        def run(batches):
            c, y = table.value
            norm, low = (c**2).sum(1), np.maximum(y.radius, 0) + reach
            for b in batches:
                home = b.column(3).to_numpy()
                own = y.first[home] + b.column(6).to_numpy() % y.spread[home]
                b = pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(own.astype(np.int32))], names=names)
                if not asks:
                    yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *b.columns], names=["tile", *names])
                    continue
                for lo in range(0, len(home), 256):
                    part = b.slice(lo, 256)
                    x, h, o = _rows(part.column(2)), home[lo : lo + 256], own[lo : lo + 256]
                    d = np.maximum((x**2).sum(1)[:, None] + norm[None, :] - 2 * x @ c.T, 0)
                    apart = np.sqrt(np.maximum(norm[h][:, None] + norm[None, :] - 2 * c[h] @ c.T, 0))
                    # a vector of another list within reach lies beyond the plane between the two centres and inside the list's ball
                    near = (d - d[np.arange(len(h)), h][:, None] <= 2 * apart * (reach + 1e-6) + 1e-6) & (np.sqrt(d) <= low[None, :] + 1e-6)
                    see = np.logical_or.reduceat(near[:, y.lists], y.cuts, axis=1)
                    t = np.arange(len(y.cuts))
                    # of two tiles one asks; it is the lower or the higher by turns, so that all are asked alike
                    see &= (o[:, None] < t[None, :]) == ((o[:, None] + t[None, :]) % 2 == 1)
                    see[np.arange(len(h)), o] = True
                    at, tile = np.nonzero(see)
                    for k in range(0, len(at), 4096):
                        got = part.take(pa.array(at[k : k + 4096]))
                        yield pa.RecordBatch.from_arrays([pa.array(tile[k : k + 4096].astype(np.int32)), *got.columns], names=["tile", *names])
        return arrow_map(rows.select(*names[:-1], F.pmod(F.xxhash64("node"), F.lit(GRAIN)).alias("own")), run,
                         "tile int, " + ", ".join(f"{c} {kinds[c]}" for c in names))

    def _linked(self, rows: DataFrame, index: Index) -> DataFrame:
        """(node, links, root): for each task's block and class linked there, its linked vectors and a tree's edge."""
        lists = rows.groupBy("home").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()  # a row a list: 4096 at most
        n = sum(r["n"] for r in lists)
        most = min(self.block, max(256, n // 8))
        layout = _layout(index, {r["home"]: r["n"] for r in lists}, {r["home"]: r["far"] for r in lists}, most)
        seen = self._tiled(rows, index, layout, asks=True)
        plan = F.broadcast(stored(seen.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(2 * most)).cast("int").alias("q")), "tiles"))  # a row a tile
        keep = ("node", "times", "unit", "home", "codes", "err", "own")
        stand = (self._tiled(rows, index, layout, asks=False).join(plan, "tile")
                 .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("q") - 1))).select("tile", "j", F.lit(0).alias("side"), *keep))
        ask = (seen.join(plan, "tile").withColumn("j", F.pmod(F.xxhash64("node", F.lit(1)), F.col("q")).cast("int"))
               .select("tile", "j", F.lit(1).alias("side"), *keep))
        table, cosine = rows.sparkSession.sparkContext.broadcast(index), self.cosine

        def run(batches):
            now, held = None, []
            for b in batches:
                t = pa.Table.from_batches([b])
                key = np.stack([t.column(c).to_numpy() for c in ("tile", "j")], 1)
                cuts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1))))
                for lo, hi in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
                    if held and tuple(key[lo]) != now:
                        yield from _block(pa.concat_tables(held), table.value, cosine)
                        held = []
                    now = tuple(key[lo])
                    held.append(t.slice(lo, hi - lo))
            if held:
                yield from _block(pa.concat_tables(held), table.value, cosine)
        both = stand.union(ask).repartition("tile", "j").sortWithinPartitions("tile", "j", "side")
        kind = dict(rows.dtypes)["node"]
        return arrow_map(both, run, f"node {kind}, links long, root {kind}")

    def links(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
        """(id, n_links, component_id, kept) for every row.

        n_links counts the other rows linked directly, equal vectors included; component_id is the least id reachable,
        itself included.  Vectors that are null, empty or zero, or hold null or non-finite components, link with
        nothing; vectors of different lengths do not link.  Ids are expected to be unique; a null id keeps its row,
        counts as a linked row, and is kept only if its whole component has no id.  Extra columns are not read."""
        all_ = stored(self._classes(vectors, id_col, vec_col), "units")
        named = all_.where("key is not null").groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("times"))
        named = stored(named.where("node is not null"), "classes")
        one = all_.join(named, "key").where(F.col("id") == F.col("node")).dropDuplicates(["key"]).select("node", "times", "key", "dim", "unit")
        one = stored(one, "class-units")
        found = None
        for dim, n in sorted((r["dim"], r["count"]) for r in one.groupBy("dim").count().collect()):
            same = one.where(F.col("dim") == dim)
            index = self._fit(same, n, dim)
            part = stored(self._linked(stored(self._indexed(same, index), "indexed"), index), "linked")
            found = part if found is None else found.union(part)
        alone = all_.select("id", "key")
        if found is None:
            return alone.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
        count = found.groupBy("node").agg(F.sum("links").alias("links"))
        group = components(found.select("node", "root"))
        classes = (named.join(count, "node", "left").join(group, "node", "left")
                   .select("key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
        out = alone.join(classes, "key", "left").select(
            F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"))
        return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))


def _block(t: pa.Table, index: Index, cosine: float):
    """Links between the classes that stand in a tile (side 0) and those that ask (side 1)."""
    side = t.column("side").to_numpy()
    stand, ask = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(stand) or not len(ask):
        return
    times, home, err, own = (t.column(c).to_numpy() for c in ("times", "home", "err", "own"))
    node = t.column("node").combine_chunks().dictionary_encode()
    names, node = node.dictionary, node.indices.to_numpy()
    x = _rows(t.column("unit"))
    codes = np.frombuffer(b"".join(t.column("codes").take(pa.array(stand)).to_pylist()), np.uint8).reshape(len(stand), -1)
    lists, at_list = np.unique(home[stand], return_inverse=True)
    links, label = np.zeros(len(names), np.int64), np.arange(len(names))
    step = max(1, (1 << 21) // len(stand))
    for lo in range(0, len(ask), step):
        q = ask[lo : lo + step]
        # cosine to the coded vectors: to the centre, plus a table entry for each code
        near = (x[q] @ index.centres[lists].T)[:, at_list]
        for i, (a, b) in enumerate(index.cuts):
            near += (x[q, a:b] @ index.codebooks[i, :, : b - a].T)[:, codes[:, i]]
        near += err[stand][None, :]
        at, to = np.nonzero(near >= cosine - 1e-9)
        at, to = q[at], stand[to]
        ok = (own[at] != own[to]) | (node[at] < node[to])
        at, to = at[ok], to[ok]
        exact = np.concatenate([np.einsum("ij,ij->i", x[at[k : k + 65536]], x[to[k : k + 65536]]) for k in range(0, len(at), 65536)]) if len(at) else np.zeros(0)
        at, to = at[exact >= cosine], to[exact >= cosine]
        np.add.at(links, node[at], times[to])
        np.add.at(links, node[to], times[at])
        _join(label, node[at], node[to])
    kept = np.flatnonzero(links)
    if len(kept):
        yield pa.RecordBatch.from_arrays([names.take(pa.array(kept)), pa.array(links[kept]), names.take(pa.array(label[kept]))], names=["node", "links", "root"])


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give each class the label of its component, as these links extend it.  Every round merges each component that
    still has a link to another one."""
    while True:
        x, y = label[a], label[b]
        out = x != y
        a, b, x, y = a[out], b[out], x[out], y[out]
        if not len(a):
            return
        picked = np.unique(np.concatenate((np.unique(x, return_index=True)[1], np.unique(y, return_index=True)[1])))
        parent: dict = {}

        def root(k):
            while parent.get(k, k) != k:
                parent[k] = k = parent.get(parent[k], parent[k])
            return k
        for u, v in zip(x[picked].tolist(), y[picked].tolist(), strict=True):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        to = np.arange(len(label))
        for k in list(parent):
            to[k] = root(k)
        label[:] = to[label]
