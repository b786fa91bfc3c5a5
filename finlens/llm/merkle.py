"""Merkle manifest of a data set: a digest tree per source, a tree over the sources, and a proof for every row.

Leaves of a source are numbered in order without a one-task window; nodes are put together in blocks of ``FAN ** BUNDLE``
leaves, so a source of any size spreads over its blocks.  Every node below the root is then an edge: a pointer to its
parent and the segment of siblings on that step.  Proofs come by pointer jumping: a self-join takes each pointer to its
target's target and concatenates the two segments, so the distance doubles.

Which nodes jump: up to a distance of ``SPLIT`` those that a later round can still meet (levels divisible by the
distance, and all nodes of the small tree over the sources), then those ``SPLIT`` levels up alone, a 6561st of the
leaves, until they reach the root; the leaves follow with one join a round up to ``SPLIT`` and a last one.  A node has at
most ``FAN`` children, so at most ``FAN ** distance`` rows share a join key whatever the size of a source: no hot keys,
and nothing is broadcast by hand.  Rows whose pointer has reached the root keep a key of their own that matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlens.llm.kit import stored
from finlens.operators.positions import number_rows

FAN = 3
BUNDLE = 6   # levels put together in one group
SPLIT = 8    # distance from which only upper nodes jump
TOP, ROOT = -1, -2  # numbers of the tree over the sources, and of the root above it
_SEGMENT = "array<struct<at:int,siblings:binary>>"


def digest(*columns: str | Column) -> Column:
    """Lowercase hex sha256 of the columns' values: ``-`` for a null, else the UTF-8 byte count, ``:`` and the value."""
    parts = []
    for c in columns:
        v = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.sha2(F.concat(*parts), 256)


def _level_up(name: str) -> Column:
    """Digests of every three consecutive ones of an array of digests."""
    return F.expr(f"transform(sequence(0, cast((size({name}) - 1) div {FAN} as int)), "
                  f"j -> sha2(array_join(slice({name}, {FAN} * j + 1, {FAN}), ''), 256))")


def _climb(nodes: DataFrame, base: int, size: int) -> tuple[list[DataFrame], DataFrame, DataFrame | None]:
    """From nodes (s, n, i, h, x) at level ``base`` of their trees, at most ``size`` to a tree: the edges of up to BUNDLE
    levels, the trees' roots (s, h, x) that are reached, and the nodes left for the next call."""
    block = FAN**BUNDLE
    b = (nodes.groupBy("s", "n", F.floor(F.col("i") / block).alias("b"))
         .agg(F.sort_array(F.collect_list(F.struct("i", "h", "x"))).alias("kids")).withColumn("l0", F.expr("transform(kids, k -> k.h)")))
    for k in range(BUNDLE):
        b = b.withColumn(f"l{k + 1}", F.when(F.col("n") > FAN**k, _level_up(f"l{k}")))
    b = stored(b, "merkle-blocks")
    edges = []
    for k in range(BUNDLE):
        if size <= FAN**k:
            break
        last = F.col("n") <= FAN ** (k + 1)
        one = b.where(F.col("n") > FAN**k)
        more = [F.expr("kids[pos].x").alias("x")] if base + k == 0 else []
        one = one.select("s", "n", "b", f"l{k}", *(["kids"] if more else []), F.when(last, F.expr(f"l{k + 1}[0]")).alias("top"),
                         F.posexplode(f"l{k}").alias("pos", "h"))
        at = (F.col("pos") % FAN).cast("int")
        run = f"slice(l{k}, pos - pos % {FAN} + 1, {FAN})"
        others = F.expr(f"unhex(array_join(concat(slice({run}, 1, pos % {FAN}), slice({run}, pos % {FAN} + 2, {FAN})), ''))")
        i = F.col("b") * FAN ** (BUNDLE - k) + F.col("pos")
        over = F.when(F.col("s") >= 0, TOP).otherwise(ROOT).cast("long")
        edges.append(one.select(
            "s", F.lit(base + k).alias("l"), i.alias("i"), F.when(last, over).otherwise(F.col("s")).alias("ps"),
            F.when(last, 0).otherwise(base + k + 1).alias("pl"), F.when(last, F.col("s")).otherwise(F.floor(i / FAN)).alias("pi"),
            F.array(F.struct(at.alias("at"), others.alias("siblings"))).cast(_SEGMENT).alias("segment"),
            F.when(F.col("s") >= 0, F.col("top")).alias("subroot"), *(["h", *more] if more else [])))
    done = b.where(F.col("n") <= block).select("s", F.coalesce(*[F.expr(f"l{k}[0]") for k in range(BUNDLE, -1, -1)]).alias("h"),
                                               F.expr("kids[0].x").alias("x"), (F.col("n") == 1).alias("lone"))
    rest = None
    if size > block:
        rest = b.where(F.col("n") > block).select("s", F.ceil(F.col("n") / block).alias("n"), F.col("b").alias("i"), F.expr(f"l{BUNDLE}[0]").alias("h"), F.lit(None).alias("x"))
    return edges, done, rest


def _tree(nodes: DataFrame, size: int) -> tuple[list[DataFrame], DataFrame]:
    """All edges of the trees over the nodes, and the trees' roots.  Edges of level 0 come first."""
    edges, roots, base = [], None, 0
    while nodes is not None:
        more, done, nodes = _climb(nodes, base, size)
        done = done.withColumn("lone", F.col("lone") & F.lit(base == 0)).select("s", "h", "lone", *(["x"] if base == 0 else []))
        edges += more
        roots = done if roots is None else roots.unionByName(done, allowMissingColumns=True)
        base, size = base + BUNDLE, -(-size // FAN**BUNDLE)
    return edges, roots


def _jump(rows: DataFrame, up: DataFrame, root: int) -> DataFrame:
    """Every pointer moved to its target's target, the segments concatenated.  up: (s, l, i) to pointer and segment."""
    u = up.select(*[F.col(c).alias(f"_{c}") for c in ("s", "l", "i", "ps", "pl", "pi", "segment", "subroot")])
    there = F.col("ps") == root  # stays; a key of its own that no node has
    keys = (F.when(there, F.col("s")).otherwise(F.col("ps")) == F.col("_s")) & (F.when(there, -1).otherwise(F.col("pl")) == F.col("_l")) \
        & (F.when(there, F.col("i")).otherwise(F.col("pi")) == F.col("_i"))
    out = rows.join(u, keys, "left")
    moved = {c: F.coalesce(f"_{c}", c) for c in ("ps", "pl", "pi")}
    moved["segment"] = F.when(F.col("_segment").isNull(), F.col("segment")).otherwise(F.concat("segment", "_segment"))
    moved["subroot"] = F.coalesce("subroot", "_subroot")
    return out.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in rows.columns])


def _depth(n: int) -> int:
    d = 0
    while n > 1:
        n, d = -(-n // FAN), d + 1
    return d


def merkle_proofs(leaves: DataFrame, by: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """All columns of leaves with subroot (its source's), root, and proof: an array of (at, siblings) from the leaf's level to
    the root's, ``siblings`` the digests of the run's other nodes put together (32 bytes each), ``at`` how many of them
    stand to the left.

    Leaves of a source go by ``order`` (null first), then by digest; sources go by name, null first (a source of its own),
    then bytewise.  Rows repeated whole are leaves of their own.  A lone leaf is its source's subroot, a lone
    subroot the root, with nothing in the proof for that tree.  New columns replace old ones of these names; an empty
    table has no root and gives no rows."""
    spark = leaves.sparkSession
    kept = [c for c in leaves.columns if c not in ("subroot", "root", "proof")]
    rows = stored(leaves.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("x"), F.col(f"`{by}`").alias("_by"), F.col(f"`{order}`").alias("_order"),
                                F.col(f"`{leaf}`").alias("h")), "merkle-leaves")
    rows = number_rows(rows, ["_order", "h"], by=["_by"], name="i", count="n", ordinal="s")
    nodes = rows.select("s", "n", "i", "h", "x")
    size = nodes.agg(F.max("n"), F.max("s")).first()
    if size[0] is None:
        return leaves.select(*[F.col(f"`{c}`") for c in kept]).where("false").withColumns(
            {"subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string"), "proof": F.lit(None).cast(_SEGMENT)})
    largest, sources = size[0], size[1] + 1
    edges, roots = _tree(nodes, largest)
    roots = stored(roots, "merkle-subroots")
    over = roots.select(F.lit(TOP).cast("long").alias("s"), F.lit(sources).cast("long").alias("n"), F.col("s").alias("i"), "h", F.lit(None).alias("x"))
    above, top = _tree(over, sources)
    root = top.first()["h"]
    end = ROOT if sources > 1 else TOP
    # leaves at distance 1; a lone one already stands in the tree over the sources
    lone = roots.where("lone").select(
        "s", F.lit(0).alias("l"), F.lit(0).cast("long").alias("i"), F.lit(TOP).cast("long").alias("ps"), F.lit(0).alias("pl"), F.col("s").alias("pi"),
        F.array().cast(_SEGMENT).alias("segment"), F.col("h").alias("subroot"), "h", "x")
    out = edges[0].unionByName(lone) if largest > 1 else lone
    plain = [e.select("s", "l", "i", "ps", "pl", "pi", "segment", "subroot") for e in [*edges[1:], *above]]
    if plain:
        up = plain[0]
        for e in plain[1:]:
            up = up.unionByName(e)
        up = stored(up, "merkle-edges")
        distance, far = 1, max(_depth(largest), 1) + _depth(sources)  # a lone leaf is one step behind
        while distance < min(SPLIT, far):
            out = _jump(out, up, end)
            up = stored(_jump(up.where((F.col("s") < 0) | (F.col("l") % (2 * distance) == 0)), up, end), "merkle-jump")
            distance *= 2
        reach = distance
        while reach < far - distance:
            up = stored(_jump(up, up, end), "merkle-jump")
            reach *= 2
        if distance < far:
            out = _jump(out, up, end)
    return out.select(*[F.col("x").getField(c).alias(c) for c in kept], "subroot", F.lit(root).alias("root"), F.col("segment").alias("proof"))


def folded(leaf: Column, proof: str = "proof") -> Column:
    """The root that a leaf's digest and a proof lead to."""
    def step(h, p):
        at = p["at"] * 32
        return F.sha2(F.concat(F.lower(F.hex(F.substring(p["siblings"], F.lit(1), at))), h, F.lower(F.hex(F.substring(p["siblings"], at + 1, F.lit(32 * FAN))))), 256)
    return F.aggregate(proof, leaf, step)


def proof_digest(proof: str = "proof") -> Column:
    """sha256 of the siblings' digests as hex text, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.lower(F.hex(p["siblings"]))), ""), 256)
