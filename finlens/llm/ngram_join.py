"""Exact n-gram Jaccard self-join by vertical partitioning.

A document is the set of its distinct word shingles (hashed to 64 bits).  All shingles stand in one global
order: ordinary ones by hash, those that repeat most in the corpus behind them, most repeated last.

1. *Copies.*  Documents with equal sets are one node (signature of the set); only nodes are joined.
2. *Prefixes.*  Two sets with Jaccard >= t share a shingle among the first ``n - ceil(t n) + 1`` of each, so
   only those are shuffled.  Shingles seen in one node alone are dropped by a streaming scan of the sorted
   shuffle; the rest are the buckets.
3. *Stars.*  Each bucket compares its best-connected node, the centre, with its other nodes: as many pairs as
   rows, never all pairs of a group.  A parity bitmap of each set, whose Hamming distance never exceeds the sets'
   symmetric difference, rules most pairs out; components of the links so far settle most buckets.
4. *Rest, exactly.*  Nodes around the same centre that are still in different components are tested against
   each other's bitmaps in blocks.  Only pairs that pass leave the task.
5. *Vertical count.*  The global order is cut into fragments; the segments of a pair are joined fragment by
   fragment, partial overlaps counted separately and summed per pair, and the Jaccard condition is decided on
   the exact sum.

Every linked pair ends up in one component, found directly or through others: by default the links are the pairs
that were verified, which span the components but leave out pairs inside a component already known.  The whole join
(``groups(docs, whole=True)``, ``jaccard_links``) does without that shortcut: step 4 tests all nodes around a centre
against each other, every linked pair is verified, and each document gets its number of links.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.components import components
from finlens.llm.kit import NOT_SPACE, arrow_map, byte_words, mix, ranges, shingle_sets, stored, text_slices

HEAVY = 1 << 17        # shingles ranked by repetition; the rest rank by hash alone (order only, never results)
HEAVY_WINDOW = 1 << 21  # shingles counted together in a task when looking for repeated ones
FRAGMENTS = 8
FILTER_BITS = 1 << 28   # 32 MB: bound of the bitmap of wanted documents
BLOCK = 1024           # nodes of a bucket compared with each other in one step


@dataclass(frozen=True)
class JaccardJoin:
    """width: words of a shingle; num/den: the similarity, as a fraction, so that it is decided in integers."""

    width: int = 5
    num: int = 80
    den: int = 100
    fragments: int = FRAGMENTS
    heavy: int = HEAVY
    block: int = BLOCK

    # -- text to sets --------------------------------------------------------------------------------------
    def _sets(self, batch):
        """(row, sorted distinct shingles) of every text of a batch."""
        for lo, _, data, offs in text_slices(batch.column(1)):
            _, _, hashes, first = byte_words(data, offs, NOT_SPACE)
            yield from enumerate(shingle_sets(hashes, first, self.width), lo)

    def members(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_shingles, node, bits): node is the set's signature, null for an empty set; bits its bitmap."""
        def run(batches):
            for b in batches:
                n, node, bits = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), []
                for i, s in self._sets(b):
                    n[i], node[i] = len(s), _signature(s)
                    bits.append(_bitmap(s))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n), pa.array(node, mask=n == 0), _lists(bits)],
                    names=["doc_id", "n_shingles", "node", "bits"])
        kind = dict(docs.dtypes)["doc_id"]
        return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_shingles long, node long, bits array<long>")

    def repeated(self, docs: DataFrame) -> np.ndarray:
        """The shingles that repeat most, least first; a bounded table (``heavy`` hashes).  Counts come from all
        documents: each task counts windows of shingles, keeps those seen twice, and Spark sums."""
        def run(batches):
            held, size = [], 0

            def counted():
                v, c = np.unique(np.concatenate(held), return_counts=True)
                v, c = v[c > 1], c[c > 1]
                return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])
            for b in batches:
                for _, s in self._sets(b):
                    held.append(s)
                    size += len(s)
                    if size >= HEAVY_WINDOW:
                        yield counted()
                        held, size = [], 0
            if held:
                yield counted()
        counts = stored(arrow_map(docs.select("doc_id", "text"), run, "h long, c long")
                        .groupBy("h").agg(F.sum("c").alias("c")), "repeated")
        # the least count that keeps the table within its bound, from a histogram of a few hundred rows
        step = F.floor(F.log2("c") * 16)
        room, least = self.heavy, None
        for row in counts.groupBy(step.alias("k")).count().orderBy(F.desc("k")).collect():
            room -= row["count"]
            if room < 0:
                break
            least = row["k"]
        if least is None:
            return np.zeros(0, np.uint64)
        top = counts.where(step >= least).toPandas().sort_values(["c", "h"])
        return top["h"].to_numpy(np.int64).copy().view(np.uint64)

    def _ordered(self, s: np.ndarray, heavy: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The set in the global order; heavy is sorted, rank its place by repetition."""
        at = np.minimum(np.searchsorted(heavy, s), max(len(heavy) - 1, 0))
        late = heavy[at] == s if len(heavy) else np.zeros(len(s), bool)
        return np.concatenate((s[~late], s[late][np.argsort(rank[at[late]])])) if late.any() else s

    def prefixes(self, docs: DataFrame, heavy: np.ndarray) -> DataFrame:
        """(h, node, n): the prefix shingles of each distinct set, sent once per task."""
        order = np.argsort(heavy)
        table = docs.sparkSession.sparkContext.broadcast((heavy[order], order))

        def run(batches):
            sorted_heavy, rank = table.value
            seen: set[int] = set()
            for b in batches:
                hs, nodes, ns, size = [], [], [], 0
                for _, s in self._sets(b):
                    if not len(s) or (node := _signature(s)) in seen:
                        continue
                    seen.add(node)
                    p = len(s) - -(-self.num * len(s) // self.den) + 1
                    hs.append(self._ordered(s, sorted_heavy, rank)[:p])
                    nodes.append(np.full(p, node))
                    ns.append(np.full(p, len(s)))
                    if (size := size + p) > 1 << 17:
                        yield _rows(h=np.concatenate(hs).view(np.int64), node=np.concatenate(nodes), n=np.concatenate(ns).astype(np.int32))
                        hs, nodes, ns, size = [], [], [], 0
                if hs:
                    yield _rows(h=np.concatenate(hs).view(np.int64), node=np.concatenate(nodes), n=np.concatenate(ns).astype(np.int32))
        return arrow_map(docs.select("doc_id", "text"), run, "h long, node long, n int")

    def segments(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """(doc_id, node, fragment, toks): the sets of the documents in ``wanted`` (doc_id), cut along the global order.

        Segments follow the hash order: a fragment is a range of hashes, so the partial overlaps of a pair in
        all fragments add up to its whole overlap.  Texts are not shuffled: tasks skip the documents that a bitmap
        of the wanted ids (``FILTER_BITS`` at most) rules out.  Others pass by chance, copies of wanted sets among
        them, so a later join must ask for the document and not for the node alone."""
        bits = 1 << min(FILTER_BITS.bit_length() - 1, max(16, (16 * wanted.count()).bit_length()))
        slot = F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("slot")
        held = np.zeros(bits // 8, np.uint8)
        for row in (wanted.select(slot).groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("k"))
                    .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("m")).collect()):
            at = (row["k"] - 1) * 4096
            part = np.frombuffer(bytes(row["m"]), np.uint8)
            held[at : at + 4096] |= part[: max(0, len(held) - at)]
        table = docs.sparkSession.sparkContext.broadcast(held)
        f = self.fragments
        kind = dict(docs.dtypes)["doc_id"]

        def out(b, rows, node, frag, toks):
            ids = b.column(0).take(pa.array(rows, pa.int64()))
            return pa.RecordBatch.from_arrays([ids, pa.array(node, pa.int64()), pa.array(frag, pa.int32()), _lists(toks)],
                                              names=["doc_id", "node", "fragment", "toks"])

        def run(batches):
            for b in batches:
                at = b.column(2).to_numpy()
                b = b.filter(pa.array((table.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
                rows, node, frag, toks, size = [], [], [], [], 0
                for i, s in self._sets(b):
                    if not len(s):
                        continue
                    cut = np.searchsorted(s >> np.uint64(32), np.arange(f + 1, dtype=np.uint64) * np.uint64(2**32) // np.uint64(f))
                    cut[-1] = len(s)
                    sig, v = _signature(s), s.view(np.int64)
                    for k in np.flatnonzero(np.diff(cut)).tolist():
                        rows.append(i), node.append(sig), frag.append(k), toks.append(v[cut[k] : cut[k + 1]])
                    size += len(s)
                    if size > 1 << 17:
                        yield out(b, rows, node, frag, toks)
                        rows, node, frag, toks, size = [], [], [], [], 0
                if node:
                    yield out(b, rows, node, frag, toks)
        return arrow_map(docs.select("doc_id", "text", slot), run,
                         f"doc_id {kind}, node long, fragment int, toks array<long>")

    # -- candidates -----------------------------------------------------------------------------------------
    def buckets(self, prefixes: DataFrame) -> DataFrame:
        """(h, node, n) of shingles that two nodes or more have in their prefixes."""
        def run(batches):
            rest = None
            for b in batches:
                h, node, n = (b.column(i).to_numpy() for i in range(3))
                if rest is not None:
                    h, node, n = (np.concatenate(x) for x in zip(rest[:3], (h, node, n), strict=True))
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
                h, node, n = h[new], node[new], n[new]
                first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
                many = np.repeat(np.diff(np.append(first, len(h))) > 1, np.diff(np.append(first, len(h))))
                # the last run may go on in the next batch: keep its last row, and what is known of the run
                many[first[-1]:] |= len(h) - first[-1] > 1 or (rest is not None and h[-1] == rest[0][0] and rest[3])
                open_run = bool(many[-1])
                if rest is not None and h[0] == rest[0][0] and rest[3]:
                    many[0] = False  # it went out with the last batch
                    if len(h) > 1 and h[1] == h[0]:
                        many[1 : (first[1] if len(first) > 1 else len(h))] = True
                if many.any():
                    yield _rows(h=h[many], node=node[many], n=n[many])
                rest = (h[-1:], node[-1:], n[-1:], open_run)
        return arrow_map(prefixes.repartition("h").sortWithinPartitions("h", "node"), run, "h long, node long, n int")

    def _similar_sizes(self, a: str = "na", b: str = "nb"):
        return F.least(a, b) * self.den >= F.greatest(a, b) * self.num

    def stars(self, buckets: DataFrame) -> DataFrame:
        """(a, b, na, nb): each bucket's best-connected node against its other nodes, whatever their sizes."""
        degree = buckets.groupBy("node").agg(F.count("*").alias("d"))
        hub = (buckets.join(degree, "node").groupBy("h")
               .agg(F.max(F.struct("d", "node", "n")).alias("hub"))
               .select("h", F.col("hub.node").alias("a"), F.col("hub.n").alias("na")))
        return (buckets.join(hub, "h").select("a", F.col("node").alias("b"), "na", F.col("n").alias("nb"))
                .where("a <> b").distinct())

    def possible(self, pairs: DataFrame, maps: DataFrame) -> DataFrame:
        """Pairs (a, b, na, nb) whose bitmaps allow the similarity.  maps: (node, bits)."""
        num, den = self.num, self.den

        def run(batches):
            for t in batches:
                na, nb = t.column(2).to_numpy().astype(np.int64), t.column(3).to_numpy().astype(np.int64)
                sizes, classes = [], []
                for c in (4, 5):
                    lens, flat, at = _unlisted(t.column(c))
                    sizes.append(lens)
                    classes.append((flat, at))
                ok = np.zeros(t.num_rows, bool)
                for wa, wb in {*zip(*(x.tolist() for x in sizes), strict=True)}:
                    rows = np.flatnonzero((sizes[0] == wa) & (sizes[1] == wb))
                    ma, mb = (_fold(flat[ranges(at[rows], lens[rows])].reshape(len(rows), w), min(wa, wb))
                              for (flat, at), lens, w in zip(classes, sizes, (wa, wb), strict=True))
                    differ = np.bitwise_count((ma ^ mb).view(np.uint64)).sum(1)
                    ok[rows] = differ * (num + den) <= (den - num) * (na[rows] + nb[rows])
                yield pa.RecordBatch.from_arrays([t.column(i).filter(pa.array(ok)) for i in range(4)], names=["a", "b", "na", "nb"])
        both = (pairs.join(maps.toDF("a", "bits_a"), "a").join(maps.toDF("b", "bits_b"), "b")
                .select("a", "b", "na", "nb", "bits_a", "bits_b"))
        return arrow_map(both, run, "a long, b long, na int, nb int").distinct()

    def verified(self, pairs: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
        """Pairs (a, b, na, nb) whose sets are similar enough; overlaps are counted per fragment and summed.
        reps: (node, rep), the document whose text stands for a node."""
        pool = pairs.select("a").union(pairs.select("b")).distinct().toDF("node").join(reps, "node")
        cut = stored(self.segments(docs, pool.select(F.col("rep").alias("doc_id"))), "segments")
        # one document stands for a node: without its id a pair would meet every copy that the bitmap let pass
        left = cut.select(F.col("node").alias("at"), F.col("doc_id").alias("of_a"), "fragment", F.col("toks").alias("ta"))
        right = cut.select(F.col("node").alias("to"), F.col("doc_id").alias("of_b"), F.col("fragment").alias("same"),
                           F.col("toks").alias("tb"))
        known = pairs.join(reps.toDF("a", "rep_a"), "a").join(reps.toDF("b", "rep_b"), "b")
        parts = (known.join(left, (F.col("a") == F.col("at")) & F.col("rep_a").eqNullSafe(F.col("of_a")))
                 .join(right, (F.col("b") == F.col("to")) & (F.col("fragment") == F.col("same"))
                       & F.col("rep_b").eqNullSafe(F.col("of_b")))
                 .select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("ta", "tb")).alias("part")))
        # a repeated row of a document repeats its segments, hence the maximum
        return (parts.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("part").alias("part"))
                .groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap"))
                .where((F.col("overlap") * self.den) >= self.num * (F.col("na") + F.col("nb") - F.col("overlap"))))

    def rest(self, stars: DataFrame, found: DataFrame | None, maps: DataFrame) -> DataFrame:
        """(a, b, na, nb): pairs of different components around the same centre, of similar sizes, whose bitmaps allow
        the similarity.  Nodes that share a bucket share its centre.  found: (node, component); None: each node is a
        component of its own, so all pairs are tested."""
        held = stars.select(F.col("a").alias("h"), F.col("b").alias("node"), F.col("nb").alias("n"))
        if found is None:
            held = held.withColumn("component", F.col("node"))
        else:
            held = held.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        # the centre itself was compared with all; centres whose other nodes form one component are done
        open_ = (held.groupBy("h").agg(F.count("*").alias("c"), F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .where("lo <> hi").withColumn("k", F.ceil(F.col("c") / F.lit(self.block)).cast("int")).select("h", "k"))
        mine = F.pmod(F.xxhash64("node"), F.col("k")).cast("int")
        rows = (held.join(open_, "h").withColumn("own", mine)
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
                .select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                        "node", "n", "component")
                .join(maps, "node"))
        num, den = self.num, self.den

        def run(batches):
            held_key, parts = None, []
            for b in batches:
                t = pa.Table.from_batches([b])
                key = np.stack([t.column(c).to_numpy() for c in ("h", "i", "j")], 1)
                cuts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(1))))
                for lo, hi in zip(cuts, np.append(cuts[1:], len(key)), strict=True):
                    if held_key is not None and tuple(key[lo]) != held_key:
                        yield from _across(parts, num, den)
                        parts = []
                    held_key = tuple(key[lo])
                    parts.append(t.slice(lo, hi - lo))
            if parts:
                yield from _across(parts, num, den)
        cols = ("h", "i", "j", "own", "node", "n", "component", "bits")
        blocks = rows.select(*cols).repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
        return arrow_map(blocks, run, "a long, b long, na int, nb int").distinct()

    # -- the whole join -------------------------------------------------------------------------------------
    def groups(self, docs: DataFrame, whole: bool = False) -> tuple[DataFrame, DataFrame]:
        """(doc_id, n_shingles, component_id) for every row of docs, and the verified links (a, b, na, nb, overlap)
        between nodes.

        component_id is the least doc_id reachable by links.  A null or wordless text has n_shingles 0 and is its
        own component; a row without doc_id is grouped with equal texts only; rows that share a doc_id are grouped
        each by its own text.  Columns other than doc_id and text are not read.

        Without ``whole`` the links span the components and no more.  With it they are all linked pairs of nodes, once
        each, and the rows have n_links too: the other rows of equal or linked text."""
        members = stored(self.members(docs), "members")
        prefixes = self.prefixes(docs, self.repeated(docs))
        buckets = stored(self.buckets(prefixes), "buckets")
        reps = members.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
        pool = stored(buckets.select("node").distinct().join(reps, "node"), "pool")
        maps = stored(members.join(pool, "node").where(F.col("doc_id").eqNullSafe(F.col("rep"))).select("node", "bits"), "maps")
        stars = stored(self.stars(buckets), "stars")
        near = self.possible(stars.where(self._similar_sizes()), maps)
        if whole:
            turned = F.col("a") > F.col("b")
            pairs = near.union(self.rest(stars, None, maps)).select(
                F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                F.when(turned, F.col("nb")).otherwise(F.col("na")).alias("na"), F.when(turned, F.col("na")).otherwise(F.col("nb")).alias("nb"))
            links = stored(self.verified(stored(pairs.distinct(), "pairs"), docs, pool), "links")
        else:
            links = stored(self.verified(stored(near, "star-pairs"), docs, pool), "star-links")
            found = components(links.select("a", "b"))
            more = self.verified(stored(self.rest(stars, found, maps), "rest-pairs"), docs, pool)
            links = stored(links.union(more), "links")
        found = components(links.select("a", "b"))
        named = (reps.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
        least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
        # only nodes that hold several documents or are linked have another component_id than their own doc_id
        names = named.join(least, "component").select("node", "component_id")
        out, extra = members.join(names, "node", "left"), []
        if whole:
            rows = members.where("node is not null").groupBy("node").agg(F.count("*").alias("rows"))
            ends = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
            linked = ends.join(rows.toDF("other", "others"), "other").groupBy("node").agg(F.sum("others").alias("others"))
            count = rows.join(linked, "node", "left").select("node", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
            out, extra = out.join(count, "node", "left"), [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")]
        return out.select("doc_id", "n_shingles", *extra, F.coalesce("component_id", "doc_id").alias("component_id")), links


def _signature(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offs = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def _unlisted(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, flat values and starts of a list column without nulls."""
    offs = column.offsets.to_numpy().astype(np.int64)
    return np.diff(offs), column.values.to_numpy(), offs[:-1]


def _bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap of at least 2 bits a member, 64 times a power of two bits; larger ones fold to smaller ones by
    XOR of their halves."""
    if not len(s):
        return np.zeros(0, np.int64)
    words = 1 << max(0, int(2 * len(s) - 1).bit_length() - 6)
    bit = np.bincount((mix(s) & np.uint64(words * 64 - 1)).astype(np.int64), minlength=words * 64) & 1
    return np.packbits(bit.astype(np.uint8), bitorder="little").view(np.int64)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def _across(parts, num: int, den: int):
    """Pairs of one block that come from different components and may be similar."""
    t = pa.concat_tables(parts).combine_chunks()
    own, i, j = (t.column(c).to_numpy() for c in ("own", "i", "j"))
    node, n, comp = t.column("node").to_numpy(), t.column("n").to_numpy(), t.column("component").to_numpy()
    bits = t.column("bits")
    lens, flat, at = _unlisted(pa.concat_arrays(bits.chunks) if isinstance(bits, pa.ChunkedArray) else bits)
    order = np.argsort(n, kind="stable")
    classes = [(w, order[lens[order] == w]) for w in np.unique(lens)]
    maps = {w: flat[ranges(at[rows], lens[rows])].reshape(len(rows), w) for w, rows in classes}
    both = i[0] != j[0]
    for ia, (wa, ra) in enumerate(classes):
        for wb, rb in classes[ia:]:
            if n[ra].max() * den < n[rb].min() * num:
                continue
            mb = maps[wb] if wb == wa else _fold(maps[wb], wa)
            for x in range(len(ra)):
                r = ra[x]
                lo = np.searchsorted(n[rb], -(-n[r] * num // den), side="left")
                hi = np.searchsorted(n[rb], n[r] * den // num, side="right")
                if wa == wb:
                    lo = max(lo, x + 1)
                if hi <= lo:
                    continue
                c = rb[lo:hi]
                ok = comp[c] != comp[r]
                if both:
                    ok &= own[c] != own[r]
                if not ok.any():
                    continue
                differ = np.bitwise_count((mb[lo:hi] ^ maps[wa][x]).view(np.uint64)).sum(1)
                # overlap = (na + nb - d) / 2 must reach num / (num + den) of na + nb
                ok &= differ * (num + den) <= (den - num) * (n[c] + n[r])
                if ok.any():
                    k = int(ok.sum())
                    yield _rows(a=np.full(k, node[r]), b=node[c[ok]], na=np.full(k, n[r], np.int32), nb=n[c[ok]].astype(np.int32))


def jaccard_groups(docs: DataFrame, **parameters) -> DataFrame:
    return JaccardJoin(**parameters).groups(docs)[0]


def jaccard_links(docs: DataFrame, **parameters) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of the whole join."""
    return JaccardJoin(**parameters).groups(docs, whole=True)[0]
