"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items become one automaton over word numbers (a test set: its size is checked before it is
broadcast).  Every task streams the words of its documents through it and tracks the longest matching length;
words outside the items' vocabulary reset the match, so only runs of known words are walked.  Documents are
never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.kit import ALNUM, arrow_map, byte_words, text_slices, word_hash

MAX_ITEM_WORDS = 20_000_000  # proven bound of what is broadcast; larger test sets are passed in parts


class Automaton:
    """States of a generalised suffix automaton, and what ends where: for each state the items whose windows it
    recognises and the short items that are a whole suffix."""

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: for each state: the state that holds the last ``window`` words of a match there
        self.home = [self._up(v) for v in range(len(self.len))]
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, object]]] = {}
        for name, words in items:
            v = 0
            for k, w in enumerate(words, 1):
                v = self.next[v][w]
                if k >= window:
                    self.items.setdefault(self.home[v], set()).add(name)
            if 0 < len(words) < window:
                while self.len[self.link[v]] >= len(words):
                    v = self.link[v]
                self.short.setdefault(v, []).append((len(words), name))
        #: nearest state on the suffix path, itself included, where short items end
        self.short_up = [-1] * len(self.len)
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.short_up[v] = v if v in self.short else self.short_up[self.link[v]] if self.link[v] >= 0 else -1

    def _up(self, v: int) -> int:
        while self.link[v] >= 0 and self.len[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def _new(self, length: int, edges: dict[int, int], link: int) -> int:
        self.len.append(length), self.next.append(edges), self.link.append(link)
        return len(self.len) - 1

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            q = self.next[last][w]
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, w)
        cur, p = self._new(self.len[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, w)
        return cur

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def walk(self, words: list[int], found: set) -> list[tuple[int, int]]:
        """Spans (first word, end word) of the occurrences in ``words``; their items are added to ``found``."""
        v, n, spans, window = 0, 0, [], self.window
        step, link, size = self.next, self.link, self.len
        for i, w in enumerate(words, 1):
            while v and w not in step[v]:
                v = link[v]
                n = size[v]
            v = step[v].get(w, 0)
            n = n + 1 if v else 0
            reach = 0
            if n >= window:
                reach = window
                found |= self.items[self.home[v]]
            u = self.short_up[v] if v else -1
            while u > 0:
                for length, name in self.short[u]:
                    if length <= n:
                        found.add(name)
                        reach = max(reach, length)
                u = self.short_up[link[u]] if link[u] > 0 else -1
            if reach:
                if spans and spans[-1][1] >= i - reach:
                    at = min(spans[-1][0], i - reach)
                    while len(spans) > 1 and spans[-2][1] >= at:
                        at = min(at, spans.pop()[0], spans[-1][0])
                    spans[-1] = (at, i)
                else:
                    spans.append((i - reach, i))
        return spans


@dataclass(frozen=True)
class Decontaminator:
    """window: words of an occurrence; a document whose hit words exceed ``max_coverage`` of its words is rejected, from
    others the hit spans of at least ``min_span`` words are cut out."""

    window: int = 10
    max_coverage: float = 0.5
    min_span: int = 1

    def automaton(self, items: DataFrame, id_col: str, text_col: str):
        """(sorted word hashes of the vocabulary, automaton).  Null or wordless items never occur."""
        size = items.agg(F.sum(F.length(text_col))).first()[0] or 0
        if size > 6 * MAX_ITEM_WORDS:
            raise ValueError(f"test items of {size} characters: pass them in parts")
        rows = items.select(id_col, text_col).where(F.col(text_col).isNotNull()).orderBy(id_col, text_col).collect()
        texts = []
        for name, text in rows:
            data = np.frombuffer(text.encode(), np.uint8)
            texts.append((name, byte_words(data, np.array([0, len(data)]), ALNUM)[2]))
        known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for _, h in texts)]))
        numbered = [(n, np.searchsorted(known, h).tolist()) for n, h in texts if len(h)]
        return known, Automaton(numbered, self.window), min([self.window, *(len(w) for _, w in numbered)])

    def scan(self, docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", cleaned: bool = False) -> DataFrame:
        """(doc_id, n_words, n_hit, items, spans) for every row of docs, in no other order than theirs; with
        ``cleaned`` all columns of docs and the text without hit spans as ``clean_text`` as well.

        items: ids (as strings, sorted) whose windows occur; spans: (first byte, end byte) in UTF-8 of the runs of hit
        words.  A null or wordless text has no words.  Repeated rows give repeated rows."""
        table = docs.sparkSession.sparkContext.broadcast(self.automaton(items, id_col, text_col))
        keep = docs.columns if cleaned else ["doc_id"]
        kinds = dict(docs.dtypes)
        where, least = docs.columns.index("text") if cleaned else 1, self.min_span
        new = ["n_words long", "n_hit long", "items array<string>", "spans array<struct<start:long,end:long>>"] + ["clean_text string"] * cleaned
        names_out = [f"_c{i}" for i in range(len(keep))] + [x.split()[0] for x in new]

        def run(batches):
            known, automaton, shortest = table.value
            for b in batches:
                n_words, n_hit, names, spans, clean = [], [], [], [], []
                texts = b.column(where).to_pylist() if cleaned else None
                for lo, hi, data, offs in text_slices(b.column(where)):
                    starts, ends, hashes, first = byte_words(data, offs, ALNUM)
                    at = np.searchsorted(known, hashes)
                    inside = known[np.minimum(at, len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)
                    for row in range(hi - lo):
                        a, z = int(first[row]), int(first[row + 1])
                        found, hits = set(), []
                        flag = np.concatenate(([False], inside[a:z], [False]))
                        turn = np.flatnonzero(flag[1:] != flag[:-1])
                        for s, e in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
                            if e - s >= shortest:
                                hits += [(s + x, s + y) for x, y in automaton.walk(at[a + s : a + e].tolist(), found)]
                        n_words.append(z - a)
                        n_hit.append(sum(y - x for x, y in hits))
                        names.append(sorted(map(str, found)))
                        base = int(offs[row])
                        cut = [(int(starts[a + x]) - base, int(ends[a + y - 1]) - base) for x, y in hits]
                        spans.append([{"start": x, "end": y} for x, y in cut])
                        if cleaned:
                            long = [c for c, (x, y) in zip(cut, hits, strict=True) if y - x >= least]
                            clean.append(_without(texts[lo + row], long) if long else texts[lo + row])
                extra = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())),
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
                extra += [pa.array(clean, pa.string())] if cleaned else []
                held = list(b.columns) if cleaned else [b.column(0)]
                yield pa.RecordBatch.from_arrays(held + extra, names=names_out)
        own = [f"`_c{i}` {kinds[c]}" for i, c in enumerate(keep)]
        out = arrow_map(docs.select(*keep) if cleaned else docs.select("doc_id", "text"), run, ", ".join(own + new))
        return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], *[x.split()[0] for x in new])

    def apply(self, docs: DataFrame, items: DataFrame) -> DataFrame:
        """docs without contaminated spans and without rejected documents; same columns.  n_chars, if there, follows."""
        out = self.scan(docs, items, cleaned=True).where(F.col("n_hit") <= self.max_coverage * F.col("n_words"))
        changed = F.size("spans") > 0
        text = F.when(changed, F.col("clean_text")).otherwise(F.col("text")).alias("text")
        chars = F.when(changed, F.length("clean_text").cast(dict(docs.dtypes).get("n_chars", "long"))).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
        return out.select(*[text if c == "text" else chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    data, parts, at = text.encode(), [], 0
    for x, y in spans:
        parts.append(data[at:x])
        at = y
    return b"".join([*parts, data[at:]]).decode()
