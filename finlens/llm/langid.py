"""Language identification by rank-order profiles of character n-grams.

A profile is a language's most frequent n-grams (1 to 3 letters, with word ends) in order.  A document is given to
the language whose profile its own most frequent n-grams are least out of place in.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlens.llm.kit import arrow_map, text_slices

GAP = 32  # stands for everything between words
SLICE = 1 << 19  # text bytes at once
WINDOW = 1 << 21  # n-grams counted together when learning
PARTS = 64  # of a language's n-grams; at most this many times ``top`` meet in its last ordering


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point to lower-case letter, or GAP."""
    table = np.full(0x110000, GAP, np.int64)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of the texts of a slice, one after another, the first of each text, and the letters of each."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    code = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begin = np.searchsorted(lead, offs)
    # a gap before each text; runs of gaps are one
    spread = np.insert(_letters()[code], begin[:-1], GAP) if len(begin) > 1 else _letters()[code]
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin) + 1)
    keep = np.ones(len(spread), bool)
    keep[1:] = (spread[1:] != GAP) | (spread[:-1] != GAP) | (doc[1:] != doc[:-1])
    c, doc = spread[keep], doc[keep]
    one = c != GAP
    two = (doc[1:] == doc[:-1])
    three = (doc[2:] == doc[:-2])
    grams = np.concatenate((c[one], (c[:-1] | (c[1:] << 21))[two], (c[:-2] | (c[1:-1] << 21) | (c[2:] << 42))[three]))
    of = np.concatenate((doc[one], doc[:-1][two], doc[:-2][three]))
    order = np.argsort(of, kind="stable")
    n = len(begin) - 1
    return grams[order], np.searchsorted(of[order], np.arange(n + 1)), np.bincount(doc[one], minlength=n)


@dataclass(frozen=True)
class RankProfiles:
    """top: n-grams of a profile and of a document that are compared."""

    top: int = 400

    def learn(self, docs: DataFrame, lang: str = "lang") -> DataFrame:
        """(lang, gram, place): the profiles, from every text with a language; counts cover all of them."""
        def run(batches):
            held, size = {}, 0

            def counted():
                for name, parts in held.items():
                    v, c = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(v), pa.string()), pa.array(v), pa.array(c.astype(np.int64))], names=["lang", "gram", "n"])
            for b in batches:
                langs = b.column(0).to_pylist()
                for lo, hi, data, offs in text_slices(b.column(1), SLICE):
                    grams, first, _ = _grams(data, offs)
                    for row in range(hi - lo):
                        held.setdefault(langs[lo + row], []).append(grams[first[row] : first[row + 1]])
                    size += len(grams)
                    if size > WINDOW:
                        yield from counted()
                        held, size = {}, 0
            yield from counted()
        known = docs.select(F.col(lang).cast("string").alias("lang"), "text").where("lang is not null and text is not null")
        def place(*by):
            return F.row_number().over(Window.partitionBy("lang", *by).orderBy(F.desc("n"), "gram")) - 1
        # a language's first n-grams are among the first of each of its parts, so no task orders all n-grams of a language
        counted = arrow_map(known, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        first = counted.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS))).withColumn("place", place("part")).where(F.col("place") < self.top)
        return first.withColumn("place", place()).where(F.col("place") < self.top).select("lang", "gram", "place")

    def predict(self, docs: DataFrame, profiles: DataFrame) -> DataFrame:
        """(doc_id, lang_pred, score) for every row of docs, whole texts.  ``und`` with score 0 where the text is null or
        has no letter, or nothing was learned; ties go to the first language by name.  score is 1 less the distance's
        share of the greatest possible."""
        rows = profiles.orderBy("lang", "place").collect()  # top rows a language
        langs = sorted({r["lang"] for r in rows})
        known = np.unique(np.array([r["gram"] for r in rows], np.int64))
        places = np.full((len(known) + 1, len(langs)), -1, np.int32)
        for r in rows:
            places[np.searchsorted(known, r["gram"]), langs.index(r["lang"])] = r["place"]
        table, top = docs.sparkSession.sparkContext.broadcast((langs, known, places)), self.top

        def run(batches):
            langs, known, places = table.value
            for b in batches:
                names, scores = [], []
                for lo, hi, data, offs in text_slices(b.column(1), SLICE):
                    grams, first, letters = _grams(data, offs)
                    for row in range(hi - lo):
                        if not letters[row] or not langs:
                            names.append("und"), scores.append(0.0)
                            continue
                        v = np.sort(grams[first[row] : first[row + 1]])
                        at = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1], [True])))
                        v, n = v[at[:-1]], np.diff(at)
                        if len(v) > top:
                            # only n-grams at least as frequent as the last one kept need ordering
                            cut = n >= np.partition(n, len(n) - top)[len(n) - top]
                            v, n = v[cut], n[cut]
                        own = v[np.argsort(-n, kind="stable")][:top]
                        k = np.searchsorted(known, own)
                        k[known[np.minimum(k, len(known) - 1)] != own] = len(known)
                        p = places[k]
                        d = np.where(p < 0, top, np.abs(p - np.arange(len(own))[:, None])).sum(0)
                        best = int(d.argmin())
                        names.append(langs[best]), scores.append(1.0 - float(d[best]) / (top * len(own)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
        kind = dict(docs.dtypes)["doc_id"]
        return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")
