"""Toxicity: cumulative-link ordinal regression of a severity grade on sparse word features.

P(grade <= k) is a logistic function of ``threshold[k] - w . x``: one weight vector shared by all ordered
thresholds.  Features are the words and word beginnings that stand out in the toxic training texts (chi-square,
from a bounded sample of labelled rows), all that pass.  Those that stand in the very same training texts share one
column, whose count is that of its most frequent member.  A column has two values: its log-scaled count, and its
log-scaled count per thousand words.  Labels say toxic or not; grades of the toxic rows, where the labels give none, are the thirds of the
share of such words.  Both sides weigh alike in the fit, whose thresholds are then moved to the labels' toxic share; the
cut-off is the one with the fewest errors on a quarter of the sample that a first fit leaves out, and stays above the
score of a text without features, so such a text is never called toxic.  Every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.classify import bounded_sample
from finlens.llm.kit import _BYTE_KEY, ALNUM, arrow_map, byte_words, mix, ranges, span_hashes, stored, text_slices

SLICE = 1 << 19


@dataclass(frozen=True)
class Model:
    words: np.ndarray       # sorted hashes of the features,
    column: np.ndarray      # and the column that each belongs to
    weights: np.ndarray     # 2 x columns: of the counts, of the counts per thousand words
    thresholds: np.ndarray  # ascending, one less than grades
    cut: float = 0.5        # toxicity from which a text is called toxic

    @property
    def featureless(self) -> float:
        """Toxicity of a text without any feature."""
        return float(1 / (1 + np.exp(np.clip(self.thresholds[0], -30, 30))))


BEGINNINGS = (5, 6, 7)  # bytes of a word beginning
CUTS = np.arange(1, 20) / 20  # cut-offs tried on held-out rows


def _features(data, offs):
    """Feature hashes of a slice's words, the text that each stands in, and the number of words of each text."""
    starts, ends, hashes, first = byte_words(data, offs, ALNUM)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    low = np.where((data >= 65) & (data <= 90), data + 32, data)
    all_, of = [hashes], [doc]
    for k in BEGINNINGS:
        long = np.flatnonzero(ends - starts >= k)
        n = np.full(len(long), k)
        all_.append(mix(span_hashes(_BYTE_KEY[low[ranges(starts[long], n)]], n) + np.uint64(k)))
        of.append(doc[long])
    return np.concatenate(all_), np.concatenate(of), np.diff(first)


def _counts(data, offs):
    """Of each text: distinct feature hashes, their counts, and the number of words."""
    hashes, doc, n = _features(data, offs)
    order = np.argsort(doc, kind="stable")
    hashes, cut = hashes[order], np.searchsorted(doc[order], np.arange(len(offs)))
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)):
        yield *np.unique(hashes[a:b], return_counts=True), int(n[i])


@dataclass(frozen=True)
class OrdinalToxicity:
    train_rows: int = 2000   # of each side, about; never over twice as many
    least_docs: int = 3      # toxic training texts that a feature word must stand in
    chi_square: float = 30.0
    grades: int = 3          # of toxic rows, where the labels give none
    penalty: float = 3e-4
    rounds: int = 800

    def fit(self, docs: DataFrame, labels: DataFrame, grade: str = "toxic") -> Model:
        """labels: (doc_id, grade), grades from 0; null grades and unknown ids teach nothing."""
        known = labels.where(F.col(grade) >= 0).select("doc_id", F.col(grade).cast("int").alias("grade"))
        picked = [bounded_sample(known.where(side), self.train_rows, "doc_id") for side in ("grade = 0", "grade > 0")]
        few = F.broadcast(picked[0].union(picked[1]))  # 4 * train_rows rows at most
        # copies of a text are one witness
        sample = stored(docs.select("doc_id", "text").join(few, "doc_id").where("text is not null").select(F.col("grade").alias("grade_"), "text").dropDuplicates(), "toxicity-sample")
        share = known.agg(F.avg((F.col("grade") > 0).cast("double"))).first()[0] or 0.0
        held = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
        trial = self._learn(sample.where(~held), share)
        scores = self.predict(sample.where(held), trial).select((F.col("grade_") > 0).alias("y"), "toxicity").toPandas()  # 2 * train_rows rows at most
        model = self._learn(sample, share)
        # never at or below the score of a text that shows nothing at all
        return replace(model, cut=max(_cut(scores["toxicity"].to_numpy(), scores["y"].to_numpy(bool), share), float(np.nextafter(model.featureless, 2)), float(np.nextafter(trial.featureless, 2))))

    def _learn(self, sample: DataFrame, share: float) -> Model:
        """The model of a stored sample (grade_, text), its toxicity for a toxic share of ``share``."""
        sample = sample.select(F.col("grade_").alias("grade"), "text")
        sides = {r["toxic"]: r["count"] for r in sample.groupBy((F.col("grade") > 0).alias("toxic")).count().collect()}
        kept, column = self._words(sample, sides.get(True, 0), sides.get(False, 0))
        if not len(kept):
            return Model(kept, column, np.zeros((2, 0)), np.array([20.0]))

        def values(batches):
            for b in batches:
                at, out, sizes = [], [], []
                for _, _, d, o in text_slices(b.column(1), SLICE):
                    hashes, doc, n = _features(d, o)
                    each, col, c = _columns(kept, column, hashes, doc)
                    cuts = np.searchsorted(each, np.arange(1, len(o) - 1))
                    at += np.split(col, cuts) if len(o) > 1 else []
                    out += np.split(c, cuts) if len(o) > 1 else []
                    sizes += n.tolist()
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.list_(pa.int64())), pa.array(out, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                                                 names=["grade", "at", "n", "size"])
        rows = arrow_map(sample, values, "grade int, at array<long>, n array<long>, size long").toPandas()  # only counts above 0
        rows = sorted(zip(rows["grade"].tolist(), rows["size"].tolist(), map(list, rows["at"]), map(list, rows["n"]), strict=True))
        y, sizes = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        row = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        col, n = (np.array([v for r in rows for v in r[k]], np.int64) for k in (2, 3))
        each = np.maximum(sizes, 1)[row]
        width = int(column.max()) + 1
        x = np.concatenate((row, row)), np.concatenate((col, col + width)), np.concatenate((np.log1p(n), np.log1p(1000 * n / each)))
        if y.max() == 1 and self.grades > 1:
            marked = np.bincount(row, n, len(y)) / np.maximum(sizes, 1)
            cuts = np.quantile(marked[y > 0], np.arange(1, self.grades) / self.grades)
            y = np.where(y > 0, 1 + np.searchsorted(cuts, marked, side="left"), 0)
        weights, thresholds = self._ordinal(x, 2 * width, y)
        # both sides weighed alike in the fit: back to the share that the labels have
        return Model(kept, column, weights, thresholds + np.log((1 - share) / share))

    def _words(self, sample: DataFrame, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the features that stand out, sorted, and their columns; document counts are summed by Spark."""
        if not toxic or not clean:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def run(batches):
            for b in batches:
                grades = b.column(0).to_numpy()
                for lo, _, d, o in text_slices(b.column(1), SLICE):
                    held, side, sign = [], [], []
                    for i, (v, _, _) in enumerate(_counts(d, o), lo):
                        held.append(v)
                        side.append(np.full(len(v), grades[i] > 0))
                        sign.append(np.full(len(v), int(mix(v.sum(keepdims=True))[0] >> np.uint64(34))))
                    v, at = np.unique(np.concatenate(held), return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v.view(np.int64)), pa.array(np.bincount(at[np.concatenate(side)], minlength=len(v)).astype(np.int64)),
                         pa.array(np.bincount(at, minlength=len(v)).astype(np.int64)),
                         pa.array(np.bincount(at, np.concatenate(sign), len(v)).astype(np.int64))], names=["h", "toxic", "all", "texts"])
        a, n1, n0 = F.col("a").cast("double"), float(toxic), float(clean)
        b = F.col("n").cast("double") - a
        c, d = F.lit(n1) - a, F.lit(n0) - b
        chi = (n1 + n0) * F.pow(a * d - b * c, F.lit(2.0)) / ((a + b) * F.greatest(c + d, F.lit(1e-9)) * n1 * n0)
        found = (arrow_map(sample, run, "h long, toxic long, all long, texts long")
                 .groupBy("h").agg(F.sum("toxic").alias("a"), F.sum("all").alias("n"), F.sum("texts").alias("texts"))
                 .where((a >= self.least_docs) & (a / n1 > b / n0)).withColumn("chi", chi).where(F.col("chi") >= self.chi_square))
        # features that stand in the very same texts share a column
        rows = sorted(((r["h"], (r["a"], r["n"], r["texts"])) for r in found.select("h", "a", "n", "texts").collect()), key=lambda r: r[0] % (1 << 64))
        number: dict = {}
        column = [number.setdefault(k, len(number)) for _, k in rows]
        return np.array([h for h, _ in rows], np.int64).view(np.uint64), np.array(column, np.int64)

    def _ordinal(self, x: tuple[np.ndarray, np.ndarray, np.ndarray], f: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weights of f features and thresholds; x: row, feature and value of those that are not 0.  Maximum likelihood by Adam steps; thresholds are a first one and positive gaps, so they stay in order."""
        levels = int(y.max())
        row, col, value = x
        weight = np.where(y == 0, (y > 0).sum(), (y == 0).sum()) / len(y)  # both sides weigh alike
        p = np.concatenate((np.zeros(f), [1.0], np.zeros(levels - 1)))
        m, s = np.zeros_like(p), np.zeros_like(p)
        for t in range(1, self.rounds + 1):
            gaps = np.exp(p[f + 1 :])
            cut = p[f] + np.concatenate(([0.0], np.cumsum(gaps)))
            z = np.concatenate((np.full((len(y), 1), -np.inf), cut[None, :] - np.bincount(row, value * p[col], len(y))[:, None], np.full((len(y), 1), np.inf)), 1)
            cdf = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            cdf[:, 0], cdf[:, -1] = 0.0, 1.0
            lo, hi = cdf[np.arange(len(y)), y], cdf[np.arange(len(y)), y + 1]
            like = np.maximum(hi - lo, 1e-12)
            dlo, dhi = lo * (1 - lo) / like, hi * (1 - hi) / like
            score = weight * (dhi - dlo)                     # d log-likelihood / d(all thresholds)
            grad = np.zeros_like(p)
            grad[:f] = np.bincount(col, value * score[row], f) / len(y) + self.penalty * p[:f]
            grad[f] = -score.mean()
            for k in range(1, levels):                       # a gap moves every threshold from k on
                up = np.where(y >= k, weight * dhi * (y < levels), 0.0)
                down = np.where(y - 1 >= k, weight * dlo, 0.0)
                grad[f + k] = -(up - down).mean() * gaps[k - 1]
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad**2
            p = p - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        return p[:f].reshape(2, -1), p[f] + np.concatenate(([0.0], np.cumsum(np.exp(p[f + 1 :]))))

    def predict(self, docs: DataFrame, model: Model, threshold: float | None = None) -> DataFrame:
        """All columns of docs with toxicity (P(grade > 0)), severity (expected grade), grade (the most thresholds passed
        with even odds) and toxic (toxicity >= threshold, the model's cut-off where none is given).  A null or wordless text has no features.  New columns
        replace old ones of these names."""
        table = docs.sparkSession.sparkContext.broadcast(model)
        kinds = dict(docs.dtypes)
        where = docs.columns.index("text")
        new = ["toxicity double", "severity double", "grade int"]
        names = [f"_c{i}" for i in range(len(docs.columns))] + [x.split()[0] for x in new]

        def run(batches):
            m = table.value
            for b in batches:
                line = []
                for _, _, data, offs in text_slices(b.column(where), SLICE):
                    hashes, doc, sizes = _features(data, offs)
                    each, word, n = _columns(m.words, m.column, hashes, doc)
                    gain = np.zeros(0)
                    if len(n):
                        gain = np.log1p(n) * m.weights[0][word] + np.log1p(1000 * n / sizes[each]) * m.weights[1][word]
                    line.append(np.bincount(each, gain, len(offs) - 1))
                s = np.concatenate([np.zeros(0), *line])
                over = 1 / (1 + np.exp(np.clip(m.thresholds[None, :] - s[:, None], -30, 30)))
                cols = [pa.array(over[:, 0]), pa.array(over.sum(1)), pa.array((over >= 0.5).sum(1).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=names)
        out = arrow_map(docs, run, ", ".join([f"_c{i} {kinds[c]}" for i, c in enumerate(docs.columns)] + new))
        fresh = ("toxicity", "severity", "grade", "toxic")
        kept = [F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in fresh]
        return out.select(*kept, "toxicity", "severity", "grade", (F.col("toxicity") >= (model.cut if threshold is None else threshold)).alias("toxic"))


def _cut(scores: np.ndarray, toxic: np.ndarray, share: float) -> float:
    """The cut-off with the fewest errors on held-out rows, both sides brought to the labels' share; of several, the middle one.
    Without rows of both sides, even odds."""
    if not toxic.any() or toxic.all():
        return 0.5
    errors = [share * (scores[toxic] < c).mean() + (1 - share) * (scores[~toxic] >= c).mean() for c in CUTS]
    best = np.flatnonzero(np.isclose(errors, min(errors)))
    return float(CUTS[best[len(best) // 2]])


def _columns(words: np.ndarray, column: np.ndarray, hashes: np.ndarray, doc: np.ndarray):
    """Text, column and count, by text and column, from feature hashes and the text that each stands in."""
    if not len(words) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    hit = np.flatnonzero(words[at] == hashes)
    pair, n = np.unique(doc[hit] * len(words) + at[hit], return_counts=True)
    width = int(column.max()) + 1
    key = pair // len(words) * width + column[pair % len(words)]
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    return key[cut] // width, key[cut] % width, np.maximum.reduceat(n, cut) if len(cut) else n
