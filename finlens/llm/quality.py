"""Quality classifier: a linear support vector machine on n-gram indicators scaled by Naive Bayes log-count ratios.

Indicators of character n-grams (hashed bytes, 2 to 4, as written) and of how many word pairs are one word twice
are scaled by the log ratio of their counts in
the two classes; a hinge-loss model is fitted to them by dual coordinate descent and its margin turned into a
probability on rows kept out of the fit.  The model is fitted on a bounded sample of labelled rows (``train_rows``,
about as many of either label as there are, at most); every text is scored whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.llm.classify import bounded_sample
from finlens.llm.kit import NOT_SPACE, arrow_map, byte_words, mix, text_slices

_ORDERS = (2, 3, 4)
_TWICE = (1e-9, 0.01, 0.03, 0.1, 0.3, 0.6)  # shares of word pairs that are one word twice, an indicator each
SLICE = 1 << 19


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per feature, log-count ratio times hinge weight
    bias: float
    slope: float  # of the probability, over the margin
    shift: float

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.shift, -30, 30)))


def _features(data: np.ndarray, offs: np.ndarray, bits: int) -> list[np.ndarray]:
    """Sorted distinct features of each text of a slice."""
    d, n = data.astype(np.uint64), len(data)
    codes = []
    for k in _ORDERS:
        h = np.full(max(n - k + 1, 0), k, np.uint64)
        for j in range(k if len(h) else 0):
            h = (h << np.uint64(8)) | d[j : n - k + 1 + j]
        codes.append((mix(h) >> np.uint64(64 - bits)).astype(np.int32))
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        v = np.sort(np.concatenate([c[a : max(a, b - k + 1)] for k, c in zip(_ORDERS, codes, strict=True)]))
        out.append(v[np.concatenate(([True], v[1:] != v[:-1]))] if len(v) else v)
    _, _, words, first = byte_words(data, offs, NOT_SPACE)
    same = np.concatenate(([0], np.cumsum(words[1:] == words[:-1]))) if len(words) else np.zeros(1, np.int64)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b - a > 1:
            level = int(np.searchsorted(_TWICE, (same[b - 1] - same[a]) / (b - a - 1), side="right"))
            if level:
                out[i] = np.append(out[i], np.arange(1 << bits, (1 << bits) + level, dtype=np.int32))
    return out


@dataclass(frozen=True)
class NbSvm:
    train_rows: int = 3000   # of each label, about; never over twice as many
    bits: int = 17           # features: 2 to this power
    smoothing: float = 1.0
    cost: float = 1.0
    rounds: int = 20
    seed: int = 7

    def fit(self, docs: DataFrame, labels: DataFrame, label: str = "label") -> Model:
        """labels: (doc_id, label 0/1); null labels and unknown ids teach nothing, a text without n-grams neither."""
        bits = self.bits

        def run(batches):
            for b in batches:
                rows = [f.astype("<i4").tobytes() for _, _, d, o in text_slices(b.column(1), SLICE) for f in _features(d, o, bits)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.binary())], names=["label", "features"])
        known = labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
        picked = [bounded_sample(known.where(F.col("label") == v), self.train_rows, "doc_id") for v in (0, 1)]
        few = F.broadcast(picked[0].union(picked[1]))  # 4 * train_rows rows at most
        rows = arrow_map(docs.select("doc_id", "text").join(few, "doc_id").select("label", "text"), run, "label int, features binary").toPandas()
        x = [np.frombuffer(f, "<i4") for f in rows["features"]]
        y = rows["label"].to_numpy()
        order = sorted((i for i in range(len(x)) if len(x[i])), key=lambda i: (hashlib.blake2b(x[i], digest_size=12).digest(), y[i]))
        return self._fitted([x[i] for i in order], np.array([y[i] for i in order], np.int64))

    def _fitted(self, x: list[np.ndarray], y: np.ndarray) -> Model:
        size = (1 << self.bits) + len(_TWICE)
        if not (y == 0).any() or not (y == 1).any():
            # one label only, or none: nothing separates the texts
            return Model(np.zeros(size), 0.0, 0.0, 30.0 if (y == 1).any() else -30.0 if len(y) else 0.0)
        rng = np.random.default_rng(self.seed)
        held = rng.random(len(x)) < 0.25
        fitting = np.flatnonzero(~held) if len({*y[~held]}) == 2 and len({*y[held]}) == 2 else np.arange(len(x))
        checking = np.flatnonzero(held) if len(fitting) < len(x) else fitting
        counts = [np.full(size, self.smoothing), np.full(size, self.smoothing)]
        for i in fitting:
            counts[y[i]][x[i]] += 1
        ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))
        # dual coordinate descent for hinge loss: min 1/2 |w|^2 + C sum max(0, 1 - s w.x), the bias as a feature of 1.
        # Rows are scaled to length 1, so long and short texts weigh alike.
        size_of = [max(np.sqrt((ratio[f] ** 2).sum()), 1e-9) for f in x]
        v = lambda i: ratio[x[i]] / size_of[i]
        w, bias, alpha = np.zeros(size), 0.0, np.zeros(len(x))
        sign = np.where(y == 1, 1.0, -1.0)
        cost = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum())) * self.cost
        for _ in range(self.rounds):
            for i in rng.permutation(fitting):
                row = v(i)
                gradient = sign[i] * (w[x[i]] @ row + bias) - 1
                new = min(max(alpha[i] - gradient / 2, 0.0), cost[i])
                if new != alpha[i]:
                    step = (new - alpha[i]) * sign[i]
                    w[x[i]] += step * row
                    bias += step
                    alpha[i] = new
        margin = np.array([w[x[i]] @ v(i) + bias for i in checking])
        slope, shift = _calibrated(margin, y[checking])
        return Model(np.stack([w * ratio, ratio**2]), bias, slope, shift)

    def predict(self, docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
        """All columns of docs with score (0 to 1: probability of label 1) and predicted (1 if score >= threshold).  A null
        text, or one too short for an n-gram, has the score of an empty feature set.  New columns replace old ones
        of these names."""
        table, bits = docs.sparkSession.sparkContext.broadcast(model), self.bits
        kinds = dict(docs.dtypes)
        where = docs.columns.index("text")
        names = [f"_c{i}" for i in range(len(docs.columns))] + ["score"]

        def run(batches):
            m = table.value
            flat = m.weights if m.weights.ndim == 2 else np.stack([m.weights, m.weights])
            for b in batches:
                margin = []
                for _, _, data, offs in text_slices(b.column(where), SLICE):
                    for f in _features(data, offs, bits):
                        margin.append(flat[0][f].sum() / max(np.sqrt(flat[1][f].sum()), 1e-9))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(m.score(np.array(margin)), pa.float64())], names=names)
        out = arrow_map(docs, run, ", ".join([f"_c{i} {kinds[c]}" for i, c in enumerate(docs.columns)] + ["score double"]))
        kept = [F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in ("score", "predicted")]
        return out.select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _calibrated(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through (margin, label), by Newton steps with smoothed targets."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * b
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return float(max(b[0], 1e-6)), float(b[1])
