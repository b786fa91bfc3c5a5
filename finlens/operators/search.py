"""Adaptive parameter search (M6): a Parzen-estimator sampler and the folds that its trials share.

The sampler models each parameter's density over the better trials and over the others and proposes the draw that is likeliest
under the first against the second.  Preparation is fitted once for each fold, not once for each trial: the prepared vectors of every
fold version stand beside each other in one stored table, and their bin numbers in another.  Trials of the
histogram families run together in the same jobs; ensemble weights are scored from sums of products of the members' held-out
predictions, so a trial of them costs no job at all.
"""

from __future__ import annotations

import math
import random
import uuid
from collections.abc import Callable, Sequence
from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlens.functions.exprs import c
from finlens.operators import boosting
from finlens.operators.evaluate import regression_metrics
from finlens.session import scratch_path

FITS_AT_ONCE = 25  # histograms that the driver holds grow with these


class ParzenSampler:
    """Proposals for a space ``name -> (kind, low, high)`` with kind int or float, in the order of the trials.

    The first ``startup`` trials are plain draws.  Then the best ``share`` of the trials seen, one at least, and the others each give
    a mixture of normal densities cut to the range, one around every trial's value and a wide one over the range; of ``candidates``
    draws from the first the one with the greatest ratio of the two is proposed, for each parameter."""

    def __init__(self, space: dict, seed: int | str = 42, startup: int = 4, share: float = 0.25, candidates: int = 24):
        self.space, self.startup, self.share, self.candidates = space, startup, share, candidates
        self.rng = random.Random(seed)

    def draw(self) -> dict:
        return {k: self.rng.randint(lo, hi) if kind == "int" else self.rng.uniform(lo, hi) for k, (kind, lo, hi) in self.space.items()}

    def ask(self, seen: Sequence[tuple[dict, float]]) -> dict:
        """The next trial after those in ``seen`` (parameters, score; greater is better)."""
        if len(seen) < self.startup:
            return self.draw()
        ranked = sorted(seen, key=lambda t: -t[1])
        cut = max(1, math.ceil(self.share * len(ranked)))
        out = {}
        for k, (kind, lo, hi) in self.space.items():
            good, rest = (_Mixture([t[0][k] for t in part], lo, hi, kind == "int") for part in (ranked[:cut], ranked[cut:]))
            tried = [good.draw(self.rng) for _ in range(self.candidates)]
            best = max(tried, key=lambda x: good.log_density(x) - rest.log_density(x))  # noqa: B023
            out[k] = int(best) if kind == "int" else best
        return out


class _Mixture:
    """Normal densities around values, cut to [lo, hi], and one over the whole range."""

    def __init__(self, values, lo, hi, whole: bool):
        self.lo, self.hi, self.whole = lo - 0.5 * whole, hi + 0.5 * whole, whole
        span = max(self.hi - self.lo, 1e-12)
        at = sorted([*values, (lo + hi) / 2])
        middle = at.index((lo + hi) / 2)
        least = span / min(100.0, 1.0 + len(at))
        self.parts = []
        for i, m in enumerate(at):
            near = max(m - (at[i - 1] if i else self.lo), (at[i + 1] if i + 1 < len(at) else self.hi) - m)
            self.parts.append((m, span if i == middle else min(max(near, least), span)))

    def _mass(self, m, s, a, b):
        phi = lambda x: 0.5 * (1 + math.erf((x - m) / (s * math.sqrt(2))))
        return phi(b) - phi(a)

    def draw(self, rng):
        m, s = rng.choice(self.parts)
        while True:  # both ends lie within the range, so at least a third of the draws do
            x = rng.gauss(m, s)
            if self.lo <= x <= self.hi:
                return min(max(round(x), math.ceil(self.lo)), math.floor(self.hi)) if self.whole else x

    def log_density(self, x):
        total = 0.0
        for m, s in self.parts:
            inside = max(self._mass(m, s, self.lo, self.hi), 1e-300)
            if self.whole:
                total += self._mass(m, s, x - 0.5, x + 0.5) / inside
            else:
                total += math.exp(-0.5 * ((x - m) / s) ** 2) / (s * math.sqrt(2 * math.pi)) / inside
        return math.log(max(total / len(self.parts), 1e-300))


class Folds:
    """A training table prepared once for each of its folds."""

    def __init__(self, prep: Pipeline, train: DataFrame, label: str = "y_log", fold: str = "fold", features: str = "features"):
        self.prep, self.label, self.fold, self.features = prep, label, fold, features
        self.train = train
        self.numbers = sorted(r[0] for r in train.where(c(fold).isNotNull()).select(c(fold)).distinct().collect())  # folds are few
        self.fitted = 0

    @cached_property
    def prepared(self) -> DataFrame:
        """(label, fold, key, z0, z1, ...): zi is prepared by what the rows outside fold i teach; stored."""
        out = self.train.withColumn("__key", F.concat_ws("|", *[c(x).cast("string") for x in self.train.columns]))
        kept = [*self.train.columns, "__key"]
        for i, f in enumerate(self.numbers):
            model = self.prep.fit(self.train.where(c(self.fold) != f))
            self.fitted += 1
            out = model.transform(out).select(*[c(x) for x in kept], vector_to_array(c(self.features)).alias(f"__z{i}"))
            kept.append(f"__z{i}")
        path = scratch_path(self.train.sparkSession, f"folds-{uuid.uuid4().hex[:12]}")
        out.select(c(self.label), c(self.fold), "__key", *[f"__z{i}" for i in range(len(self.numbers))]).write.parquet(path)
        return self.train.sparkSession.read.parquet(path)

    @cached_property
    def binned(self) -> boosting.Binned:
        return boosting.bin_rows(self.prepared, [f"__z{i}" for i in range(len(self.numbers))], self.label, key=F.col("__key"), fold=self.fold, held=self.numbers)

    def part(self, i: int) -> tuple[DataFrame, DataFrame]:
        """The rows outside and inside fold i, with its prepared vector as ``features``."""
        rows = self.prepared.select(c(self.label), c(self.fold), array_to_vector(f"__z{i}").alias(self.features))
        f = self.numbers[i]
        return rows.where(c(self.fold) != f), rows.where(c(self.fold) == f)

    def _fits(self, trials: Sequence[boosting.Boost]) -> list[boosting.Fit]:
        return [boosting.Fit(b, version=i, held=f) for b in trials for i, f in enumerate(self.numbers)]

    def grown(self, trials: Sequence[boosting.Boost]) -> list[boosting.Ensemble]:
        """The models of every trial and fold (the folds of a trial in a row), fitted together."""
        fits = self._fits(trials)
        return [m for lo in range(0, len(fits), FITS_AT_ONCE) for m in boosting.boost(self.binned, fits[lo : lo + FITS_AT_ONCE])]

    def boosted(self, trials: Sequence[boosting.Boost]) -> list[list[dict]]:
        """Held-out metrics of every trial and fold, fitted together."""
        fits = self._fits(trials)
        scores = []
        for lo in range(0, len(fits), FITS_AT_ONCE):
            some = fits[lo : lo + FITS_AT_ONCE]
            scores += boosting.held_out_scores(self.binned, some, boosting.boost(self.binned, some))
        k = len(self.numbers)
        return [scores[j * k : (j + 1) * k] for j in range(len(trials))]

    def estimated(self, estimators: Sequence, threads: int = 2) -> list[list[dict]]:
        """Held-out metrics of every estimator over the features column and fold."""
        parts = [tuple(x.persist(StorageLevel.MEMORY_AND_DISK) for x in self.part(i)) for i in range(len(self.numbers))]
        try:
            def one(job):
                e, i = job
                r = regression_metrics(e.fit(parts[i][0]).transform(parts[i][1]), self.label, e.getPredictionCol()).first()
                return {k: r[k] for k in ("n", "r2", "mae", "mse")}
            with ThreadPool(threads) as pool:
                got = pool.map(one, [(e, i) for e in estimators for i in range(len(parts))])
        finally:
            for p in parts:
                for x in p:
                    x.unpersist()
        return [got[j * len(parts) : (j + 1) * len(parts)] for j in range(len(estimators))]

    def products(self, members: Sequence) -> list[dict]:
        """Of each fold: sums of y, y^2, the members' held-out predictions times y and times each other, and rows."""
        out = []
        for i in range(len(self.numbers)):
            fit_rows, rows = (x.persist(StorageLevel.MEMORY_AND_DISK) for x in self.part(i))
            try:
                for j, m in enumerate(members):
                    model = m.copy({m.predictionCol: f"__p{j}"}).fit(fit_rows)
                    rows = model.transform(rows)
                y, p = c(self.label), [F.col(f"__p{j}") for j in range(len(members))]
                sums = [F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")]
                sums += [F.sum(a * y).alias(f"y{j}") for j, a in enumerate(p)]
                sums += [F.sum(p[j] * p[k]).alias(f"p{j}_{k}") for j in range(len(p)) for k in range(j, len(p))]
                out.append(rows.agg(*sums).first().asDict())
            finally:
                fit_rows.unpersist()
        return out


def weighted_r2(products: Sequence[dict], weights: Sequence[float]) -> float:
    """Mean held-out R2 of the weighted mean of members, from Folds.products()."""
    w = [x / sum(weights) for x in weights]
    scores = []
    for r in products:
        if not r["n"]:
            continue
        cross = sum(w[j] * r[f"y{j}"] for j in range(len(w)))
        square = sum(w[j] * w[k] * r[f"p{min(j, k)}_{max(j, k)}"] for j in range(len(w)) for k in range(len(w)))
        scores.append(1 - (r["q"] - 2 * cross + square) / (r["q"] - r["s"] ** 2 / r["n"]))
    return sum(scores) / len(scores)


def mean_r2(folds: Sequence[dict]) -> float:
    """Mean R2 over the folds that hold rows."""
    got = [f["r2"] for f in folds if f["n"] and f["r2"] is not None]
    if not got:
        raise ValueError("no fold holds rows")
    return sum(got) / len(got)


def run_trials(space: dict, score: Callable[[list[dict]], list[float]], trials: int, seed: int | str, batch: int = 2,
               startup: int = 4) -> tuple[list[dict], list[float]]:
    """Parameters and scores of all trials.  Plain draws come first, together; then ``batch`` proposals at a time, those of one batch
    taken to score like the mean so that they differ."""
    sampler, seen = ParzenSampler(space, seed, startup), []
    while len(seen) < trials:
        n = min(startup if not seen else batch, trials - len(seen))
        asked: list[dict] = []
        for _ in range(n):
            mean = sum(s for _, s in seen) / len(seen) if seen else 0.0
            asked.append(sampler.ask([*seen, *[(p, mean) for p in asked]]) if seen else sampler.draw())
        seen += zip(asked, score(asked), strict=True)
    return [p for p, _ in seen], [s for _, s in seen]
