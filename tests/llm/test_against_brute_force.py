"""Language profiles and the quality classifier against plain versions."""

from collections import Counter

import numpy as np
import pytest

from finlens.llm.kit import mix
from finlens.llm.langid import GAP, RankProfiles
from finlens.llm.quality import NbSvm, _features

TEXTS = [("de", "Der Hund läuft über die Straße. " * 3), ("de", "Ein Vogel singt, ein Vogel fliegt!"), ("en", "The dog runs across the street"),
         ("en", "a bird sings; the bird flies away, away"), ("xx", "ÅÅ ßß"), ("en", "the the the"), ("de", ""), ("en", None), (None, "no language here"),
         ("de", "x" * 70_000 + " straße"), ("en", "123 456 ..."), ("de", "Der Hund läuft über die Straße. " * 3)]


def _grams(text):
    """The n-grams of a text's letters, each run of other characters one gap, a gap before the text."""
    out = [GAP]
    for ch in text:
        low = ch.lower()
        code = (ord(low) if len(low) == 1 else ord(ch)) if ch.isalpha() else GAP
        if code != GAP or out[-1] != GAP:
            out.append(code)
    got = Counter(c for c in out if c != GAP)
    got.update(a | b << 21 for a, b in zip(out, out[1:]))
    got.update(a | b << 21 | c << 42 for a, b, c in zip(out, out[1:], out[2:]))
    return got, any(c != GAP for c in out)


def _ranked(counts, top):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:top]]


@pytest.mark.parametrize("top", [3, 25, 400])
def test_out_of_place_distance_equals_the_plain_version(spark, stored_docs, top):
    rows = [(i, t, lang, "s", None) for i, (lang, t) in enumerate(TEXTS)]
    rows += [(None, "Der Vogel ist da", "de", "s", 1), (0, "a second text of this id", None, "s", 1)]  # null and repeated ids
    docs, op = stored_docs(rows), RankProfiles(top)
    profiles = op.learn(docs)
    totals = {}
    for _, text, lang, *_ in rows:
        if lang is not None and text is not None:
            totals.setdefault(lang, Counter()).update(_grams(text)[0])
    want = {lang: _ranked(n, top) for lang, n in totals.items()}
    got = {}
    for r in profiles.orderBy("lang", "place").collect():
        got.setdefault(r["lang"], []).append(r["gram"])
    assert got == want
    found = sorted(((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in op.predict(docs, profiles).collect()), key=str)
    plain = []
    for key, text, *_ in rows:
        n, letters = _grams(text or "")
        if not letters:
            plain.append((key, "und", 0.0))
            continue
        own = _ranked(n, top)
        far = {lang: sum(abs(p.index(g) - i) if g in p else top for i, g in enumerate(own)) for lang, p in want.items()}
        best = min(sorted(far), key=far.get)
        plain.append((key, best, round(1 - far[best] / (top * len(own)), 9)))
    assert found == sorted(plain, key=str)


def _plain_features(text, bits):
    data = text.encode()
    out = set()
    for k in (2, 3, 4):
        for i in range(len(data) - k + 1):
            h = k
            for c in data[i : i + k]:
                h = (h << 8 | c) & (1 << 64) - 1
            out.add(int(mix(np.array([h], np.uint64))[0] >> np.uint64(64 - bits)))
    return sorted(out)


def test_quality_features_of_whole_texts():
    texts = ["", "a", "ab", "clean prose about birds", "ümläut " + "long words " * 400]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0, *[len(t.encode()) for t in texts]])
    for t, f in zip(texts, _features(data, offs, 12), strict=True):
        assert [v for v in f.tolist() if v < 1 << 12] == _plain_features(t, 12)


def test_coordinate_descent_reaches_the_optimum_of_the_hinge_loss():
    rng = np.random.default_rng(3)
    x = [np.unique(rng.integers(0, 60, 12) + (20 if i % 3 else 0)).astype(np.int32) for i in range(40)]
    y = np.array([int(i % 3 > 0) for i in range(40)])
    y[:4] = 1 - y[:4]  # not separable
    op = NbSvm(bits=7, rounds=3000)
    model = op._fitted(x, y)
    held = np.random.default_rng(op.seed).random(len(x)) < 0.25
    rows = np.flatnonzero(~held)
    # log-count ratios counted one by one
    size = (1 << 7) + 6
    n = [[1.0 + sum(f in x[i] for i in rows if y[i] == c) for f in range(size)] for c in (0, 1)]
    ratio = np.array([np.log((b / sum(n[1])) / (a / sum(n[0]))) for a, b in zip(*n)])
    assert np.allclose(model.weights[1], ratio**2)
    z = np.zeros((len(rows), size + 1))
    for r, i in enumerate(rows):
        z[r, x[i]] = ratio[x[i]]
        z[r] /= np.linalg.norm(z[r])
        z[r, -1] = 1.0  # the bias
    s = np.where(y[rows] == 1, 1.0, -1.0)
    cost = np.array([len(y) / (2 * (y == c).sum()) for c in y[rows]])
    w = np.append(np.divide(model.weights[0], ratio, out=np.zeros(size), where=ratio != 0), model.bias)
    primal = 0.5 * w @ w + (cost * np.maximum(0, 1 - s * (z @ w))).sum()
    q, alpha = (z * s[:, None]) @ (z * s[:, None]).T, np.zeros(len(rows))
    step = 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(100_000):  # projected gradient on the dense dual
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, cost)
    dual = alpha.sum() - 0.5 * alpha @ q @ alpha
    assert dual - 1e-6 <= primal <= dual * 1.001 + 1e-6
