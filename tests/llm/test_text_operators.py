"""Operators on documents against brute force, and the cases every operator must bear: nulls, empty and long texts,
repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import random
import re

import numpy as np
import pytest

from finlens.llm import bpe
from finlens.llm.decontaminate import Automaton, Decontaminator
from finlens.llm.langid import RankProfiles
from finlens.llm.ngram_join import JaccardJoin, jaccard_groups
from finlens.llm.queries import tokenizer_file
from finlens.llm.quality import NbSvm
from finlens.llm.toxicity import OrdinalToxicity

WORDS = [f"w{i}" for i in range(400)]


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            m = len(sets[i] & sets[j])
            if m and 100 * m >= 80 * (len(sets[i]) + len(sets[j]) - m):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)}


def near_copies(n, seed):
    r = random.Random(seed)
    base = [[r.choice(WORDS) for _ in range(r.choice([3, 8, 60, 120]))] for _ in range(n // 6)]
    passage = [r.choice(WORDS) for _ in range(50)]
    out = []
    for i in range(n):
        w = list(r.choice(base)) if r.random() < 0.7 else passage + [r.choice(WORDS) for _ in range(r.randint(5, 80))]
        for _ in range(r.choice([0, 0, 1, 2, 3])):
            w[r.randrange(len(w))] = r.choice(WORDS)
        out.append((i * 7 + 3, r.choice([" ", "\n", "\t "]).join(x.upper() if r.random() < 0.1 else x for x in w)))
    return out


def test_jaccard_join_equals_brute_force(spark, stored_docs):
    rows = near_copies(240, 4) + [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "ONE"), (9006, "é x")]
    docs = stored_docs([(d, t, "en", "s", 0) for d, t in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(docs, block=16).collect()}
    assert got == brute_components(rows)
    # repeated rows stay, a null id keeps its row
    twice = stored_docs([(1, "a b c d e f", None, None, None)] * 2 + [(None, "a b c d e f", None, None, None), (None, None, None, None, None)])
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_groups(twice).collect()) == [(0, 0, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1)]
    assert jaccard_groups(stored_docs([])).count() == 0


def test_whole_join_counts_every_link(spark, stored_docs):
    rows = near_copies(240, 4) + [(9001, None), (9002, ""), (9004, "one"), (9005, "ONE")]
    docs = stored_docs([(d, t, "en", "s", 0) for d, t in rows])
    sets = [shingles(t) for _, t in rows]
    linked = [[i != j and bool(a & b) and 100 * len(a & b) >= 80 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    part = brute_components(rows)
    want = {d: (part[d][0], sum(linked[i]), part[d][1]) for i, (d, _) in enumerate(rows)}
    for block in (1024, 16):
        out, links = JaccardJoin(block=block).groups(docs, whole=True)
        assert {r.doc_id: (r.n_shingles, r.n_links, r.component_id) for r in out.collect()} == want
        different = {frozenset((frozenset(sets[i]), frozenset(sets[j]))) for i in range(len(rows)) for j in range(i) if linked[i][j] and sets[i] != sets[j]}
        assert links.count() == len(different) > JaccardJoin(block=block).groups(docs)[1].count()


def test_repeated_shingles_rank_last_without_changing_results(stored_docs):
    rows = near_copies(120, 9)
    docs = stored_docs([(d, t, "en", "s", 0) for d, t in rows])
    assert len(JaccardJoin().repeated(docs)) > 0
    assert {tuple(r) for r in jaccard_groups(docs, heavy=0).collect()} == {tuple(r) for r in jaccard_groups(docs).collect()}


def test_bpe_equals_the_library(spark, stored_docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_file())
    r = random.Random(2)
    parts = [*"ab's t're1 2\n\t''  　éÉ!?-_<|>", "'s", "'ll", "'ve", "  ", "<|endoftext|>", "\r\n", "漢", "é", "word ", " 12a", "Ᲊ"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 30)))) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "lorem ipsum " * 20000), (903, " " * 5000), (903, " " * 5000), (None, "no id")]
    docs = stored_docs([(d, x, None, None, 0) for d, x in rows])
    got = sorted((g.doc_id if g.doc_id is not None else -1, g.n_tokens, g.ids_sha256, g.decoded_sha256)
                 for g in bpe.digests(docs, tokenizer_file()).collect())
    want = []
    for d, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((d if d is not None else -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)
    small = bpe.encode(docs, tokenizer_file(), block_bytes=64)  # words meet over many blocks
    assert sorted(hashlib.sha256(g.ids).hexdigest() for g in small.collect()) == sorted(w[2] for w in want)
    assert bpe.digests(stored_docs([]), tokenizer_file()).count() == 0


def brute_hits(text, items, window=10):
    words = lambda s: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (s or "").encode().lower())
    w, hit, found = words(text), set(), set()
    for name, t in items:
        x = words(t)
        grams = [x[i : i + window] for i in range(len(x) - window + 1)] if len(x) >= window else [x] if x else []
        for g in grams:
            for i in range(len(w) - len(g) + 1):
                if w[i : i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


def test_decontamination_equals_brute_force(spark, stored_docs):
    r = random.Random(8)
    vocab = list("abcdé") + ["x1", "Ü"]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([2, 4, 10, 11, 14, 25])))) for i in range(30)] + [(50, None), (51, "?!")]
    rows = []
    for i in range(200):
        w = [r.choice(vocab + ["z", "q"]) for _ in range(r.randint(0, 60))]
        if r.random() < 0.5:
            w[5:5] = r.choice(items[:30])[1].upper().split()
        rows.append((i, r.choice([" ", ", ", "\n"]).join(w)))
    rows += [(500, None), (501, ""), (500, None)]
    docs = stored_docs([(d, t, None, "s", 7) for d, t in rows])
    bench = spark.createDataFrame(items, "item_id long, text string")
    engine = Decontaminator()
    got = sorted((g.doc_id, g.n_words, g.n_hit, tuple(g["items"])) for g in engine.scan(docs, bench).collect())
    assert got == sorted((d, n, h, tuple(f)) for d, t in rows for n, h, f in [brute_hits(t, items)])
    clean = {g.doc_id: g for g in engine.apply(docs, bench).collect()}
    text_of = dict(rows)
    for d, t in rows:
        n, h, _ = brute_hits(t, items)
        assert (d in clean) == (h <= 0.5 * n)
        if d in clean and not h:
            assert (clean[d].text, clean[d].n_chars) == (text_of[d], 7)
        elif d in clean:
            assert len(re.findall(r"[a-zA-Z0-9é-ü]+", clean[d].text)) <= n - h + 1 and clean[d].n_chars == len(clean[d].text)
    assert engine.apply(stored_docs([]), bench).count() == 0
    assert engine.scan(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_automaton_knows_every_substring():
    a = Automaton([("x", [1, 2, 1, 2, 3]), ("y", [2, 1, 2, 2])], window=3)
    found = set()
    assert a.walk([9 - 9, 2, 1, 2, 2, 7, 1, 2, 3], found) == [(1, 5), (6, 9)] and found == {"x", "y"}


def test_language_profiles(spark, stored_docs):
    r = random.Random(3)
    bag = {"aa": "the of and that house water".split(), "bb": "der und nicht wasser haus sch".split()}
    rows = [(i, " ".join(r.choice(bag[g]) for _ in range(30)), g) for i in range(60) for g in [("aa", "bb")[i % 2]]]
    train = stored_docs([(d, t, g, "x", 0) for d, t, g in rows] + [(99, "the the", None, None, 0), (98, None, "aa", None, 0)])
    engine = RankProfiles(top=60)
    profile = engine.learn(train)
    assert profile.groupBy("lang").count().where("count > 60").count() == 0
    docs = stored_docs([(1, "Der Hund und das Haus", "aa", "bb", 1), (2, None, None, None, None), (3, "12 ?!", None, None, 0), (4, "WATER and house", "bb", None, 0), (4, "WATER and house", "bb", None, 0)])
    got = sorted((g.doc_id, g.lang_pred) for g in engine.predict(docs, profile).collect())
    assert got == [(1, "bb"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa")]
    assert all(0 <= g.score <= 1 for g in engine.predict(docs, profile).collect())
    nothing = engine.learn(train.limit(0))
    assert {g.lang_pred for g in engine.predict(docs, nothing).collect()} == {"und"}


def labelled(n, seed):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad, toxic = r.random() < 0.3, r.random() < 0.3
        w = [r.choice(WORDS) for _ in range(r.randint(20, 80))]
        for _ in range(r.randint(1, 4) if toxic else 0):
            w[r.randrange(len(w))] = r.choice(["vilething", "vileword", "awful"])
        t = " ".join(w)
        rows.append((i, t.upper() + "!!" if bad else t, None, "s", 0))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_quality_classifier(spark, stored_docs):
    rows, labels = labelled(400, 5)
    table = spark.createDataFrame(labels + [(5000, 1, 1), (None, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    docs = stored_docs(rows + [(700, None, None, None, 0), (701, "", None, None, 0), (702, "x" * 300_000, None, None, 0)])
    engine = NbSvm(bits=12, train_rows=150)
    model = engine.fit(docs, table.where("doc_id % 2 = 0"), "quality")
    out = engine.predict(docs.withColumnRenamed("lang", "score"), model)  # a clashing name is replaced
    assert out.columns == ["doc_id", "text", "source", "n_chars", "score", "predicted"]
    got = {g.doc_id: g for g in out.collect()}
    right = [got[d].predicted == q for d, q, _ in labels if d % 2]
    assert np.mean(right) > 0.97 and len(got) == 403 and all(0 <= g.score <= 1 for g in got.values())
    one = engine.fit(docs, table.where("quality = 1"), "quality")
    assert {g.predicted for g in engine.predict(docs, one).collect()} == {1}
    assert engine.predict(stored_docs([]), engine.fit(docs, table.limit(0), "quality")).count() == 0


def test_toxicity_orders_grades(spark, stored_docs):
    rows, labels = labelled(600, 6)
    docs = stored_docs(rows + [(700, None, None, None, 0), (701, "", None, None, 0)])
    table = spark.createDataFrame([(d, t) for d, _, t in labels] + [(1, None)], "doc_id long, toxic int")
    engine = OrdinalToxicity()
    model = engine.fit(docs, table.where("doc_id % 2 = 0"))
    assert (np.diff(model.thresholds) > 0).all()
    got = {g.doc_id: g for g in engine.predict(docs, model).collect()}
    assert np.mean([got[d].toxic == bool(t) for d, _, t in labels if d % 2]) > 0.97
    assert not got[700].toxic and not got[701].toxic and got[700].severity < 0.5
    # graded labels: severity follows how many words of the graded kind there are
    graded = [(i, " ".join(["plain"] * 20 + ["nasty"] * k + [WORDS[i % 50]])) for i, k in enumerate([0, 0, 1, 3, 9] * 60)]
    fine = stored_docs([(d, t, None, None, 0) for d, t in graded])
    marks = spark.createDataFrame([(d, [0, 0, 1, 2, 3][d % 5]) for d, _ in graded], "doc_id long, toxic int")
    m = engine.fit(fine, marks)
    by = {d % 5: engine_severity for d, engine_severity in ((g.doc_id, g.severity) for g in engine.predict(fine, m).collect())}
    assert by[0] < by[2] < by[3] < by[4]
    assert engine.predict(stored_docs([]), m).count() == 0
    assert not engine.predict(docs, engine.fit(docs, table.limit(0))).where("toxic").count()


def test_toxicity_keeps_every_word_that_stands_out(spark, stored_docs):
    """More features than 300, and words that always stand together in the training texts, each found alone."""
    r = random.Random(3)
    bad = [f"{r.getrandbits(40):010x}" for _ in range(400)]
    plain = lambda: [r.choice(WORDS) for _ in range(30)]
    # words 2k and 2k + 1 stand in the same 4 toxic texts; 800 toxic texts in all
    train = [(i, " ".join([*plain(), *(bad[2 * (i % 200)], bad[2 * (i % 200) + 1])]), 1) for i in range(800)]
    train += [(i, " ".join(plain()), 0) for i in range(800, 2400)]
    test = [(5000 + k, " ".join([*plain(), w])) for k, w in enumerate(bad)] + [(6000 + k, " ".join(plain())) for k in range(100)]
    docs = stored_docs([(d, t, None, None, 0) for d, t, _ in train] + [(d, t, None, None, 0) for d, t in test])
    table = spark.createDataFrame([(d, y) for d, _, y in train], "doc_id long, toxic int")
    engine = OrdinalToxicity(train_rows=3000, chi_square=7.0)
    got = {g.doc_id: g.toxic for g in engine.predict(docs, engine.fit(docs, table), 0.7).where("doc_id >= 5000").collect()}
    assert sum(got[5000 + k] for k in range(400)) == 400
    assert sum(got[6000 + k] for k in range(100)) <= 5


@pytest.mark.parametrize("make", [lambda d: jaccard_groups(d), lambda d: bpe.digests(d, tokenizer_file())])
def test_other_id_types(spark, stored_docs, make):
    docs = stored_docs([("a", "x y z"), ("b", "x y z"), (None, None)], "doc_id string, text string")
    assert make(docs).count() == 3
