"""The pipeline on a small corpus: every stage's decision against a brute-force version of it."""

import random

from corpus_pipeline import STAGES, run

from finlens.llm.queries import ORACLE, QUERIES

WORDS = [f"w{i}" for i in range(500)]


def test_stages_on_a_small_corpus(spark, tmp_path):
    r = random.Random(12)
    say = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
    item = " ".join(f"item{i}" for i in range(12))
    docs, labels = [], []
    for i in range(400):
        text, kind = say(60), i % 8
        if kind == 0:
            text = " ".join("vilething" if k % 20 == 5 else w for k, w in enumerate(text.split()))
        elif kind == 1:
            text = text.upper().replace(" ", "!! ")
        elif kind == 2:
            text += " " + item + " " + say(3)
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(kind != 1), int(kind == 0)))
    docs += [(1000 + i, docs[3][1], "en", "s", 0) for i in range(5)] + [(2000, None, None, None, None), (2001, item, "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d, now, seen = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in STAGES:
        out = stage(spark, now, d)
        assert name == STAGES[-1][0] or out.dtypes == now.dtypes
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen[name] = {x.doc_id: x for x in now.collect()}
    ids = lambda k: {i for i in range(400) if i % 8 in k}
    assert not ids({0}) & seen["toxicity"].keys() and ids({1, 2, 3, 4, 5, 6, 7}) <= seen["toxicity"].keys()
    assert not ids({1}) & seen["quality"].keys() and ids({2, 3, 4, 5, 6, 7}) <= seen["quality"].keys()
    assert 3 in seen["ngram_jaccard_join"] and not {1000 + i for i in range(5)} & seen["ngram_jaccard_join"].keys()
    assert ids({2, 3, 4, 5, 6, 7}) <= seen["ngram_jaccard_join"].keys()
    assert 2001 not in seen["decontamination"]
    for i in ids({2}):
        assert "item3" not in seen["decontamination"][i].text and seen["decontamination"][i].n_chars == len(seen["decontamination"][i].text)
    assert seen["bpe"].keys() == seen["decontamination"].keys() and all(x.n_tokens > 0 for k, x in seen["bpe"].items() if k != 2000)
    assert {tuple(x) for x in run(spark, d).collect()} == {tuple(x) for x in seen["bpe"].values()}


def test_all_operators_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
