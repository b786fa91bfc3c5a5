"""Merkle manifest, two-tier byte BPE and conversation repair against brute force, with odd input."""

import base64
import functools
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from finlens.llm import byte_bpe, turns
from finlens.llm.merkle import digest, folded, merkle_proofs, proof_digest
from finlens.llm.queries import QUERIES, damaged, tokenizer_file

RANKS, PATTERN = tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def item(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def merkle_brute(rows):
    """rows (doc_id, text, lang, source, n_chars) to (doc_id, leaf, subroot, root, proof digest)."""
    by = {}
    for i, text, lang, source, n in rows:
        by.setdefault(source, []).append((i is not None, i or 0, item(i, source, lang, n, text), i))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for p, (_, _, leaf, i) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            proof = ""
            for tree, at in ((trees[k], p), (top, k)):
                for level in tree[:-1]:
                    run = at // 3 * 3
                    proof += "".join(h for j, h in enumerate(level[run : run + 3], run) if j != at)
                    at //= 3
            out.append((i, leaf, trees[k][-1][0], top[-1][0], sha(proof)))
    return out


def merkle(docs):
    leaves = docs.select("*", digest("doc_id", "source", "lang", "n_chars", "text").alias("leaf"))
    return merkle_proofs(leaves).withColumn("again", folded(F.col("leaf")))


@pytest.mark.parametrize("case", ["mixed", "one source", "lone leaves", "one row", "deep"])
def test_merkle_against_brute_force(stored_docs, case):
    r = random.Random(case)
    sources = {"mixed": ["b", "a", None, "é", "", "a b"], "one source": ["s"], "lone leaves": [f"s{i}" for i in range(40)], "one row": ["s"], "deep": ["big"] * 9 + ["x", "y"]}[case]
    n = {"one row": 1, "deep": 7000, "lone leaves": 40}.get(case, 300)
    rows = [(i, r.choice([None, "", "é\nx", "word " * r.randrange(9)]), r.choice([None, "en"]), sources[i] if case == "lone leaves" else r.choice(sources), r.choice([None, i])) for i in range(n)]
    if case == "mixed":
        rows += [(None, "a", "en", "a", 1), (None, "b", "en", "a", 1), rows[5], rows[5], (3, "another text", None, "a", None), (-4, "x" * 300000, None, None, None)]
    out = merkle(stored_docs(rows)).select("doc_id", "leaf", "subroot", "root", proof_digest().alias("p"), "again").collect()
    assert sorted(map(str, [tuple(x)[:5] for x in out])) == sorted(map(str, merkle_brute(rows)))
    assert all(x.again == x.root for x in out)


def test_merkle_odd_tables(spark, stored_docs):
    assert merkle(stored_docs([])).count() == 0
    clash = spark.createDataFrame([(1, "s", "f" * 64, "mine", 7, "x"), (2, "s", "e" * 64, None, 8, "y")], "doc_id long, source string, leaf string, root string, s int, kids string")
    rows = merkle_proofs(clash).orderBy("doc_id").collect()
    assert [x.s for x in rows] == [7, 8] and rows[0].root == sha("f" * 64 + "e" * 64) == rows[1].subroot and rows[0].kids == "x"


def test_merkle_tampering_shows(spark, tmp_path):
    rows = [(i, "one\ntwo" if i % 3 else "plain", "en", f"s{i % 2}", 7) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    out = {x.doc_id: x for x in QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()}
    for i, text, *_ in rows:
        assert out[i].verified == ("\n" not in text or zlib.crc32(str(i).encode()) % 2 != 0)
        assert out[i].verified == (out[i].folded_root == out[i].root)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.read_vocabulary(RANKS, PATTERN)


def texts_of_all_kinds():
    r = random.Random(3)
    sign = lambda: chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x3000), r.choice([32, 10, 9, 0x3000, 0xA0, 0x85, 39]), r.randrange(0x1F300, 0x1F700)]))
    out = ["".join(sign() for _ in range(r.randrange(40))) for _ in range(500)]
    out += ["", " ", "\n\n a ", "it's I'LL 'd''s", "a" * 9000, "x" * 20000 + " y", "日本語" * 3000, " " * 9000, "<|endoftext|>", "\x00\x7f", "½ ² ٣٤ 123"]
    return out + ["".join(r.choice("ab1 '\n") for _ in range(600_000)), "".join(r.choice("ab ") for _ in range(50)) * 8000]


def test_byte_bpe_equals_the_library(vocabulary, library):
    texts = texts_of_all_kinds()
    got = byte_bpe.Encoder(vocabulary).encode([*texts, None])
    assert [g.tolist() for g in got] == [library.encode_ordinary(t) for t in texts] + [[]]


def test_byte_bpe_cuts_every_character_as_the_library(vocabulary, library):
    text = "".join(f"a{chr(c)}1{chr(c)} " for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    assert byte_bpe.Encoder(vocabulary).encode([text])[0].tolist() == library.encode_ordinary(text)


def test_perfect_hash_is_minimal_and_perfect(vocabulary):
    for n in (1, 2, 3, 1000):
        h = np.unique(np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64))
        assert sorted(byte_bpe.perfect_hash(h).place(h).tolist()) == list(range(len(h)))
    assert vocabulary.table.size == len(vocabulary.pieces) == len(set(vocabulary.pieces))
    with pytest.raises(ValueError):
        byte_bpe.perfect_hash(np.array([5, 5], np.uint64))


def test_merges_take_the_least_rank_first(library):
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"ab": 301, b"aa": 302, b"aaa": 303}
    assert byte_bpe.merges(b"abc", ranks) == [97, 300] and byte_bpe.merges(b"aaaaa", ranks) == [302, 303]
    word = b"\xff" + b"ab" * 40000
    assert b"".join(library.decode_single_token_bytes(i) for i in byte_bpe.merges(word, library._mergeable_ranks)) == word


def test_byte_bpe_in_spark(stored_docs, library):
    texts = texts_of_all_kinds()
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, None, "x", "y", 1), (7, texts[7], None, None, None), (7, texts[7], None, None, None)]
    both = byte_bpe.decode(byte_bpe.encode(stored_docs(rows), RANKS, PATTERN), RANKS, PATTERN)
    got = sorted(((x.doc_id, x.ids, bytes(x.bytes)) for x in both.collect()), key=str)
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows), key=str)
    assert got == want
    assert byte_bpe.encode(stored_docs([]), RANKS, PATTERN).count() == 0


SPACE = " \t\n\x0b\x0c\r"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def cheapest(rows, faults):
    """Least (cost, audit, repaired rows), by trying every edit in every state."""
    @functools.cache
    def go(i, state, fresh):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            c, a, rest = go(i + 1, state, 0)
            found.append((c + 2, "D" + a, rest))
            for edit, new, fee in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                to = AFTER.get((state, new[:1]))
                if to and fault not in ("blank", "duplicate"):
                    c, a, rest = go(i + 1, to, 0)
                    found.append((c + fee + 5 * (fault == "truncated"), edit + a, ((new, text), *rest)))
        for new in ("user", "assistant"):
            to = AFTER.get((state, new[0]))
            if to and fresh < 3:
                c, a, rest = go(i, to, fresh + 1)
                found.append((c + 5, "I" + a, ((new, ""), *rest)))
        return min(found, default=(10**9, "", ()))
    return go(0, "", 0)


def repair_brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda q: (q[0] is not None, q[0] or 0, q[1].encode(), hashlib.sha256(q[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in own:
            body = text.strip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit, left = cheapest([q[1:] for q in own], faults)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        out[conv] = (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{a}:{b}" for a, b in left)), left)
    return out


def test_search_finds_the_cheapest_least_audit():
    r, roles = random.Random(11), {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    for k in range(1500):
        codes = "".join(r.choice("suaoSUAOx" if k % 3 else "uasU") for _ in range(r.randrange(0, 10)))
        want = cheapest([(roles[c.lower()], "t") for c in codes], ["blank" if c == "x" else "truncated" if c.isupper() else None for c in codes])
        cost, audit, end = turns.search(codes, turns.START, [e[0] for e in turns.END])
        assert (cost, audit + turns.END[end][1]) == want[:2], codes


@pytest.mark.parametrize("segment", [2, 5, turns.SEGMENT])
def test_repair_against_brute_force_over_segments(spark, segment):
    r = random.Random(segment)
    text = lambda: r.choice(["", " ", "yes.", "no", "why?\n", "Same.", "same", "a. b", " ", None])
    rows = [(c, r.choice([None, t, t, t]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sys", "a"]), text() if c % 2 else f"{t}!")
            for c in range(40) for t in range(r.randrange(1, 14))]
    rows += [(None, 1, "user", "hi."), (None, 2, "assistant", "yo."), (None, 2, "assistant", "yo.")] + [rows[3]] * 2
    given = spark.createDataFrame([(*x, 5, "k") for x in rows], "conv_id long, turn long, role string, text string, place int, state string").repartition(4)
    fixed, summary = turns.repair(given, segment=segment)
    want = repair_brute(rows)
    got = {x.conv_id: (x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, x.repaired_sha256) for x in summary.collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    left = {}
    for x in sorted(fixed.collect(), key=lambda x: x.place):
        left.setdefault(x.conv_id, []).append((x.role, x.text))
    assert left == {c: list(w[-1]) for c, w in want.items() if w[-1]}


def test_repair_of_long_conversations_and_no_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    fixed, summary = turns.repair(spark.createDataFrame([], schema))
    assert fixed.count() == summary.count() == 0
    n = 30000
    long = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("turn "), "id", F.when(F.col("id") % 1000 == 17, "").otherwise(".")).alias("text"))
    x = turns.repair(long)[1].first()
    assert x.truncated == n // 1000 and x.cost == 4 * x.truncated and len(x.audit) == n and x.audit.count("D") == 2 * x.truncated
    big = turns.repair(spark.createDataFrame([(1, 1, "user", "x" * 3_000_000 + "?"), (1, 2, "assistant", "ok.")], schema))[1].first()
    assert big.audit == "KK" and big.cost == 0


def test_damage_and_every_conversation_is_kept(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for c in range(120) for t in range(1 + c % 4)] + [(500, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    kinds = lambda x: zlib.crc32(f"{x[0]}:{' ' if x[1] is None else x[1]}".encode()) % 20
    hurt = damaged(spark.read.parquet(str(tmp_path / "conversations.parquet"))).collect()
    assert len(hurt) == sum({0: 0, 3: 2}.get(kinds(x), 1) for x in rows)
    out = {x.conv_id: x for x in QUERIES["op13_conversation_repair"](spark, str(tmp_path)).collect()}
    assert out.keys() == {x[0] for x in rows}
    gone = [c for c in out if not any(x.conv_id == c for x in hurt)]
    assert gone and all(tuple(out[c])[1:] == (0, 0, 0, 0, 0, 0, "", sha("")) for c in gone)
    want = repair_brute([tuple(x) for x in hurt])
    assert all((out[c].cost, out[c].audit, out[c].repaired_sha256) == want[c][4:7] for c in want)
