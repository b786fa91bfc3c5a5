"""Chat, vectors, pages and archives: brute force, round trips, and odd input."""

import base64
import gzip
import hashlib
import os
import random

import numpy as np

from finlens.llm.chat import format_chats, read_chats
from finlens.llm.components import components
from finlens.llm.html_text import blocks, default_field, extract, labelled_pages, main_text
from finlens.llm.vectors import VectorLinks
from finlens.llm.warc import read_archives, write_archives


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>", "<\\|end|>", "<|and|>", "a\\", "<", "[", "", None, "é\n", "<\\\\|x [\\INST]", "<<SYS>>", "<|end|>", "\\<|"]
    r = random.Random(1)
    rows = [(c, t, r.choice(["user", "assistant", "system", "<|odd", None]), r.choice(nasty) if r.random() < 0.8 else (r.choice(nasty) or "") + (r.choice(nasty) or ""))
            for c in range(60) for t in range(r.randint(1, 7))] + [(None, 0, "user", "x"), (61, None, None, None), (62, 1, "user", "same"), (62, 1, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    made = format_chats(df)
    got = {g.conv_id: g for g in read_chats(made).collect()}
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append((t if t is not None else -1, role or "", text or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns = sorted(turns)
        assert [(x.role, x.text) for x in got[c].turns] == [x[1:] for x in turns]
        assert got[c].loss_text == "".join(x[2] for x in turns if x[1] == "assistant")
    merged = format_chats(spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")).first()
    assert merged.formatted == "<|turn|>user<|text|>a<|and|>b<|end|><|turn|>assistant<|text|>c<|end|>"
    assert format_chats(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(0)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 260)] + [(None, 3), (5, 5)]
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        if a is not None and root(a) != root(b):
            up[max(root(a), root(b))] = min(root(a), root(b))
    nodes = {x for a, b in links if a is not None and a != b for x in (a, b)}
    got = {g.node: g.component for g in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in nodes}


def test_vector_links_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 16))
    x[300:] = x[rng.integers(0, 40, 200)] + 0.15 * rng.normal(size=(200, 16))
    x[480:] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [float("inf")] * 16),
           (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, (x[7] * 1e200).tolist()), (None, x[9].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 AS n_links", "2 AS unit")
    got = {g.vec_id: g for g in VectorLinks(lists=12, probes=4, block=64).links(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = (u @ u.T >= 0.9) & ~np.eye(500, dtype=bool)
    want = true.sum(1)
    for k in (7, 9):  # 908 and the row without id are copies of these
        want[true[k]] += 1
        want[k] += 1
    found = np.array([got[i].n_links for i in range(500)])
    assert found.sum() >= 0.9 * want.sum() and (found <= want).all()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(900, 906))
    assert got[907].component_id == 906 and not got[907].kept and got[908].component_id == got[7].component_id
    assert len(got) == 510 and VectorLinks().links(df.limit(0)).count() == 0


def test_html_extraction(spark):
    page = ("<html><head><title>No</title></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
            "<div class='cookie-banner'>We use cookies. <button>Fine</button></div>"
            "<article><h1>A &amp; B</h1><p><b>First  part\n of it.<br><p>Second &lt;one&gt;, caf&eacute;.<script>var a = '</p>';</script>"
            "<div class=ad>Buy now!</div><p>Third, with <a href=/x>a link</a> inside.</p></article>"
            "<aside class=sidebar><h3>Related</h3><ul><li><a href=/r>More</a></ul></aside>"
            "<section class=comments><p>I do not agree with this at all, said a reader.</p></section><footer>&copy; x</footer>")
    want = "A & B\nFirst part of it.\nSecond <one>, café.\nThird, with a link inside."
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (3, "v", ""), (1, "u", page), (4, "w", "<p"), (5, "x", "<" * 5000)], "page_id long, url string, html string")
    got = extract(df.selectExpr("*", "'t' AS text")).collect()
    assert [g.text for g in got if g.page_id == 1] == [want, want]
    assert {g.page_id: g.text for g in got if g.page_id in (2, 3)} == {2: "", 3: ""} and len(got) == 6
    assert extract(df.limit(0)).count() == 0
    assert [b[0] for b in blocks("<ul><li>a<li>b</ul>c<!-- d --><style>p{}</style><td>e")] == ["a", "b", "c", "e"]
    field, fresh = default_field(), labelled_pages(120, seed=77)
    right = [a == b[3] for p in fresh for a, b in zip(field.label([x[:3] for x in p]), p, strict=True)]
    assert np.mean(right) > 0.97
    assert main_text("plain", field) in ("", "plain")


def test_warc_round_trip(spark, tmp_path):
    r = random.Random(4)
    bodies = ["<p>é</p>", "", None, "x" * 50_000, "<a>\r\n\r\nb"] + [str(r.random()) for _ in range(20)]
    rows = [(i, r.choice(["http://a/é b\n", None, ""]), r.choice(bodies)) for i in range(300)] + [(7000, "u", "twice")] * 2 + [(None, "n", "<p>é</p>"), (None, "n", "only here")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS keep")
    folder = str(tmp_path / "warc")
    manifest = write_archives(pages, folder, shards=3, roll_bytes=4000)
    names = [m.file for m in manifest.collect()]
    assert len(names) > 3 and sum(m.records for m in manifest.collect()) == len(rows)
    assert sorted(names) == sorted(f for f in os.listdir(folder) if not f.startswith("."))
    assert gzip.open(os.path.join(folder, names[0])).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    got = read_archives(manifest, folder, payloads=True).collect()
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", -1), i)
    text_of = {i: h or "" for i, _, h in rows}
    assert len(got) == len(rows)
    for g in got:
        if g.page_id is None:
            assert (g.record_type, g.refers_to) in (("revisit", last["<p>é</p>"]), ("response", None))
            continue
        t = text_of[g.page_id]
        assert g.payload_bytes == len(t.encode()) and g.payload_digest == base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
        if g.page_id != 7000:
            assert (g.record_type, g.refers_to) == (("response", None) if last[t] == g.page_id else ("revisit", last[t]))
        assert g.record_type == "revisit" or bytes(g.payload) == t.encode()
    assert sorted(g.record_type for g in got if g.page_id == 7000) == ["response", "revisit"]
    # the same pages give the same bytes
    again = write_archives(pages, folder + "2", shards=3, roll_bytes=4000)
    read = lambda d, m: sorted((x.shard, x.file.rsplit("-", 1)[0], open(os.path.join(d, x.file), "rb").read()) for x in m.collect())
    assert read(folder, manifest) == read(folder + "2", again)
    empty = write_archives(pages.limit(0), folder + "3", shards=2)
    assert read_archives(empty, folder + "3").count() == 0


def test_vector_links_of_a_dense_group_over_many_lists(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    x[:1000] = x[0] + 0.3 * rng.normal(size=(1000, 24))  # near, not equal: about a third of the lists stand in the group
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    true = (x @ x.T >= 0.9) & ~np.eye(3000, dtype=bool)
    assert true.sum() > 200_000
    for block in (8192, 40):  # 40: lists over a tile's size
        got = {g.vec_id: g for g in VectorLinks(lists=330, block=block).links(df).collect()}
        assert [got[i].n_links for i in range(3000)] == true.sum(1).tolist()
        linked = np.flatnonzero(true[:1000, :1000].any(1))
        assert {got[i].component_id for i in linked.tolist()} == {int(linked[0])}
