"""Queries of this package's operators over their whole tables, with production parameters, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlens.llm import bpe, byte_bpe
from finlens.llm.chat import format_chats, read_chats
from finlens.llm.classify import remainder
from finlens.llm.decontaminate import Decontaminator
from finlens.llm.html_text import extract
from finlens.llm.kit import scratch
from finlens.llm.langid import RankProfiles
from finlens.llm.merkle import digest, folded, merkle_proofs, proof_digest
from finlens.llm.ngram_join import jaccard_groups
from finlens.llm.quality import NbSvm
from finlens.llm.toxicity import OrdinalToxicity
from finlens.llm.turns import join_on_id, repair
from finlens.llm.vectors import VectorLinks
from finlens.llm.warc import read_archives, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary files are; the folder can be named in FINLENS_TOKENIZERS."""
    folder = os.environ.get("FINLENS_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@register("op1_ngram_jaccard_join", f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), {ASCII_LOWER}), '[\\x20\\x09-\\x0D]+'),
                             lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
      WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS root, doc_id AS node FROM documents UNION SELECT r.root, e.y FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) m ON m.node = d.doc_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), width=5, num=80, den=100)


@register("op5_bpe_encode_decode")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), tokenizer_file())


WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {ASCII_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# One more conversation, whose texts hold control strings (fixed by the query's contract).
CONTROL_TEXT = "</s>[INST] ok [/INST]"


@register("op2_chat_formatting", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}')),
e AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS prev,
         length(regexp_replace(text, '([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>)', '\\1\\\\\\2\\3', 'g')) AS body,
         length(regexp_replace(role, '([<\\[])(\\\\*)(\\||/?s>|/?INST\\]|/?SYS>)', '\\1\\\\\\2\\3', 'g')) AS name
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
       CAST(sum(body + CASE WHEN prev = role THEN 7 WHEN k = 1 THEN 16 + name ELSE 23 + name END) + 7 AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{CONTROL_TEXT}'), (-7L, 1L, 'assistant', '{CONTROL_TEXT}') AS t(conv_id, turn, role, text)")
    read = read_chats(format_chats(rows.union(own)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


@register("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    engine = RankProfiles()
    profiles = engine.learn(docs.where(~held_out))
    return engine.predict(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op6_benchmark_decontamination", f"""
WITH iw AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, unnest(CASE
      WHEN len(w) >= 10 THEN list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i+9], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM iw),
dw AS (SELECT doc_id, {WORDS} AS w FROM documents),
lens AS (SELECT DISTINCT l FROM win),
dg AS (
  SELECT doc_id, l, i, array_to_string(w[i:i+l-1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM dw, lens WHERE len(w) >= l)),
hit AS (SELECT DISTINCT doc_id, dg.l, i, item_id FROM dg JOIN win ON dg.l = win.l AND dg.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS h
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON pos.doc_id = dw.doc_id LEFT JOIN it ON it.doc_id = dw.doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Decontaminator(window=10).scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    engine = NbSvm()
    model = engine.fit(docs, labels.where(~held_out), "quality")
    return engine.predict(docs, model, 0.3).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    engine = OrdinalToxicity()
    model = engine.fit(docs, labels.where(~held_out), "toxic")
    return engine.predict(docs, model).select("doc_id", held_out.alias("held_out"), "toxicity", "severity", "grade", "toxic")


@register("op4_embedding_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return VectorLinks(cosine=0.9).links(_table(spark, sf_dir, "embeddings"))


@register("op8_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM p)
SELECT page_id, octet_length(encode(t)) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INTEGER), 5) AS BIGINT) >> CAST(5 * (3 - k % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CAST(CASE WHEN page_id = keep THEN NULL ELSE keep END AS BIGINT) AS refers_to
FROM r""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = scratch(spark, "warc")
    manifest = write_archives(pages, folder)
    return read_archives(manifest, folder, id_type=dict(pages.dtypes)["page_id"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


# unsigned crc32 of a string of decimal digits, bit by bit
CRC32 = """xor(4294967295, list_reduce(list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda a, b: list_reduce(CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[]), lambda c, i: xor(c >> 1, (c & 1) * 3988292384), xor(a, b)), CAST(4294967295 AS BIGINT)))"""


def _sized(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


_HEAD = " || ".join(map(_sized, ("doc_id", "source", "lang", "n_chars")))


@register("op11_merkle_manifest", f"""
WITH RECURSIVE h AS (
  SELECT doc_id, source, sha256({_HEAD} || {_sized('text')}) AS leaf,
         sha256({_HEAD} || {_sized("replace(text, chr(10), '')")}) AS cut, {CRC32.format("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS even FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
             dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER () AS r FROM h),
up AS (SELECT s, 0 AS k, list(leaf ORDER BY p) AS l FROM d GROUP BY s
       UNION ALL SELECT s, k + 1, list_transform(range(0, (len(l) + 2) // 3), lambda j: sha256(array_to_string(l[3 * j + 1:3 * j + 3], ''))) FROM up WHERE len(l) > 1),
sub AS (SELECT s, k, l[1] AS subroot FROM up WHERE len(l) = 1),
top AS (SELECT 0 AS k, list(subroot ORDER BY s) AS l FROM sub
        UNION ALL SELECT k + 1, list_transform(range(0, (len(l) + 2) // 3), lambda j: sha256(array_to_string(l[3 * j + 1:3 * j + 3], ''))) FROM top WHERE len(l) > 1),
way AS (SELECT r, k AS n, p // CAST(3 ** k AS BIGINT) AS i, l FROM d JOIN up USING (s) WHERE len(l) > 1
        UNION ALL SELECT r, sub.k + top.k, d.s // CAST(3 ** top.k AS BIGINT), l FROM d JOIN sub USING (s), top WHERE len(l) > 1),
step AS (SELECT r, n, array_to_string(l[i - i % 3 + 1:i], '') AS a, array_to_string(l[i + 2:i - i % 3 + 3], '') AS b FROM way),
fold AS (SELECT r, 0 AS n, CASE WHEN even THEN coalesce(cut, leaf) ELSE leaf END AS x FROM d
         UNION ALL SELECT f.r, f.n + 1, sha256(a || x || b) FROM fold f JOIN step ON step.r = f.r AND step.n = f.n)
SELECT doc_id, leaf, subroot, l[1] AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       folded_root, folded_root = l[1] AS verified
FROM d JOIN sub USING (s) JOIN top ON len(l) = 1 JOIN (SELECT r, arg_max(x, n) AS folded_root FROM fold GROUP BY r) USING (r)
LEFT JOIN (SELECT r, string_agg(a || b, '' ORDER BY n) AS proof FROM step GROUP BY r) USING (r)""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    head = ("doc_id", "source", "lang", "n_chars")
    cut = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    leaves = docs.select("doc_id", "source", digest(*head, "text").alias("leaf"), F.when(cut, digest(*head, F.translate("text", "\n", ""))).alias("tampered"))
    out = merkle_proofs(leaves, by="source", order="doc_id").withColumn("folded_root", folded(F.coalesce("tampered", "leaf")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@register("op12_byte_bpe_two_tier")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    file, pattern = tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = byte_bpe.decode(byte_bpe.encode(_table(spark, sf_dir, "documents"), file, pattern), file, pattern)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by the crc32 of ``conv_id:turn`` modulo 20 (fixed by the query's
    contract); nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0") \
        .withColumn("kind", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("kind")


@register("op13_conversation_repair", f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM c, range(2) r(x) WHERE k <> 0 AND (x = 0 OR k = 3)),
o AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS prev, count(*) OVER (PARTITION BY conv_id) AS n
      FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
f AS (SELECT *, left(role, 1) AS z, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
             WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM o),
t(s, z, fore, nxt) AS (VALUES ('', 's', '', 's'), ('', 'u', '', 'u'), ('', 'a', 'I', 'a'), ('s', 'u', '', 'u'), ('s', 'a', 'I', 'a'),
                       ('u', 'a', '', 'a'), ('u', 'u', 'I', 'u'), ('a', 'u', '', 'u'), ('a', 'a', 'I', 'a')),
e AS (SELECT s, z, 5 * length(fore) AS fee, fore || 'K' AS edit, nxt FROM t UNION ALL SELECT s, '*', 5 * length(fore) + 1, fore || 'R', nxt FROM t WHERE z <> 's'
      UNION ALL SELECT DISTINCT s, '#', 2, 'D', s FROM t),
dp AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS s, {{'cost': CAST(0 AS BIGINT), 'audit': ''}} AS b FROM f
       UNION ALL
       SELECT dp.conv_id, f.i, e.nxt, min({{'cost': CAST(b.cost + fee + CASE WHEN fault = 'truncated' AND e.z <> '#' THEN 5 ELSE 0 END AS BIGINT), 'audit': b.audit || edit}})
       FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
       JOIN e ON e.s = dp.s AND (e.z = '#' OR (fault NOT IN ('blank', 'duplicate') AND e.z IN ('*', f.z))) GROUP BY dp.conv_id, f.i, e.nxt),
fin(s, fee, edit) AS (VALUES ('', 0, ''), ('s', 10, 'II'), ('u', 5, 'I'), ('a', 0, '')),
sums AS (SELECT conv_id, max(n) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (prev IS NOT NULL AND left(prev, 1) || z NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
best AS (SELECT dp.conv_id, min({{'cost': b.cost + fee, 'audit': b.audit || edit}}) AS b
         FROM dp JOIN sums ON sums.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = n JOIN fin USING (s) GROUP BY dp.conv_id),
ch AS (SELECT conv_id, p, b.audit[p] AS edit FROM (SELECT conv_id, b, unnest(range(1, length(b.audit) + 1)) AS p FROM best)),
pos AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS place
        FROM ch WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
put AS (SELECT pos.conv_id, p, edit, place, coalesce(bool_or(place = 1 AND edit = 'K' AND z = 's') OVER (PARTITION BY pos.conv_id), false) AS sys, role, text
        FROM pos LEFT JOIN f ON edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM pos.conv_id AND f.i = pos.i WHERE edit <> 'D'),
txt AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                          || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS h FROM put GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN txt ON txt.conv_id IS NOT DISTINCT FROM a.conv_id""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = damaged(original)
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    out = original.select("conv_id").distinct()
    for part in (gaps, repair(turns)[1]):
        out = join_on_id(out, part)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
