"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, and put together by array functions: adjacent turns of one
role share a block.  The format is

    <|turn|>role<|text|>text<|and|>text<|end|><|turn|>role ...

``<|and|>`` parts merged turns.  In texts and roles every opening sign of a control string, of this template or of
other known ones, gets a backslash behind it (``<|`` becomes ``<\\|``, ``[INST]`` becomes ``[\\INST]``, ``<\\|``
becomes ``<\\\\|``), so control strings never come from a text and unescaping gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What makes an opening sign part of a control string (fixed values: signs of common chat templates).
TAIL = r"(\||/?s>|/?INST\]|/?SYS>)"
TURN, TEXT, AND, END = "<|turn|>", "<|text|>", "<|and|>", "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)(?=" + TAIL + ")", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)(?=" + TAIL + ")", "$1$2")


def _sorted_turns(turns: DataFrame) -> DataFrame:
    part = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("turns"))


def _running(length: Column) -> Column:
    """Sum of ``length`` over the rows of a conversation before a row; rows come numbered by ``pos``."""
    w = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(length).over(w), F.lit(0)).cast("int")


def format_chats(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) to (conv_id, formatted, loss), a row per conversation.

    A null text or role is empty.  Turns go by turn, then role, then text; repeated rows stay.  A null conv_id is a
    conversation of its own; extra columns are not read.  loss: (first, length) in code points of ``formatted``, the
    escaped texts of assistant turns.  Time is linear in a conversation's turns: places come from a running sum over its
    parts, which stay in the task that collected them."""
    before = lambda i: F.get("turns", i - 1)["role"]
    head = lambda t, i: F.when(before(i) == t["role"], F.lit(AND)).otherwise(
        F.concat(F.when(i == 0, "").otherwise(END), F.lit(TURN), escape(t["role"]), F.lit(TEXT)))
    parts = F.transform("turns", lambda t, i: F.struct(head(t, i).alias("head"), escape(t["text"]).alias("body"),
                                                       (t["role"] == "assistant").alias("learn")))
    rows = _sorted_turns(turns).select("conv_id", F.posexplode(parts).alias("pos", "part"))
    head, body = F.length("part.head"), F.length("part.body")
    rows = rows.withColumn("first", _running(head + body) + head)
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "part", "first"))).alias("p"))
    loss = F.transform(F.filter("p", lambda x: x["part"]["learn"]), lambda x: F.struct(x["first"].alias("first"), F.length(x["part"]["body"]).alias("length")))
    text = F.array_join(F.transform("p", lambda x: F.concat(x["part"]["head"], x["part"]["body"])), "")
    return whole.select("conv_id", F.concat(text, F.lit(END)).alias("formatted"), loss.alias("loss"))


def read_chats(chats: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns: array of (role, text), loss_text) read back from what format_chats() wrote, a row for each
    conv_id.  A part of the formatted text is under the mask where a span of ``loss`` has its place and length."""
    quoted = lambda mark: mark.replace("|", r"\|")
    blocks = F.transform(F.split("formatted", quoted(TURN), -1), lambda b: F.struct(
        F.substring_index(b, TEXT, 1).alias("role"),
        F.split(F.substring_index(F.element_at(F.split(b, quoted(TEXT), -1), -1), END, 1), quoted(AND), -1).alias("texts")))
    # what stands before the first mark is no turn; a block's first text follows its head, the others a sign of their own
    parts = F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), lambda b: F.transform(b["texts"], lambda t, i: F.struct(
        b["role"].alias("role"), t.alias("text"), F.when(i == 0, F.length(b["role"]) + len(TURN) + len(TEXT)).otherwise(len(AND)).alias("before"),
        F.when(i == F.size(b["texts"]) - 1, len(END)).otherwise(0).alias("behind")))))
    rows = chats.select("conv_id", F.posexplode(parts).alias("pos", "part"))
    size = F.col("part.before") + F.length("part.text") + F.col("part.behind")
    rows = rows.withColumn("first", _running(size) + F.col("part.before"))
    spans = chats.select(F.col("conv_id").alias("_id"), F.inline("loss")).withColumnsRenamed({"first": "_first", "length": "_length"})
    rows = rows.join(spans, F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("first") == F.col("_first")) & (F.length("part.text") == F.col("_length")), "left")
    whole = rows.groupBy(F.col("conv_id").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("pos", "part", F.col("_first").isNotNull().alias("learn")))).alias("p"))
    turns = F.transform("p", lambda x: F.struct(unescape(x["part"]["role"]).alias("role"), unescape(x["part"]["text"]).alias("text")))
    loss = F.array_join(F.transform(F.filter("p", lambda x: x["learn"]), lambda x: unescape(x["part"]["text"])), "")
    whole = whole.select("_id", turns.alias("turns"), loss.alias("loss_text"))
    return chats.join(whole, F.col("conv_id").eqNullSafe(F.col("_id"))).select("conv_id", "formatted", "turns", "loss_text")
