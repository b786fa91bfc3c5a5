"""Conversations of very many turns, and reading back by the mask alone."""

import time

from pyspark.sql import functions as F

from finlens.llm.chat import format_chats, read_chats


def test_turns_cost_linear_time(spark):
    def took(n):
        rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 3 == 1, "assistant").otherwise("user").alias("role"), F.concat(F.lit("text <|turn|> é "), "id").alias("text"))
        t = time.time()
        x = read_chats(format_chats(rows)).select(F.size("turns").alias("n"), F.length("loss_text").alias("chars"),
                                                  F.sha2("loss_text", 256).alias("h"), F.element_at("turns", -1).alias("last")).first()
        took = time.time() - t
        loss = "".join(f"text <|turn|> é {i}" for i in range(n) if i % 3 == 1)
        assert x.n == n and x.chars == len(loss) and tuple(x.last) == ("assistant" if (n - 1) % 3 == 1 else "user", f"text <|turn|> é {n - 1}")
        return took
    took(100)
    assert took(100_000) < 60  # 8000 turns took 31 s before


def test_the_mask_decides_what_is_learned(spark):
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate([("user", "a"), ("assistant", "bc"), ("assistant", ""), ("user", "d"), ("assistant", "<|end|>e")])]
    chats = format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {r.loss_text for r in read_chats(chats).collect()} == {"bc<|end|>e"}
    none = chats.withColumn("loss", F.filter("loss", lambda s: s["length"] > 2))
    assert {r.loss_text for r in read_chats(none).collect()} == {"<|end|>e"}
    spans = [(s.first, s.length) for s in chats.where("conv_id = 1").first().loss]
    text = chats.where("conv_id = 1").first().formatted
    assert [text[a : a + n] for a, n in spans] == ["bc", "", "<\\|end|>e"]
