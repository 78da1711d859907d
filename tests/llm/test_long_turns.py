from __future__ import annotations

from pyspark.sql import functions as F

from editloom.llm import queries

from . import brute


def test_op5_keeps_turns_of_over_twenty_million_characters(spark, tmp_path):
    n = 20_100_000
    short = spark.createDataFrame([(1, 0, "user", "hi"), (1, 2, "assistant", "b")], "conv_id long, turn int, role string, text string")
    long = spark.range(1).select(F.lit(1).cast("long").alias("conv_id"), F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("a"), n).alias("text"))
    short.union(long).write.parquet(f"file://{tmp_path}/conversations.parquet")
    r = {r["conv_id"]: r for r in queries.op5_chat_format(spark, f"file://{tmp_path}").collect()}[1]
    loss = "a" * n + "b"
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (3, len(loss), brute.sha(loss))
    assert r["turns_sha256"] == brute.sha(f"user\nhi\nassistant\n{loss[:-1]}\nassistant\nb\n")
