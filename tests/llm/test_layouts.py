"""Records that differ in what does not matter, and records that no mapping knows."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from editloom.llm import chat, queries

U, A = ("user", "u"), ("assistant", "a")
RECORDS = [
    ('{"messages":[{"role":"user","content":"u","name":"x"},{"role":"assistant","content":"a"}]}', "messages", [U, A]),
    ('{"messages":[{"role":"user","content":5},{"role":"assistant","content":"a"}],"id":7}', "messages", [("user", "5"), A]),
    ('{"messages":[{"role":"user","content":[{"type":"text","text":"u"},{"type":"text","text":"v"}]},{"role":"assistant","content":[{"type":"text","text":"a"}]}]}', "messages of parts", [("user", "uv"), A]),
    ('{"messages":[{"role":"user","content":[{"type":"text","text":"u"}]},{"role":"assistant","content":"a"}]}', "messages", [U, A]),
    ('{"prompt":"u","response":"a","id":"q1"}', "prompt and response", [U, A]),
    ('{"source":"s","prompt":"u","response":"a","score":0.5}', "prompt and response", [U, A]),
    ('{"id":1,"role":"user","content":"u"}', "message row", [U]),
    ('{"conversations":[{"from":"human","value":"u","weight":1},{"from":"gpt","value":"a"}],"model":"m","lang":"en"}', "conversations", [U, A]),
    ('{"system":"s","id":2,"messages":[{"role":"user","content":"u"}]}', "system and messages", [("system", "s"), U]),
    ('{"messages":[{"role":"user","content":"u","tool":{"x":1}}]}', None, []),
    ('{"prompt":"u","response":"a","system":"s"}', None, []),  # a further field that another layout names
    ('{"prompt":"u","response":"a","rejected":"r"}', "prompt and response", [U, A]),
    ('{"role":"user","text":"u","note":"n","a b":1,"x, role":2,"messages<":3}', "turn row", [U]),
    ('{"role":"user","text":"u","tags":["x"]}', None, []),
    ('{"messages":[]}', "no messages", []), ('{"conversations":[],"note":"n"}', "no conversations", []),
    ('{"messages":["u"]}', None, []),
    ('{"messages":[{"role":"user","content":"u"},{"role":"assistant","content":null,"tool_calls":[{"id":"1","type":"function","function":{"name":"f","arguments":"{}"}},{"id":"2","type":"function","function":{"name":"g","arguments":"1"}}]},{"role":"tool","tool_call_id":"1","content":"t"}]}',
     "messages with tool calls", [U, ("assistant", '{"name":"f","arguments":"{}"}\n{"name":"g","arguments":"1"}'), ("tool", "t")]),
    ('{"id":1}', None, []),
    ("[]", None, []), (None, None, []), ("{", None, []),
]


def table(spark):
    return spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(RECORDS)], "c int, record string")


def test_layouts_pass_over_what_does_not_matter(spark):
    got = chat.canonical_turns(table(spark)).orderBy("c").collect()
    assert [(r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in got] == [(name, turns) for _, name, turns in RECORDS]


def test_unknown_records_are_returned_and_counted(spark):
    unknown = {i for i, (_, name, _) in enumerate(RECORDS) if not name}
    found = chat.unknown_records(table(spark)).collect()
    assert {r["c"] for r in found} == unknown and sum(r["fingerprint"] is not None for r in found) == 5
    row = chat.format_chats(table(spark).withColumn("conv", F.lit(1)), "conv", "c").first()
    assert (row["unknown"], row["n_turns"]) == (len(unknown), sum(len(t) for _, _, t in RECORDS))
    assert row["layouts"].split(",") == sorted({name for _, name, _ in RECORDS if name})


def test_fields_left_aside_are_counted(spark):
    got = {r["record"]: r["passed_over"] for r in chat.canonical_turns(table(spark)).collect()}
    some = {r: n for r, n in got.items() if n}
    assert sorted(some.values()) == [1, 1, 1, 4]  # rejected; note; tool_call_id; four odd names beside role and text
    assert chat.format_chats(table(spark).withColumn("conv", F.lit(1)), "conv", "c").first()["passed_over"] == 7


def test_query_agrees_with_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = con.sql(queries.ORACLE_SQL["op5_chat_format"])
    got = queries.op5_chat_format(spark, folder)
    assert set(got.columns) == set(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
