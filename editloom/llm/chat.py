"""Chat formatting: records of many layouts become canonical turns and then one marked text per conversation.

A record is a JSON object. The set of its nested field paths (names only, not the types of scalars, and without scalar
fields that no layout names) is hashed; the hash selects a declarative mapping, an SQL expression that turns the record
into an array of (role, text) turns. Fields left aside are counted, unless they are ids and the like. Records of an unknown layout keep their fingerprint and give no
turns; they are counted in their conversation and returned by unknown_records, so that a mapping can be added.

Template: `<|im_start|>` role `<|im_sep|>` text `<|im_end|>`. Inside roles and texts a backslash is doubled, and a
backslash is put after the first character of each control string, so no control string is left and the escape can
be undone by dropping each backslash and keeping what follows it. Everything is built-in column functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of the common chat templates.
CONTROL_STRINGS = (START, SEP, END, "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>", "<|startoftext|>", "<|eot_id|>",
                   "<|start_header_id|>", "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Scalar fields that say nothing of the turns: left aside without being counted, also where a layout names them.
PASSED_OVER = ("id", "idx", "index", "name", "source", "dataset", "model", "lang", "language", "timestamp", "created", "weight", "score", "category", "conversation_id", "conv_id", "parent_id")
TURNS = "array<struct<role:string,text:string>>"
#: Turns with a role or text of more characters go beside their JSON records: the JSON parser refuses strings of over 20,000,000.
CARRIED_CHARS = 1_000_000


@dataclass(frozen=True)
class Layout:
    """example: a JSON record with all fields of the layout. turns: SQL of array<struct<role,text>> over the variant `v`."""

    name: str
    example: str
    turns: str


def _pair(user: str, assistant: str) -> str:
    return (f"array(named_struct('role','user','text',variant_get(v,'$.{user}','string')),"
            f"named_struct('role','assistant','text',variant_get(v,'$.{assistant}','string')))")


def _listed(path: str, role: str, text: str) -> str:
    """Turns of a list; a text may be a string, a number or a list of parts whose texts follow each other."""
    return (f"transform(variant_get(v,'$.{path}','array<struct<{role}:string,{text}:variant>>'), m -> named_struct('role',"
            f"case lower(m.{role}) when 'human' then 'user' when 'gpt' then 'assistant' when 'bot' then 'assistant' else m.{role} end,"
            f"'text',coalesce(array_join(transform(try_variant_get(m.{text},'$','array<struct<type:string,text:string>>'), p -> coalesce(p.text,'')),''),"
            f"try_variant_get(m.{text},'$','string'))))")


_TOOL_CALLS = (
    "transform(variant_get(v,'$.messages','array<struct<role:string,content:string,tool_calls:array<struct<function:struct<name:string,arguments:string>>>>>'), m -> "
    "named_struct('role',m.role,'text',concat_ws('\n',m.content,transform(m.tool_calls, c -> to_json(c.function)))))")

_INSTRUCTION_INPUT = (
    "array(named_struct('role','user','text',concat(coalesce(variant_get(v,'$.instruction','string'),''),"
    "if(coalesce(variant_get(v,'$.input','string'),'')='','',concat('\\n\\n',variant_get(v,'$.input','string'))))),"
    "named_struct('role','assistant','text',variant_get(v,'$.output','string')))")

LAYOUTS = (
    Layout("turn row", '{"role":"","text":""}', "array(named_struct('role',variant_get(v,'$.role','string'),'text',variant_get(v,'$.text','string')))"),
    Layout("message row", '{"role":"","content":""}', "array(named_struct('role',variant_get(v,'$.role','string'),'text',variant_get(v,'$.content','string')))"),
    Layout("prompt and response", '{"prompt":"","response":""}', _pair("prompt", "response")),
    Layout("prompt and completion", '{"prompt":"","completion":""}', _pair("prompt", "completion")),
    Layout("question and answer", '{"question":"","answer":""}', _pair("question", "answer")),
    Layout("nested prompt", '{"data":{"prompt":"","response":""}}', _pair("data.prompt", "data.response")),
    Layout("instruction", '{"instruction":"","output":""}', _pair("instruction", "output")),
    Layout("instruction with input", '{"instruction":"","input":"","output":""}', _INSTRUCTION_INPUT),
    Layout("messages", '{"messages":[{"role":"","content":""}]}', _listed("messages", "role", "content")),
    Layout("messages of parts", '{"messages":[{"role":"","content":[{"type":"","text":""}]}]}', _listed("messages", "role", "content")),
    Layout("messages with tool calls", '{"messages":[{"role":"","content":"","tool_calls":[{"type":"","function":{"name":"","arguments":""}}]}]}', _TOOL_CALLS),
    Layout("no messages", '{"messages":[]}', "array()"),
    Layout("no conversations", '{"conversations":[]}', "array()"),
    Layout("conversations", '{"conversations":[{"from":"","value":""}]}', _listed("conversations", "from", "value")),
    Layout("system and messages", '{"system":"","messages":[{"role":"","content":""}]}',
           "concat(array(named_struct('role','system','text',variant_get(v,'$.system','string')))," + _listed("messages", "role", "content") + ")"),
)


def _without(paths: Column, fields: str) -> Column:
    return F.regexp_replace(F.regexp_replace(paths, fields, ""), ", >", ">")


def _scalar_fields(names: str) -> str:
    """Pattern of scalar fields in a schema without the types of scalars. What follows ARRAY< is a type, not a field."""
    return rf"(?<=[< ])(?<!ARRAY<){names}(?:, |(?=>))"


def _unnamed(layouts: tuple[Layout, ...]) -> str:
    named = sorted({n for layout in layouts for n in re.findall(r'"(\w+)":', layout.example)})
    return _scalar_fields(rf"(?!(?:{'|'.join(named)})[,>])(?:`(?:[^`]|``)+`|[^\s`:,<>]+)")


def field_paths(variant: Column) -> Column:
    """The schema of a variant without the types of scalars and without the scalar fields of PASSED_OVER.

    A field that is a scalar of one type here and of another there counts as a scalar.
    """
    scalar = r": (STRING|VOID|BIGINT|DOUBLE|BOOLEAN|DECIMAL\([0-9,]*\)|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|FLOAT|VARIANT)(?=[,>])"
    return _without(F.regexp_replace(F.schema_of_variant(variant), scalar, ""), _scalar_fields(f"(?:{'|'.join(PASSED_OVER)})"))


def layout_fingerprint(paths: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of field paths, but those of scalar fields with names that no layout has; null for what is no object."""
    return F.when(paths.startswith("OBJECT<"), F.xxhash64(_without(paths, _unnamed(layouts))))


def escape(text: Column) -> Column:
    literal = "|".join("".join(f"\\{c}" if c in r"\|[]<>/." else c for c in s[1:]) for s in CONTROL_STRINGS if s[0] == "<")
    text = F.regexp_replace(text, F.lit(r"\\"), F.lit(r"\\\\"))
    text = F.regexp_replace(text, F.lit(f"<(?={literal})"), F.lit(r"<\\"))
    return F.regexp_replace(text, F.lit(r"\[(?=/?INST\])"), F.lit(r"[\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"(?s)\\(.)"), F.lit("$1"))


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds fingerprint, layout (name or null), turns (array of role and text) and passed_over to rows with a JSON string `record`.

    Null or broken JSON, arrays and scalars have no layout. A null text becomes empty, a null role the empty string.
    Further scalar fields that no layout names don't make another layout; passed_over is the number of their paths,
    without those of PASSED_OVER, so that a mapping can be added for what should not be left aside. Further fields that
    some layout names, or that hold objects or lists, make another layout. Empty lists of messages give no turns. Calls
    of tools follow a message's text, each as a line of JSON with name and arguments.
    """
    df = records.withColumn("_v", F.try_parse_json(record)).withColumn("_paths", field_paths(F.col("_v")))
    df = df.withColumn("fingerprint", layout_fingerprint(F.col("_paths"), layouts))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        known = F.col("fingerprint") == layout_fingerprint(field_paths(F.parse_json(F.lit(layout.example))), layouts)
        name = F.when(known, F.lit(layout.name)).otherwise(name)
        turns = F.when(known, F.expr(layout.turns.replace("(v,", "(`_v`,")).cast(TURNS)).otherwise(turns)
    df = df.withColumn("layout", name).withColumn("turns", turns)
    clean = F.transform("turns", lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    df = df.withColumn("turns", F.coalesce(clean, F.array().cast(TURNS)))
    aside = F.when(F.col("layout").isNotNull(), F.regexp_count("_paths", F.lit(_unnamed(layouts))))
    return df.withColumn("passed_over", F.coalesce(aside, F.lit(0))).drop("_v", "_paths")


def unknown_records(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The rows of records without a layout, with their fingerprint (null for what is no object)."""
    return canonical_turns(records, record, layouts).where("layout IS NULL").drop("layout", "turns", "passed_over")


def format_chats(records: DataFrame, conversation: str, seq: str, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS,
                 trained_role: str = "assistant", carried: str | None = None) -> DataFrame:
    """One row per conversation: formatted text, n_turns, loss_spans, layouts (names, with commas), unknown (records without a layout)
    and passed_over (fields left aside in the others).

    `carried` names a column with the whole turn (role, text) of records that hold only its beginning, and null for others.

    Records of a conversation follow each other by `seq`, ties by the record's text. loss_spans are (start, length) in
    bytes of the UTF-8 of `formatted` and cover the escaped text of each turn of `trained_role`, in order. A
    conversation whose records have no turns gives an empty text. Null conversation ids are one conversation.
    """
    turns = canonical_turns(records, record, layouts)
    whole = F.lit(None).cast("struct<role:string,text:string>")
    if carried:
        whole = F.col(carried)
        filled = F.struct(F.coalesce(whole["role"], F.lit("")).alias("role"), F.coalesce(whole["text"], F.lit("")).alias("text"))
        turns = turns.withColumn("turns", F.when(whole.isNotNull(), F.array(filled)).otherwise(F.col("turns")))
    rows = turns.select(F.col(conversation).alias("conversation"), F.col(seq).alias("seq"), F.col(record).alias("record"), whole.alias("whole"), "layout", "passed_over",
                        F.posexplode_outer("turns").alias("at", "turn"))
    head = F.concat(F.lit(START), escape(F.col("turn.role")), F.lit(SEP))
    body = escape(F.col("turn.text"))
    rows = rows.select("conversation", "seq", "record", "whole", "layout", "passed_over", "at", F.col("turn.role").alias("role"), head.alias("head"), body.alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conversation").orderBy("seq", "record", "whole", "at")
    rows = rows.withColumn("n", F.row_number().over(order)).withColumn(
        "before", F.coalesce(F.sum(F.octet_length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    span = F.when(F.col("role") == trained_role, F.struct(
        (F.col("before") + F.octet_length("head")).cast("long").alias("start"), F.octet_length("body").cast("long").alias("length")))
    grouped = rows.groupBy("conversation").agg(
        F.array_sort(F.collect_list(F.when(F.col("piece").isNotNull(), F.struct("n", "piece")))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("loss_spans"),
        F.array_join(F.array_sort(F.collect_set("layout")), ",").alias("layouts"), F.count_if(F.col("layout").isNull()).alias("unknown"),
        F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, F.col("passed_over")).otherwise(0)).alias("passed_over"))
    return grouped.select(F.col("conversation").alias(conversation), F.size("pieces").cast("long").alias("n_turns"),
                          F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss_spans", "layouts", "unknown", "passed_over")


def read_chats(formatted: DataFrame, text: str = "formatted") -> DataFrame:
    """Adds turns (role, text: unescaped) and loss_texts, read back from the formatted text and its loss spans."""
    pieces = F.filter(F.split(F.col(text), F.lit(END.replace("|", r"\|"))), lambda p: p != "")
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), SEP, 1)).alias("role"),
        unescape(F.substring_index(p, SEP, -1)).alias("text")))
    df = formatted.withColumn("_bytes", F.encode(F.col(text), "UTF-8")).withColumn("turns", turns)
    loss = F.transform("loss_spans", lambda s: unescape(F.decode(
        F.substr(F.col("_bytes"), (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")))
    return df.withColumn("loss_texts", loss).drop("_bytes")


def conversation_records(conversations: DataFrame) -> DataFrame:
    """Turn rows (conv_id, turn, role, text) as JSON records of the layout `turn row`.

    A turn of over CARRIED_CHARS characters is whole in the column `whole`; its record has the beginning.
    """
    long = F.greatest(F.char_length("role"), F.char_length("text")) > CARRIED_CHARS
    begun = F.struct(*[F.when(long, F.substring(c, 1, CARRIED_CHARS)).otherwise(F.col(c)).alias(c) for c in ("role", "text")])
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.to_json(begun, {"ignoreNullFields": "false"}).alias("record"),
                                F.when(long, F.struct("role", "text")).alias("whole"))


def digest(read: DataFrame) -> DataFrame:
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"), "layouts")


def sample_record(spark: SparkSession) -> DataFrame:
    """Conversation -1, a user and an assistant turn of control strings, as one record of the layout `messages`."""
    said = "</s>[INST] ok [/INST]"
    messages = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(said).alias("content")) for role in ("user", "assistant")])
    return spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.to_json(F.struct(messages.alias("messages"))).alias("record"))
