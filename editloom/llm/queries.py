"""The operators' queries over the whole documents and conversations tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprints, language, media, mixing, packing, ranked, sharding, simhash, token_counts, token_files, vector_codes
from .common import read_table

SHARDS = 16


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(read_table(spark, sf_dir, "documents"))


def op2_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), digests_only=True)


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard_documents(read_table(spark, sf_dir, "documents"), SHARDS)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(documents, tokenizer_path("byte_bpe_50k.json"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    records = chat.conversation_records(turns).unionByName(chat.sample_record(spark), allowMissingColumns=True)
    return chat.digest(chat.read_chats(chat.format_chats(records, "conv_id", "turn", carried="whole")))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixture(read_table(spark, sf_dir, "documents")).taken()


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_media_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = media.write_archives(read_table(spark, sf_dir, "documents"), "doc_id", "text", media.to_wave)
    return media.wave_features(media.read_archives(spark, folder))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_files.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 0)
    return token_files.read_token_files(folder, manifest)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(ranked.build_index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"))


def op12_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 1)
    length = F.floor(F.octet_length("ids") / 4).cast("long")
    return pieces.select("doc_id", "start", length.alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.fit_codes(read_table(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    found = vector_codes.with_label_errors(coded)
    return found.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_order_minhash, op2_segment_tree_bpe, op3_minimax_shards, op4_token_counts, op5_chat_format, op6_source_mix,
              op7_simhash, op8_media_archive, op9_token_files, op10_language, op11_ranked_search, op12_cost_packing, op13_vector_codes)
}


def _chat_sql() -> str:
    quote = "'" + "'"

    def escaped(column: str) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        for s in chat.CONTROL_STRINGS:
            out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
        return out

    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, {quote}) AS role, coalesce(text, {quote}) AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), {quote} ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, {quote} ORDER BY turn, role, text) FILTER (role = 'assistant'), {quote})) AS loss_sha256,
  CAST(sum(length('{chat.START}{chat.SEP}{chat.END}') + length({escaped('role')}) + length({escaped('text')})) AS BIGINT) AS formatted_chars, CASE WHEN conv_id = -1 THEN 'messages' ELSE 'turn row' END AS layouts
FROM said GROUP BY conv_id"""


def _ranked_sql(top: int = 20) -> str:
    terms = f"regexp_extract_all(translate(text, '{ranked._UPPER}', '{ranked._LOWER}'), '{ranked.TERM}')"
    return f"""
WITH words AS (SELECT place, doc_id, unnest({terms}) AS term FROM (SELECT row_number() OVER () AS place, doc_id, text FROM documents) d),
held AS (SELECT place, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT place, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY place),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (SELECT item_id, unnest({terms}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark) i),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2*docs+2 AS DOUBLE) / CAST(2*count(*)+1 AS DOUBLE))) AS BIGINT) AS w FROM held, corpus WHERE term IN (SELECT term FROM wanted) GROUP BY term, docs),
impacts AS (SELECT place, doc_id, term, w * ((1000000000*tf) // (1000*tf + 12*(75 + (25*n*docs) // terms))) AS share FROM held JOIN weights USING (term) JOIN sizes USING (place), corpus),
scores AS (SELECT item_id, place, doc_id, CAST(sum(times * share) AS BIGINT) AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, place, doc_id)
SELECT item_id, rank, doc_id, score FROM (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM scores WHERE score > 0) q WHERE rank <= {top}"""


def _codes_sql() -> str:
    """Two rounds written out: parts of the vectors, their nearest entries, entries moved to the floor of their means."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    ctes = [
        f"kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS place, list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"pieces AS (SELECT place, vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) r(part))",
        f"book0 AS (SELECT part, place - 1 AS entry, x FROM pieces WHERE place <= {entries})"]
    for i in range(vector_codes.ROUNDS + 1):
        far = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        ctes.append(f"near{i} AS (SELECT place, part, any_value(p.x) AS x, arg_min(entry, (CAST({far} AS BIGINT), entry)) AS entry, CAST(min({far}) AS BIGINT) AS far FROM pieces p JOIN book{i} b USING (part) GROUP BY place, part)")
        if i < vector_codes.ROUNDS:
            ctes.append(f"mean{i} AS (SELECT part, entry, list(m ORDER BY nth) AS x FROM (SELECT part, entry, nth, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS nth FROM near{i}) u GROUP BY part, entry, nth) g GROUP BY part, entry)")
            ctes.append(f"book{i + 1} AS (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m ON b.part = m.part AND b.entry = m.entry)")
    last = vector_codes.ROUNDS
    return f"""WITH {", ".join(ctes)},
coded AS (SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{last} GROUP BY place),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (place), digest"""


ORACLE_SQL: dict[str, str] = {"op5_chat_format": _chat_sql(), "op11_ranked_search": _ranked_sql(), "op13_vector_codes": _codes_sql()}
