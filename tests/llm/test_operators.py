"""The ten operators against plain versions, on whole tables of sf0.001 and on tables of odd cases."""

from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from editloom.llm import bpe, chat, components, copies, fingerprints, language, media, mixing, queries, sharding, simhash, token_counts, token_files
from editloom.llm.common import read_table

from . import brute

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\t ", "a", "a b", "A b", "one two three", "ONE two three", "x" * 5000, "word " * 3000, "é漢😀 ΟΔΟΣ İ ß", "a\x1cb\x85c d",
       "<|endoftext|>", "x<|startoftext|>y <|endoftext|>", "don't we'll I'd 12345 ½ Ⅷ", "  two  spaces \n \n x ", "same text here again", "same text here again",
       "é ́ á̖", "!!! ... ,,,", "​‍", "tab\tand\nline\r\nend"]


@pytest.fixture(scope="module")
def documents(spark):
    """All documents of sf0.001 and the odd cases, with columns whose names clash with those that operators use."""
    real = read_table(spark, SF, "documents")
    odd = spark.createDataFrame([(10_000 + i, t, None if i % 2 else "en", None if i % 3 else "odd", i) for i, t in enumerate(ODD)], real.schema)
    return real.unionByName(odd)


@pytest.fixture(scope="module")
def table(spark, documents, tmp_path_factory):
    folder = f"file://{tmp_path_factory.mktemp('tables')}"
    documents.repartition(3).withColumn("bucket", F.lit("b")).withColumn("key", F.lit("k")).withColumn("n_tokens", F.lit(1)).withColumn("size", F.lit("s")).withColumn(
        "fp", F.lit(1)).withColumn("h", F.lit(2)).withColumn("start", F.lit(3)).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_op1(spark, table, texts):
    got, ids = rows(queries.op1_order_minhash(spark, table)), sorted(texts)
    assert sorted(got) == ids
    for a, b in zip(ids, [*ids[1:], ids[0]]):
        text, after = texts[a] or "", texts[b] or ""
        edited = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r, own, other, following = got[a], brute.order_minhash(text), brute.order_minhash(edited), brute.order_minhash(after)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(edited))
        assert r["fingerprint"] == "".join(f"{x:04x}" for x in own), a
        assert r["edited_fingerprint"] == "".join(f"{x:04x}" for x in other)
        assert r["near_edited"] == sum(x == y for x, y in zip(own, other)) / 64
        assert r["near_next"] == sum(x == y for x, y in zip(own, following)) / 64


def test_op1_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[40:] + words[:40]  # keeps the order of 82 in 100 pairs; moving one half would keep 50, like a shuffle
    shuffled = words[:]
    random.Random(1).shuffle(shuffled)
    df = fingerprints.order_minhash(spark.createDataFrame([(" ".join(w),) for w in (words, moved, shuffled)], "text string"), "text", "sig", k=1)
    a, b, c = (r["sig"] for r in df.collect())
    near = lambda x, y: sum(i == j for i, j in zip(x, y)) / 64
    assert near(a, b) > near(a, c) and near(a, a) == 1 and near(a, b) < 1


def test_op1_edits_of_text_without_spaces(spark):
    r = random.Random(2)
    text = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(4000))
    edits = [text, "漢" + text, text[:2000] + "漢" + text[2000:], text[:2000] + text[2001:], text[:2000] + "漢" + text[2001:]]
    df = fingerprints.order_minhash(spark.createDataFrame(list(enumerate(edits)), "i int, text string"), "text", "sig").orderBy("i")
    own, *others = (r["sig"] for r in df.collect())
    assert all(sum(x == y for x, y in zip(own, o)) / 64 > 0.9 for o in others)


def test_op1_deviation_of_short_texts():
    """On 30 words with one changed: not much more than 64 independent orders, whose likeness deviates by 0.062 to 0.064."""
    r, found = random.Random(3), []
    for _ in range(300):
        words = [f"w{r.randrange(10**9)}" for _ in range(30)]
        other = words[:]
        other[r.randrange(4, 26)] = "changed"
        a, b = (brute.order_minhash(" ".join(w)) for w in (words, other))
        found.append(sum(x == y for x, y in zip(a, b)) / 64)
    assert np.std(found) < 1.3 * 0.062


def test_op1_hot_keys(spark):
    """Null keys and a repeated key: rows are spread by their text, each once, the next one by (key, hash of text)."""
    docs = spark.createDataFrame([(None if i % 2 else 7 if i % 4 else i, f"text {i} " * 3) for i in range(400)] + [(None, None)] * 3, "doc_id long, text string")
    rows = fingerprints.with_next_text(docs, "doc_id", "text").collect()
    inside = sorted((r for r in rows if not r["border"]), key=lambda r: (r["key"] is None, r["key"] or 0, r["tie"], r["text"]))
    assert len(inside) == 403 and [r["next_text"] for r in inside] == [r["text"] for r in inside[1:] + inside[:1]]
    most = max(sum(r["bucket"] == b for r in inside) for b in {r["bucket"] for r in inside})
    assert most < 403 // 4


def test_op2(spark, table, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    got = rows(queries.op2_segment_tree_bpe(spark, table))
    assert sorted(got) == sorted(texts)
    for k, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(library.decode(ids, skip_special_tokens=False)))
        assert (got[k]["n_tokens"], got[k]["ids_sha256"], got[k]["decoded_sha256"]) == want, (k, text[:50])


def test_op2_random_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.SegmentTreeBpe(path, keep_words=200)
    r = random.Random(3)
    alphabet = ["a", "th", "ing", "B", "é", " ", "\n", "'s", "1", "½", "<|endoftext|>", "!", "漢", "É", "'", "\x1c", "\x85", "_", "Σ", "İ", " ", "🎉"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 20))) for _ in range(3000)]
    for lo in range(0, 3000, 100):
        for text, ids in zip(texts[lo : lo + 100], own.encode_batch(texts[lo : lo + 100])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_bpe_of_single_long_words_is_quick_and_right():
    from tokenizers import Tokenizer

    path, r = queries.tokenizer_path("word_bpe_49k.json"), random.Random(11)
    library, own = Tokenizer.from_file(path), bpe.SegmentTreeBpe(path)
    words = ["a" * n for n in (1, 2, 7, 8, 9, 5_000)] + ["".join(r.choice("etaoinshrdlu漢é") for _ in range(n)) for n in (3, 33, 6_000)]
    want = [np.array(library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert [own.encode_batch([w])[0] for w in words] == want
    assert bpe.SegmentTreeBpe(path).encode_batch(words * 3) == want * 3
    started = time.process_time()
    own.encode_batch(["".join(r.choice("etaoinshrdlu") for _ in range(80_000))])
    assert time.process_time() - started < 5


def test_op3(spark, table, texts):
    got = rows(queries.op3_minimax_shards(spark, table))
    assert sorted(got) == sorted(texts)
    sizes, first, by_shard = defaultdict(int), {}, defaultdict(list)
    for k in sorted(texts):
        raw = (texts[k] or "").encode()
        r = got[k]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[raw] += len(raw) + 1
        first.setdefault(raw, k)
        by_shard[r["shard"]].append((r["slot"], k))
    ordered = [sizes[t] for t in sorted(sizes, key=first.get)]
    loads = [sum(got[k]["size"] for _, k in v) for v in by_shard.values()]
    assert max(loads) == brute.minimax(ordered, 16)
    assert all([s for s, _ in sorted(v)] == list(range(len(v))) and [k for _, k in sorted(v)] == sorted(k for _, k in v) for v in by_shard.values())
    assert all(len({got[k]["shard"] for k in texts if (texts[k] or "").encode() == t}) == 1 for t in sizes)


@pytest.mark.parametrize("seed", range(3))
def test_minimax_with_few_known_totals(spark, seed, monkeypatch):
    """The refinement is exact however few totals the driver gets at once."""
    monkeypatch.setattr(sharding, "FIRST_INTERVALS", 20)
    monkeypatch.setattr(sharding, "MORE_INTERVALS", 30)
    r = random.Random(seed)
    sizes = [r.choice([1, 2, 3, 1000, r.randint(1, 50)]) for _ in range(400)] + [5000] * seed
    ends = np.cumsum(sizes).tolist()
    groups = spark.createDataFrame([(e,) for e in ends], "end long").coalesce(1).cache()
    capacity, cuts = sharding.minimax_cuts(groups, 7)
    assert capacity == brute.minimax(sizes, 7)
    stops = [0, *cuts, ends[-1]]
    assert max(b - a for a, b in zip(stops, stops[1:])) == capacity and set(cuts) <= {0, *ends}


def test_op4(spark, table, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    want = {k: len(library.encode(t or "", add_special_tokens=False).ids) for k, t in texts.items()}
    got = rows(queries.op4_token_counts(spark, table))
    assert {k: r["n_tokens"] for k, r in got.items()} == want
    assert all(r["n_bytes"] == len((texts[k] or "").encode()) and r["over_limit"] == (want[k] > 1024) for k, r in got.items())
    documents = read_table(spark, table, "documents")
    small = token_counts.token_counts(documents, queries.tokenizer_path("byte_bpe_50k.json"), chunk_chars=97, overlap_chars=5)
    assert {r["doc_id"]: r["n_tokens"] for r in small.collect()} == want  # hundreds of seams, many of them widened
    assert {"source", "lang", "bucket", "key"} <= set(small.columns)


def test_op4_boundaries_count_code_points(spark):
    """Characters beyond the basic plane before a boundary: seams are at code points, not UTF-16 units."""
    from tokenizers import Tokenizer

    path, r = queries.tokenizer_path("byte_bpe_50k.json"), random.Random(4)
    library = Tokenizer.from_file(path)
    texts = ["".join(r.choice(["😀", "𝒳𝒴", "extraordinarily", " internationally", "\n", " 🎉🎉", "<|endoftext|>"]) for _ in range(400)) for _ in range(20)] + ["😀" * 300 + " end", "a😀 " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = rows(token_counts.token_counts(df, path, chunk_chars=61, overlap_chars=30))
    assert [got[i]["n_tokens"] for i in range(len(texts))] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_op5(spark, tmp_path):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a\\b <|im_end|> </s>"), (1, 2, "assistant", None), (2, 0, "system", "<\\|im_start|>"), (2, 1, "assistant", "[INST]\\"),
             (3, 0, None, ""), (4, 5, "assistant", "é<|im_sep|>漢"), (4, 3, "us<|im_sep|>er", "x\n"), (None, 0, "user", "lost"), (5, 0, "assistant", "x"), (5, 0, "assistant", "x")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumn("extra", F.lit(1)).write.parquet(f"file://{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op5_chat_format(spark, f"file://{tmp_path}").collect()}
    turns += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == {t[0] for t in turns}
    for c, r in got.items():
        own = [(x[2] or "", x[3] or "") for x in sorted((t for t in turns if t[0] == c), key=lambda t: (t[1], t[2] or "", t[3] or ""))]
        loss = "".join(t for role, t in own if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), brute.sha("".join(f"{a}\n{b}\n" for a, b in own))), c
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), brute.sha(loss)), c


def test_layouts(spark):
    records = ['{"prompt":"p","response":"r"}', '{"instruction":"i","input":"","output":"o"}', '{"instruction":"i","input":"x","output":"o"}', '{"output":"o","instruction":"i"}',
               '{"messages":[{"role":"system","content":"s"},{"role":"user","content":null}]}', '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}',
               '{"data":{"prompt":"p","response":"r"}}', '{"unknown":1}', "[1]", "broken{", None, '{"role":"user","text":"t"}']
    df = spark.createDataFrame(list(enumerate(records)), "c int, record string")
    got = [(r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for r in chat.canonical_turns(df).orderBy("c").collect()]
    assert got == [("prompt and response", [("user", "p"), ("assistant", "r")]), ("instruction with input", [("user", "i"), ("assistant", "o")]),
                   ("instruction with input", [("user", "i\n\nx"), ("assistant", "o")]), ("instruction", [("user", "i"), ("assistant", "o")]),
                   ("messages", [("system", "s"), ("user", "")]), ("conversations", [("user", "h"), ("assistant", "g")]), ("nested prompt", [("user", "p"), ("assistant", "r")]),
                   (None, []), (None, []), (None, []), (None, []), ("turn row", [("user", "t")])]
    formatted = chat.read_chats(chat.format_chats(df.withColumn("seq", F.lit(0)), "c", "seq")).orderBy("c").collect()
    assert [[(t["role"], t["text"]) for t in r["turns"]] for r in formatted] == [t for _, t in got]


def test_op6(spark, table, texts):
    got = queries.op6_source_mix(spark, table).collect()
    assert len(got) == len(texts)
    source = {r["doc_id"]: r["source"] for r in read_table(spark, table, "documents").collect()}
    sizes, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in got:
        s = source[r["doc_id"]]
        assert r["size"] == len(brute.WORD.findall((texts[r["doc_id"]] or "").encode())) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        goal[s] = r["target"]
        assert r["target"] <= 3 * r["source_size"] + 1e-6
    assert all(r["source_size"] == sizes[source[r["doc_id"]]] for r in got)
    assert sum(goal.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - goal[s]) <= max(10, 0.05 * goal[s]) for s in goal), {s: (taken[s], goal[s]) for s in goal}
    again = {(r["doc_id"], r["taken"]) for r in queries.op6_source_mix(spark, table).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_targets():
    assert mixing.targets({"a": 10, "b": 1000, "c": 0}, {"a": 1.0, "b": 2.0, "c": 3.0}) == pytest.approx({"a": 30.0, "b": 980.0, "c": 0.0})
    assert mixing.cycling_weights(["b", None, "a", "Z", "é"]) == {"Z": 1.0, "a": 2.0, "b": 3.0, "é": 1.0, None: 2.0}


def test_op7(spark, table, texts):
    got, keys = rows(queries.op7_simhash(spark, table)), sorted(texts)
    fps = [brute.simhash(texts[k]) for k in keys]
    assert sorted(got) == keys
    for k, fp, c in zip(keys, fps, brute.components(keys, fps)):
        assert (got[k]["fingerprint"], got[k]["component_id"]) == (f"{fp:016x}", c)


@pytest.mark.parametrize("block", [4, 1024])
def test_op7_large_groups(spark, block):
    r = random.Random(block)
    base = [r.getrandbits(64) for _ in range(5)]
    fps = sorted({b ^ sum(1 << i for i in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(120)} | {r.getrandbits(64) for _ in range(200)})
    links = simhash.fingerprint_links(spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long"), block=block)
    root = {x["node"]: x["root"] for x in components.connected_components(links).collect()}
    got = [root.get(simhash.signed(f), simhash.signed(f)) for f in fps]
    want = brute.components(list(range(len(fps))), fps)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_op7_two_hundred_thousand_in_one_bucket(spark):
    """Fingerprints that agree on all bits but 18 lie together in several buckets; random ones elsewhere stay alone."""
    r = random.Random(8)
    at = r.sample(range(64), 18)
    near = {sum(1 << at[j] for j in range(18) if i >> j & 1) for i in range(200_000)}
    far = {r.getrandbits(64) for _ in range(100)}
    df = spark.createDataFrame([(simhash.signed(f),) for f in sorted(near | far)], "fp long")
    root = {x["node"]: x["root"] for x in components.connected_components(simhash.fingerprint_links(df)).collect()}
    assert len({root.get(simhash.signed(f), simhash.signed(f)) for f in near}) == 1 and not far & set(root)


def test_masks_cover():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    assert all(any(not m >> a & 1 and not m >> b & 1 and not m >> c & 1 for m in masks) for a in range(64) for b in range(a + 1, 64) for c in range(b + 1, 64))


def test_op8(spark, table, texts):
    got = rows(queries.op8_media_archive(spark, table))
    assert sorted(got) == sorted(texts)
    for k, text in texts.items():
        raw, r = (text or "").encode(), got[k]
        payload = raw + b"\0" * ((-len(raw)) % 64 if raw else 64)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        wave = media.to_wave(raw)
        assert (r["media_bytes"], r["media_sha256"], r["feature"]) == (len(wave), hashlib.sha256(wave).hexdigest(), media.wave_feature(payload))


def test_archive_ranges_and_broken_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(50):
            z.writestr(f"{i}-0-0.wav", media.to_wave(str(i).encode() * 300))
        broken = z.infolist()[7].header_offset + 60
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[broken : broken + 8] = b"\xff" * 8
    (tmp_path / "a.zip").write_bytes(raw)
    got = media.read_archives(spark, f"file://{tmp_path}", rangeBytes=700)
    assert got.rdd.getNumPartitions() > 4
    found = {r["member"]: r for r in got.collect()}
    assert len(found) == 50 and [m for m, r in found.items() if r["error"]] == ["7-0-0.wav"]
    assert all(media.from_wave(bytes(r["media"]))[1].startswith(m.split("-")[0].encode()) for m, r in found.items() if not r["error"])


def test_op9(spark, table, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    got, start = rows(queries.op9_token_files(spark, table)), 0
    assert sorted(got) == sorted(texts)
    for k in sorted(texts):
        ids = [*library.encode(texts[k] or "", add_special_tokens=False).ids, 0]
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(ids), brute.crc(ids))
        start += len(ids)


@pytest.mark.parametrize("ids", [[], [5], [0, 2**32 - 1], list(range(3000)), [7] * 5000 + [2**20], np.random.default_rng(1).integers(0, 2**31, 4097).tolist(), [0] * 1023 + [50_000] * 2])
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    assert token_files.unpack_blocks(token_files.pack_blocks(ids)).tolist() == ids.tolist()


def test_op10(spark, table, texts):
    got = rows(queries.op10_language(spark, table))
    lang = {r["doc_id"]: r["lang"] for r in read_table(spark, table, "documents").collect()}
    assert sorted(got) == sorted(texts)
    tested = right = 0
    for k, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in texts[k] or ""))
        if r["held_out"] and k < 10_000:
            tested += 1
            right += r["lang_pred"] == lang[k]
    assert tested > 30 and right >= 0.97 * tested


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {tuple(r) for r in language.identify(docs).select("doc_id", "lang_pred", "score").collect()} == {(1, "und", 0.0), (2, "und", 0.0)}


def test_language_reads_whole_texts():
    text = "x" * (language._BLOCK - 2) + "abcdefg"
    bins = {int(b) for part in language.gram_bins(language.letter_codes(text)) for b in part}
    tail = {int(b) for part in language.gram_bins(language.letter_codes("abcdefg")) for b in part}
    assert tail <= bins


@pytest.mark.parametrize("name", [n for n in queries.QUERIES])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([], "conv_id long, turn int, role string, text string").write.parquet(f"file://{tmp_path}/conversations.parquet")
    assert queries.QUERIES[name](spark, f"file://{tmp_path}").count() == (1 if name.startswith("op5") else 0)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if not n.startswith("op5")])
def test_repeated_rows_and_null_keys(spark, tmp_path, name):
    same = [(7, "one two three four", "en", "a", 1)] * 3 + [(None, "one two three five", "en", None, 1)] * 2 + [(8, None, None, None, None)]
    spark.createDataFrame(same, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = queries.QUERIES[name](spark, f"file://{tmp_path}").collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(k) for k, *_ in same)


def test_columns_named_like_helpers(spark):
    """Columns of documents that have the names of the operators' own helper columns keep their values."""
    docs = spark.createDataFrame([(i, f"some words of text number {i // 2} here and there", "en", "s", "a", "b", "c", "d") for i in range(40)],
                                 "doc_id long, text string, lang string, source string, _text string, _key string, _copies string, _copy string")
    helpers = ("_text", "_key", "_copies", "_copy")
    named = language.predict(docs, language.learn(docs))
    assert named.columns == [*docs.columns, "lang_pred", "score"]
    for out, least in ((named, 40), (copies.one_of_each_group(docs), 1), (mixing.mixed_documents(docs), 40)):
        found = out.collect()
        assert len(found) >= least and {tuple(r[c] for c in helpers) for r in found} == {("a", "b", "c", "d")}
