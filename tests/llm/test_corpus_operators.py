"""The ten operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import json
import math
import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from colloquy.llm import chat, eliasfano, exact, graph, langid, licenses, lm, mixing, neardup, passages, pieces, quality, queries
from colloquy.llm import textnum as T

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, body string, size int, kept boolean"
RNG = np.random.default_rng(3)
SYLLABLES = ["ka", "lo", "mi", "ter", "ün", "ség", "po", "ra", "日本"]


def prose(n, rng=RNG):
    return " ".join("".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(n))


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="session")
def rows():
    base, passage = prose(400), prose(70)
    edited = base.split()
    edited[7] = "EDIT"
    texts = [None, "", " \t\n", "a", "A", "one two", base, base, base.replace(" ", "  "), " ".join(edited), prose(30) + " " + passage + " " + prose(40), passage + " " + prose(9), prose(60) + "\n" + passage, "Released under the MIT License.\n" + prose(20), "a b c d e a b c d e f", "line one two\nline one two\n\n line one two", "#$%& *** |||", "naïve café ▁ 𝒳 end", prose(6000), "x" * 70_000, "</s>[INST] ok", *[prose(50) for _ in range(12)]]
    out = [(k, t, ("de", "en", None)[k % 3], ("s1", "s0", None, "s2")[k % 4], len(t or ""), "body", 1, True) for k, t in enumerate(texts)]
    out += [out[6], out[6]]  # rows that are wholly alike
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_hashes_follow_content_not_place():
    a, b = (next(T.slices(pa.array(t))) for t in (["", "xx yy", "yy"], ["yy", "zz xx"]))
    ha, hb = (p.hashes(*p.spans(T.NOT_SPACE)[:2]) for p in (a, b))
    assert ha[1] == ha[2] == hb[0] and ha[0] == hb[2] and len({*ha.tolist(), *hb.tolist()}) == 3


def test_hashes_in_blocks_are_the_same(monkeypatch):
    values = RNG.integers(0, 1 << 62, 400).astype(np.uint64)
    starts = RNG.integers(0, 400, 300)
    ends = np.minimum(starts + RNG.integers(0, 90, 300), 400)
    at_once = T._Powers(np.uint64(12345677)).spans(400, lambda a, b: values[a:b], starts, ends)
    for block in (1, 7, 64, 399, 400):
        monkeypatch.setattr(T, "BLOCK", block)
        assert (T._Powers(np.uint64(12345677)).spans(400, lambda a, b: values[a:b], starts, ends) == at_once).all()


def test_groups_stay_whole_over_batches(spark):
    frame = spark.range(5000).selectExpr("id", "CAST(id % 7 AS INT) AS g")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)

    def work(rows):
        groups = rows.group_by("g").aggregate([("id", "sum"), ("id", "count")])
        return pa.table({"g": groups["g"], "total": groups["id_sum"], "n": groups["id_count"]})

    try:
        got = T.map_groups(frame, ["g"], "g int, total bigint, n bigint", work).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(tuple, got)) == [(g, sum(range(g, 5000, 7)), len(range(g, 5000, 7))) for g in range(7)]


def test_elias_fano():
    for universe, n in ((1 << 62, 5000), (300, 200), (40, 200), (1, 0), (1 << 63, 3)):
        values = np.sort(RNG.integers(0, universe, n).astype(np.uint64))
        ef = eliasfano.EliasFano.of(eliasfano.from_buffer(eliasfano.to_bytes({"x": eliasfano.EliasFano.build(values, universe)})), "x")
        at = RNG.integers(0, max(n, 1), 100 * bool(n))
        assert (ef.access(at) == values[at]).all()
        ask = np.concatenate([values, RNG.integers(0, universe, 500).astype(np.uint64)])
        assert ((ef.find(ask) >= 0) == np.isin(ask, values)).all()


# --- 1 mixing ----------------------------------------------------------------------------------------


def test_targets_share_again_until_none_is_above():
    got = mixing.targets(np.array([10, 100, 1000]), np.array([3.0, 1.0, 2.0]), 1665, 2.0)
    assert got.tolist() == [20, 200, 1445]
    assert mixing.targets(np.array([0, 5]), np.array([1.0, 1.0]), 7.5, 2.0).tolist() == [0, 7.5]


def test_split_tree_deals_quotas_exactly():
    leaves = mixing.split_tree(np.array([7, 0, 23]), 5, np.random.default_rng(1))
    assert leaves.sum(axis=0).tolist() == [7, 0, 23] and leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 1


def test_mixing(spark, docs, rows, empty):
    plan = mixing.plan(docs, mixing.cycle((3, 1, 2)))
    got = mixing.taken(plan).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    assert all(r.taken <= 2 * r["size"] for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.taken(mixing.plan(docs, mixing.cycle((3, 1, 2)))).collect()))
    mixed = mixing.mixed(docs, plan)
    assert mixed.columns == docs.columns
    drawn = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    wanted = Counter()
    for r in got:
        wanted[r.doc_id] += r.taken
    sizes = {r[0]: len(words(r[1])) for r in rows}
    assert all(drawn[k] * sizes[k] == n for k, n in wanted.items())
    assert mixing.taken(mixing.plan(empty, mixing.cycle((3, 1, 2)))).count() == 0


def test_mix_comes_near_its_targets(spark):
    made = [(k, prose(int(RNG.integers(5, 60))), "en", f"s{k % 5 if k % 3 else 0}") for k in range(600)]
    plan = mixing.plan(spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string"), mixing.cycle((3, 1, 2)))
    source = {k: s for k, _, _, s in made}
    sums, target = Counter(), {}
    for r in mixing.taken(plan).collect():
        sums[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(sums[s] - t) <= max(3, 0.002 * t) for s, t in target.items())
    assert abs(sum(target.values()) - 1.5 * sum(len(words(t)) for _, t, _, _ in made)) < 1e-6


def mix_error(spark, made):
    """By source: taken words, target, size; no document more than twice."""
    frame = spark.createDataFrame(made, "doc_id bigint, text string, source string")
    source = {k: s for k, _, s in made}
    out = {}
    for r in mixing.taken(mixing.plan(frame, mixing.cycle((3, 1, 2)))).collect():
        assert r.taken <= 2 * r["size"] and r.taken == r["size"] * len(r.shards)
        taken, _, _ = out.get(source[r.doc_id], (0, 0, 0))
        out[source[r.doc_id]] = (taken + r.taken, r.target, r.source_size)
    return out


def test_mix_of_repeated_rows_and_of_huge_documents(spark):
    made = [(7, "one two three", "same")] * 300 + [(k, prose(20), "many") for k in range(100, 400)] + [(k, prose(9000), "huge") for k in range(900, 903)]
    for s, (taken, target, size) in mix_error(spark, made).items():
        assert abs(taken - target) <= {"same": 900, "many": 20, "huge": 4500}[s], (s, taken, target, size)  # half of what can't be split


def test_mix_with_shuffled_joins_and_many_sources(spark, monkeypatch):
    made = [(k, prose(int(RNG.integers(1, 9))), f"s{k % 90}") for k in range(900)] + [(5000 + k, None, None) for k in range(3)]
    near = mix_error(spark, made)
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert mix_error(spark, made) == near
    assert all(abs(taken - target) <= 4 for taken, target, _ in near.values())  # documents have 8 words at most


def test_every_shard_is_a_partition(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 16_000)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 20)
    frame = spark.createDataFrame([(k, prose(10), f"s{k % 3}") for k in range(300)], "doc_id bigint, text string, source string")
    plan = mixing.plan(frame, mixing.cycle((3, 1, 2)))
    sizes = mixing.mixed(frame, plan).rdd.glom().map(len).collect()
    assert len(sizes) == plan.shards > 4 and all(sizes)
    dealt = Counter(k for r in mixing.taken(plan).select("shards").collect() for k in r.shards)
    assert sorted(dealt.values()) == sorted(sizes)


# --- 2 exact dedup -------------------------------------------------------------------------------------


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(r)
    return {b: (min(g, key=lambda r: (-len(r[1] or ""), r[0]))[0], len(g)) for b, g in groups.items()}


def test_exact_dedup(docs, rows, empty, monkeypatch):
    for least in (500, 2):  # also with hot digests
        monkeypatch.setattr(exact, "LEAST_HOT", least)
        want, got = brute_exact(rows), exact.assign(docs).collect()
        texts = {r[0]: re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows}
        assert len(got) == len(rows)
        for r in got:
            body = texts[r.doc_id]
            assert (r.keep_id, r.group_size, r.text_sha256) == (*want[body], hashlib.sha256(body.encode()).hexdigest())
        kept = [r.doc_id for r in got if r.kept]
        assert sorted(kept) == sorted(k for k, _ in want.values())
        left = exact.drop_copies(docs)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted(kept)
    assert exact.assign(empty).count() == exact.drop_copies(empty).count() == 0


def test_exact_dedup_null_ids(spark):
    got = exact.assign(spark.createDataFrame([(None, "a b"), (5, "ab"), (None, "ab")], "doc_id bigint, text string")).collect()
    assert [r.keep_id for r in got] == [None] * 3 and sum(r.kept for r in got) == 1


def test_exact_dedup_tells_colliding_digests_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact, "first_digest", lambda body: F.substring(F.sha2(body, 256), 1, 0))  # one digest for all
    monkeypatch.setattr(exact, "second_digest", lambda body, seed: F.length(body).cast("bigint") if seed == 0 else F.xxhash64(F.lit(seed), body))
    made = [(1, "ab"), (2, "cd"), (3, "a b"), (4, "xyz"), (5, "d c")]
    got = exact.assign(spark.createDataFrame(made, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1), 5: (5, 1)}


# --- 3 substring dedup -----------------------------------------------------------------------------------


def brute_passages(rows, n=50):
    least = {}
    for k, text, *_ in rows:
        if k is not None:
            w = words(text)
            for i in range(len(w) - n + 1):
                key = tuple(w[i : i + n])
                least[key] = min(k, least.get(key, k))
    out = []
    for k, text, *_ in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - n + 1):
            if k is not None and tuple(w[i : i + n]) in least and least[tuple(w[i : i + n])] < k:
                gone.update(range(i, i + n))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((k, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), " ".join(kept)))
    return out


def test_substring_dedup(docs, rows, empty):
    want = brute_passages(rows)
    assert any(x[2] for x in want)
    assert sorted(map(tuple, passages.digests(docs).collect())) == sorted(x[:4] for x in want)
    left = passages.remove_repeats(docs)
    assert left.columns == docs.columns
    changed = {k: text for k, _, n, _, text in want if n}
    assert all(r.text == changed.get(r.doc_id, next(x[1] for x in rows if x[0] == r.doc_id)) for r in left.collect())
    assert passages.digests(empty).count() == 0


def test_substring_dedup_contexts_that_differ(spark):
    rng = np.random.default_rng(11)
    common = [prose(90, rng).split() for _ in range(4)]
    made = []
    for k in range(60):
        parts = []
        for c in rng.permutation(4)[:3]:
            a = int(rng.integers(0, 40))
            parts += [*prose(int(rng.integers(0, 30)), rng).split(), *common[c][a : a + int(rng.integers(30, 90))]]
        made.append((k if k % 13 else None, " ".join(parts)))
    frame = spark.createDataFrame(made, "doc_id bigint, text string").repartition(4)
    assert sorted(map(repr, map(tuple, passages.digests(frame).collect()))) == sorted(repr(x[:4]) for x in brute_passages(made))


# --- 4 chat formatting -------------------------------------------------------------------------------------


def test_chat_reads_back_exactly(spark):
    hard = ["", "</s>[INST] x [/INST]", "a\\b\\\\<|end|>", "<|turn|>user<|text|>", "<<SYS>>\n<</SYS>>\\", "plain", "日本 <s>"]
    said = [(1, k, ("user", "assistant", "system")[k % 3], t) for k, t in enumerate(hard)] + [(2, 0, None, None), (2, 0, "assistant", "tie"), (2, None, "user", "first"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    table = spark.createDataFrame([(*r, 9) for r in said], "conv_id bigint, turn bigint, role string, text string, segments int").repartition(3)
    rendered = chat.render(chat.from_table(table)).cache()
    for r in chat.digests(rendered).collect():
        turns = [(x[2] or "", x[3] or "") for x in sorted((s for s in said if s[0] == r.conv_id), key=lambda s: (s[1] is not None, s[1] or 0, s[2] or "", s[3] or ""))]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in rendered.collect():
        assert r.formatted.count(chat.TURN) == r.formatted.count(chat.END) == len(r.loss_runs)
        at, learned = 0, []
        for run in r.loss_runs:
            at += run.skip
            learned.append(r.formatted[at : at + run.learn])
            at += run.learn
        turns = sorted((s for s in said if s[0] == r.conv_id), key=lambda s: (s[1] is not None, s[1] or 0, s[2] or "", s[3] or ""))
        assert [re.sub(r"\\(\\?)", r"\1", x) for x in learned] == [(s[3] or "") if s[2] == "assistant" else "" for s in turns]
        assert r.formatted[at:].endswith(chat.END)
    from pyspark.sql import functions as F

    wrong = rendered.withColumn("loss_runs", F.transform("loss_runs", lambda x: x.withField("skip", x["skip"] + 1)))
    with pytest.raises(Exception, match="doesn't fit"):
        chat.digests(wrong).collect()
    assert chat.digests(chat.render(chat.from_table(table.limit(0)))).count() == 0
    with pytest.raises(ValueError):
        chat.from_table(table.drop("role"))


def test_chat_layouts(spark):
    turn = lambda r, t: {"role": r, "text": t}
    cases = [
        ({"messages": [{"role": "user", "content": "q"}, {"content": None, "role": "assistant"}]}, [turn("user", "q"), turn("assistant", None)]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]}, [turn("user", "q"), turn("assistant", "a"), turn("tool", "t")]),
        ({"prompt": "q", "completion": "a"}, [turn("user", "q"), turn("assistant", "a")]),
        ({"instruction": "i", "input": "x", "output": "o"}, [turn("user", "i\n\nx"), turn("assistant", "o")]),
        ({"instruction": "i", "input": "", "output": "o"}, [turn("user", "i"), turn("assistant", "o")]),
        ({"system": "", "prompt": "q", "response": "a"}, [turn("user", "q"), turn("assistant", "a")]),
        ({"question": "q", "answer": "a"}, [turn("user", "q"), turn("assistant", "a")]),
        ({"id": 7, "meta": {"prompt": "no"}, "messages": [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": "a"}]}, [turn("user", "q"), turn("assistant", "a")]),
        ({"messages": [{"role": "user", "content": "m"}], "prompt": "q", "response": "a"}, [turn("user", "m")]),
        ({"id": "x", "prompt": "q", "response": "a", "score": 1.5}, [turn("user", "q"), turn("assistant", "a")]),
        ({"prompt": {"k": 1}, "completion": None}, [turn("user", '{"k":1}'), turn("assistant", None)]),
        ({"messages": []}, None),
        ({"messages": "text"}, None),
        ({"other": 1}, None),
    ]
    records = [(k, json.dumps(c)) for k, (c, _) in enumerate(cases)] + [(99, "no json"), (98, None)]
    got = {r.conv_id: r.turns for r in chat.from_json(spark.createDataFrame(records, "conv_id bigint, j string"), "j").collect()}
    for k, (_, want) in enumerate(cases):
        assert (None if got[k] is None else [t.asDict() for t in got[k]]) == want
    assert got[99] is None and got[98] is None


def test_chat_long_and_many_turns(spark):
    long = "<|end|>\\ x" * 40_000
    said = [(1, 0, "user", long), (1, 1, "assistant", long)] + [(2, k, "assistant", "</s>" if k % 2 else "a") for k in range(5000)]
    rows = {r.conv_id: r for r in chat.digests(chat.render(chat.from_table(spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string")))).collect()}
    assert rows[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert (rows[2].n_turns, rows[2].loss_sha256) == (5000, hashlib.sha256(("a</s>" * 2500).encode()).hexdigest())


def test_chat_fingerprint_of_columns():
    from pyspark.sql import types

    kind = types.StructType([types.StructField("a", types.ArrayType(types.StructType([types.StructField("b", types.StringType())]))), types.StructField("c", types.StructType([types.StructField("d", types.LongType())]))])
    assert chat.schema_paths(kind) == ["a[].b", "c.d"]
    assert chat.digest(["x", "y"]) == chat.digest(["y", "x"]) != chat.digest(["x"])


# --- 5 SentencePiece ------------------------------------------------------------------------------------


def test_sentencepiece_matches_the_library(docs, rows, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in pieces.digests(docs, MODEL).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r.n_source_bytes == len(texts[r.doc_id].encode())
    for r in pieces.encode(docs.filter("length(text) < 3000"), MODEL).collect():
        data = texts[r.doc_id].encode()
        assert b"".join(data[a:b] for a, b in zip(r.starts, r.ends)) == data
    assert pieces.digests(empty, MODEL).count() == 0


def mapped_charsmap():
    """A tiny double array with the keys 'ab' -> 'X' and 'a' -> 'yz'."""
    units = np.zeros(1024, "<u4")
    units[0] = 256 << 10  # the root's offset
    at_a = 256 ^ ord("a")
    units[at_a] = ord("a") | 1 << 8 | (512 ^ at_a) << 10
    units[512] = 0x80000000 | 2  # leaf of 'a'
    at_b = 512 ^ ord("b")
    units[at_b] = ord("b") | 1 << 8 | (768 ^ at_b) << 10
    units[768] = 0x80000000 | 0  # leaf of 'ab'
    strings = b"X\0yz\0"
    return units.nbytes.to_bytes(4, "little") + units.tobytes() + strings


def test_a_model_with_a_character_map(spark, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.trainer_spec.model_type = model.trainer_spec.BPE
    model.trainer_spec.unk_id, model.trainer_spec.bos_id, model.trainer_spec.eos_id, model.trainer_spec.pad_id = 0, 1, 2, -1
    for text, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        model.pieces.add(piece=text, score=0.0, type=kind)
    for k, text in enumerate(["yz", "▁X", "▁yz", "▁", "X", "c", "y", "z", "é", "Xc"]):
        model.pieces.add(piece=text, score=-float(k + 1), type=1)
    spec = model.normalizer_spec
    spec.name, spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = "mapped", mapped_charsmap(), True, True, True
    path = str(tmp_path / "mapped.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(4)
    texts = ["", " ", "  abc  a ", "ab", "é c", "qq ab", "a b", *("".join(rng.choice(list("abcyzXé q "), rng.integers(0, 30))) for _ in range(300))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pieces.encode(frame, path).collect():
        assert r.ids == library.encode(texts[r.doc_id]), texts[r.doc_id]
        data = texts[r.doc_id].encode()
        shown = [data[a:b].decode() for a, b in zip(r.starts, r.ends)]
        assert r.starts == sorted(r.starts) and "".join(shown).replace(" ", "") == texts[r.doc_id].replace(" ", "")
    got = {r.doc_id: r for r in pieces.digests(frame, path).collect()}
    for k, text in enumerate(texts):
        assert got[k].decoded_sha256 == hashlib.sha256(library.decode(library.encode(text)).encode()).hexdigest()


def test_normalizer_aligns_mapped_texts():
    normal = pieces.Normalizer(mapped_charsmap(), dummy_prefix=True, strip_extra=True)
    text, align = normal(b"  abc  a ")
    assert text == "▁Xc▁yz".encode()
    assert align.tolist() == [2, 2, 2, 2, 4, 5, 5, 5, 7, 7, 8]
    assert normal(b"   ")[0] == b"" and normal(b"")[0] == b""


# --- 6 language model --------------------------------------------------------------------------------


def brute_lm(train, texts, cutoffs=(1, 1, 1)):
    grams = [Counter() for _ in range(3)]
    for t in train:
        w = ["<>", *words(lower(t)), "</>"]
        grams[0].update(w[1:])
        grams[1].update(zip(w, w[1:]))
        grams[2].update(zip(w, w[1:], w[2:]))
    n, v = sum(grams[0].values()), len(grams[0])
    one = {**grams[0], "<>": len(train)}
    kept = [{g: c for g, c in grams[k].items() if c >= cutoffs[k]} for k in (1, 2)]
    left = [Counter(), Counter()]
    for (a, b), c in kept[0].items():
        left[0][a] += (c - 0.75) / one[a]
    for (a, b, c3), c in kept[1].items():
        left[1][a, b] += (c - 0.75) / grams[1][a, b]
    out = []
    for t in texts:
        w = ["<>", *words(lower(t)), "</>"]
        base = score = known = 0
        for i in range(1, len(w)):
            p = (grams[0].get(w[i], 0) + 0.1) / (n + 0.1 * (v + 1))
            known += w[i] in grams[0]
            base += math.log10(p)
            a = w[i - 1]
            if a in one:
                p = (max(kept[0][a, w[i]] - 0.75, 0) / one[a] if (a, w[i]) in kept[0] else 0) + (1 - left[0][a]) * p
            if i > 1 and (pair := (w[i - 2], a)) in kept[0]:
                p = ((kept[1][*pair, w[i]] - 0.75) / grams[1][pair] if (*pair, w[i]) in kept[1] else 0) + (1 - left[1][pair]) * p
            score += math.log10(p)
        out.append((len(w) - 1, known, base, score))
    return n, v, out


@pytest.mark.parametrize("part_tokens, key_bits, cutoffs", [(1 << 21, 64, (1, 1, 1)), (20, 64, (1, 1, 1)), (400, 8, (1, 1, 1)), (400, 64, (1, 2, 2))])
def test_lm(docs, rows, empty, monkeypatch, part_tokens, key_bits, cutoffs):
    monkeypatch.setattr(lm, "PART_TOKENS", part_tokens)  # few tokens a part: split slots
    train = docs.filter("doc_id % 4 <> 0")
    model = lm.train(train, cutoffs=cutoffs, key_bits=key_bits)  # few bits a key: two numbers instead of one
    assert any(level.masses for level in model.levels) == (part_tokens == 20)
    n, v, want = brute_lm([r[1] for r in rows if r[0] % 4], [r[1] for r in rows], cutoffs)
    assert (model.tokens, model.words) == (n, v)
    wanted = {r[0]: w for r, w in zip(rows, want)}
    got = lm.score(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        tokens, known, base, score = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known) == (tokens, known)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, abs=0.02 * tokens)
    assert lm.score(empty, model).count() == 0


def test_lm_query_keeps_ngrams_seen_once(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op6_lm_scoring(spark, str(tmp_path)).collect()}
    _, _, whole = brute_lm([r[1] for r in rows if not got[r[0]].held_out], [r[1] for r in rows], (1, 1, 1))
    for r, (tokens, known, _, score) in zip(rows, whole):
        assert (got[r[0]].n_tokens, got[r[0]].n_known) == (tokens, known)
        assert got[r[0]].score == pytest.approx(score, abs=0.02 * tokens)


def test_lm_without_training(docs, empty):
    got = lm.score(docs, lm.train(empty)).collect()
    assert all(r.score == pytest.approx(0.0) and r.n_known == 0 for r in got)


# --- 7 licences ---------------------------------------------------------------------------------------


def test_licenses(spark, docs, empty):
    cases = {
        1: "MIT license, the mit LICENSE and Apache  License", 2: "general public\nlicense general public license", 3: "mit licenses", 4: None, 5: "",
        6: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        7: "permission is hereby granted by nobody", 8: "mit", 9: "x " * 5000 + "apache license",
    }
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(cases.items()), "doc_id bigint, text string")).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (3, 0, 6, "apache,mit")
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].labels) == (2, 0, 3, "gpl")
    for k in (3, 4, 5, 7, 8):
        assert (got[k].n_base, got[k].first_word, got[k].labels, got[k].score) == (0, None, "", 0)
    assert (got[6].base_labels, got[6].labels) == ("", "mit") and got[6].score > 0.9
    assert (got[9].first_word, got[9].n_words) == (5000, 5002)
    for r in licenses.scan(docs).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert tuple(r)[1:6] == brute_license(r.text)
    assert licenses.scan(empty).count() == 0


def brute_license(text):
    w, places, labels = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)), [], set()
    for label, phrase in (("mit", ["mit", "license"]), ("apache", ["apache", "license"]), ("gpl", ["general", "public", "license"])):
        found = [k for k in range(len(w)) if w[k : k + len(phrase)] == phrase]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licenses_of_a_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}
    added = 0
    for r in licenses.scan(frame).collect():
        assert tuple(r)[1:6] == brute_license(texts[r.doc_id])
        base, all_ = ({x for x in s.split(",") if x} for s in (r.base_labels, r.labels))
        assert base <= all_ and (r.score > 0) == bool(all_)
        added += base < all_
        assert ("cc-by-nc" in all_) == ("Licensed under CC BY-NC" in (texts[r.doc_id] or ""))
    assert added


def test_licenses_labels_of_the_method(spark):
    from colloquy.llm import license_texts

    around = prose(200)
    cases, want = {}, {}
    for k, (label, text, _) in enumerate(license_texts.TEXTS):
        cases[k], want[k] = f"{around}\n{text}\n{around}", label
    cases[100] = license_texts.MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "ANN EXAMPLE AND HER SMALL COMPANY OF FRIENDS")  # a holder put in
    cases[101] = " ".join(reversed(license_texts.MIT.split()))  # the words in another order
    cases[102] = license_texts.MIT.replace("without restriction", "with restriction").replace("free of charge", "for a fee")  # without the phrases
    cases[103] = license_texts.BSD_2 + "\n" + around + "\n" + license_texts.ISC
    cases[104] = cases[105] = license_texts.ZLIB
    cases[106] = license_texts.ZLIB[: len(license_texts.ZLIB) // 8]
    cases[107] = "# " + license_texts.MIT.replace(" ", "\n# ")
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(k, t, "x") for k, t in cases.items()], "doc_id bigint, text string, labels string")).collect()}
    for k, label in want.items():
        assert label in got[k].labels.split(",") and got[k].score > 0.9, license_texts.TEXTS[k]
    assert got[100].labels == got[107].labels == "mit" and got[101].labels == got[102].labels == got[106].labels == ""
    assert got[103].labels == "bsd,isc" and got[104].labels == got[105].labels == "zlib"
    more = {
        1: ("Licensed under CC BY-NC 4.0", "cc-by-nc"), 2: ("licensed under CC BY 4.0", "cc-by"), 3: ("I do not like the ISC License", ""), 4: ("released under the ISC License.", "isc"),
        5: (license_texts.ZERO_BSD, "0bsd"), 6: (license_texts.MIT + license_texts.BSD_3 + license_texts.UNLICENSE, "bsd,mit,unlicense"), 7: (f"{license_texts.BOOST} {around} {license_texts.ZLIB}", "boost,zlib"),
        8: ("the ISC " * 300 + license_texts.MIT + " License of ISC" * 300, "mit"), 9: ("GNU Lesser General Public License Copyright", "gpl,lgpl"),
    }
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame([(k, t) for k, (t, _) in more.items()], "doc_id bigint, text string")).collect()}
    assert got == {k: want for k, (_, want) in more.items()}
    own = licenses.scan(spark.createDataFrame([(1, "all rights kept by nobody ever")], "doc_id bigint, text string"), templates=(licenses.Template("own", "rights kept by nobody"),)).first()
    assert (own.labels, own.score) == ("own", 1.0)


def test_licenses_look_up_each_windows_rarest_words():
    index = licenses.Index()
    text = " ".join(index.templates[k].text for k in range(len(index.templates)))
    part = next(T.slices(pa.array([text, "the of and " * 50])))
    starts, ends, owner = part.spans(T.ALNUM)
    codes = index.encode(part.hashes(starts, ends, T.BYTES_LOWER))
    first = np.array([0, (owner == 0).sum()])
    looked = set(index.looked_up(codes, owner, first).tolist())
    for w in range(0, int(first[1]), licenses.WINDOW):
        here = [k for k in range(w, min(w + licenses.WINDOW, int(first[1]))) if index.is_rare[codes[k]]]
        best = sorted({int(codes[k]) for k in here}, key=lambda c: (-index.idf[c], c))[: licenses.TOP]
        assert {k for k in looked if w <= k < w + licenses.WINDOW} == {k for k in here if codes[k] in best} | {k for k in range(w, min(w + licenses.WINDOW, int(first[1]))) if index.is_anchor[codes[k]]}
    assert not any(k >= first[1] for k in looked)


# --- 8 near dedup ----------------------------------------------------------------------------------------


def brute_near(rows, n, percent=80):
    sets = []
    for k, text in rows:
        w = words(lower(text))
        sets.append((k, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    up = {k: k for k, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return [(k, len(s), None if k is None else root(k)) for k, s in sets]


@pytest.mark.parametrize("n", [2, 5])
def test_near_dedup(spark, n, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)  # many blocks of a family
    rng = np.random.default_rng(n)
    bases, made = [prose(120, rng).split() for _ in range(3)], [(1000, None), (1001, ""), (1002, " "), (1003, "Solo"), (1004, "solo"), (1005, "two words"), (1006, "two  WORDS"), (None, " ".join(prose(9, rng)))]
    for k in range(70):
        w = list(bases[k % 3])
        for at in rng.integers(0, len(w), int(rng.integers(0, 14))):
            w[at] = prose(1, rng)
        made.append((k, " ".join(w)))
    made += [(None, made[-1][1]), made[20]]
    frame = spark.createDataFrame([(k, t, 1) for k, t in made], "doc_id bigint, text string, component_id int").repartition(3)
    how = neardup.Similar(words=n)
    want = brute_near(made, n)
    got = neardup.assign(frame, how).collect()
    assert sorted((repr(tuple(r)[:3]) for r in got)) == sorted(map(repr, want))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = neardup.keep(frame, how)
    assert left.columns == frame.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(k) for k, _, c in want if k == c)


def test_near_dedup_compares_sets_of_one_digest(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(neardup, "_sketch", lambda words, seed, sets: seen.append(seed) or weak_sketch(words, seed, sets))
    made = [(1, "a b c"), (2, "d e f"), (3, "a b c"), (4, "x y z w")]
    got = {r.doc_id: r.component_id for r in neardup.assign(spark.createDataFrame(made, "doc_id bigint, text string"), neardup.Similar(words=2)).collect()}
    assert got == {1: 1, 3: 1, 2: 2, 4: 4} and max(seen) == 1


def weak_sketch(words, seed, sets, real=neardup._sketch):
    """Sketches whose digests are all alike under the first seed."""

    def make():
        work = real(words, seed, sets)()

        def weak(part, batch):
            got = work(part, batch)
            return got | ({"h1": np.zeros(part.n, np.int64), "h2": np.zeros(part.n, np.int64)} if seed == 0 else {})

        return weak

    return make


@pytest.mark.parametrize("changed", [9, 30])
def test_near_dedup_of_one_family(spark, monkeypatch, changed):
    """A family of members that are near the threshold, or unlike one another, and a hot bucket of many blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(changed)
    base, made = prose(130, rng).split(), []
    for k in range(160):
        w = list(base)
        for at in rng.choice(len(w), changed, replace=False):
            w[at] = prose(1, rng)
        made.append((int(rng.integers(0, 10_000)) * 1000 + k, " ".join(w)))
    frame = spark.createDataFrame(made, "doc_id bigint, text string")
    got = sorted(tuple(r)[:3] for r in neardup.assign(frame, neardup.Similar(words=1)).collect())
    assert got == sorted(brute_near(made, 1))
    assert (len({c for _, _, c in got}) < 100) == (changed == 9)


def test_near_dedup_ids_that_repeat(spark, empty):
    a, b = prose(50), prose(50)
    made = [(7, a), (7, b), (3, b), (9, a)]
    got = neardup.assign(spark.createDataFrame(made, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in got} == {3}
    assert neardup.assign(empty).count() == 0


def test_posterior_bounds_keep_pairs_at_the_threshold():
    for n, least in neardup.least_matches(80):
        below = sum(math.comb(n, m) * 0.8**m * 0.2 ** (n - m) for m in range(least))
        assert below < 1e-6


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(300, 301)]
    got = {r.id: r.least for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 300: 300, 301: 300}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    rng, links = np.random.default_rng(2), []
    for g in range(60):  # random graphs of all densities
        n = int(rng.integers(2, 25))
        links += [(1000 * g + int(x), 1000 * g + int(y)) for x, y in rng.integers(0, n, (int(rng.integers(1, 2 * n)), 2))]
    least = {x: x for pair in links for x in pair}
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    got = {r.id: r.least for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: least[x] for x in linked}


# --- 9 language ID -------------------------------------------------------------------------------------


def test_language_id(spark, empty):
    rng = np.random.default_rng(5)
    kinds = {"xx": ["sha", "the", "wor", "ing"], "yy": ["lich", "keit", "und", "ß"], "zz": ["ción", "que", "ñor", "ado"]}
    text = lambda k: " ".join("".join(rng.choice(kinds[k], rng.integers(1, 4))) for _ in range(30))
    made = [(k, text(("xx", "yy", "zz")[k % 3]), ("xx", "yy", "zz")[k % 3] if k % 10 else None) for k in range(240)]
    extra = [(900, None, "xx"), (901, "", None), (902, "123 $$$", "xx"), (903, "ß", "yy"), (904, "the" * 20_000, "xx")]
    frame = spark.createDataFrame([(*r, "src") for r in made + extra], "doc_id bigint, text string, lang string, score string")
    out = langid.held_out("doc_id", 5)
    model = langid.fit(frame.filter(~out), MODEL)
    assert model.languages == ["xx", "yy", "zz"]
    assert np.allclose(model.theta(0, 3).sum(axis=0), 1)
    got = {r.doc_id: r for r in langid.predict(frame, model).collect()}
    assert all(got[k].lang_pred == ("xx", "yy", "zz")[k % 3] for k, _, _ in made)
    assert all((got[k].lang_pred, got[k].score) == ("und", 0) for k in (900, 901, 902))
    assert got[903].lang_pred == "yy" and got[904].lang_pred == "xx" and all(0 <= r.score <= 1 for r in got.values())
    assert {r.doc_id for r in frame.filter(out).collect()} == {k for k, *_ in made + extra if zlib.crc32(str(k).encode()) % 5 == 0}
    nothing = langid.predict(frame, langid.fit(empty, MODEL)).collect()
    assert all(r.lang_pred == "und" for r in nothing)


def segmentations(table, data):
    """All ways to cut a word: lists of piece numbers, by looking every substring up."""
    def number(kind, a, b):
        values = np.frombuffer(data[a:b], np.uint8)
        with np.errstate(over="ignore"):
            sums = (T.BYTES_LOWER[values] * T._BYTE_POWERS.up[: b - a]).sum(dtype=T.U64)
        return int(kind.find(np.array([sums], T.U64), b - a)[0])

    def rest(at):
        return [[]] if at == len(data) else [[k, *more] for to in range(at + 1, len(data) + 1) if (k := number(table.inner, at, to)) > 0 for more in rest(to)]

    return [[1, *r] for r in rest(0)] + [[k, *r] for to in range(1, len(data) + 1) if (k := number(table.initial, 0, to)) > 0 for r in rest(to)]


def test_forward_sums_all_segmentations():
    table = langid.Pieces(MODEL)
    assert table.longest == 24
    texts = ["other", "Information", "日本", "a", "ñ"]
    part = next(T.slices(pa.array(texts)))
    starts, ends, _ = part.spans(T.NOT_SPACE)
    order = np.argsort(-(ends - starts), kind="stable")
    size = (ends - starts)[order]
    theta = RNG.random((table.size, 2))
    theta[0] = 0
    logs = langid.forward(table, part.buf, starts[order], size, theta)
    weight = np.arange(1.0, 6.0)
    uses = langid.expected(table, part.buf, starts[order], size, weight, theta[:, 0])
    want_uses = np.zeros(table.size)
    for row, k in enumerate(order):
        cuts = segmentations(table, texts[k].lower().encode())
        for c in range(2):
            assert logs[row, c] == pytest.approx(math.log(sum(math.prod(theta[p, c] for p in cut) for cut in cuts)))
        whole = sum(math.prod(theta[p, 0] for p in cut) for cut in cuts)
        for cut in cuts:
            np.add.at(want_uses, cut, weight[row] * math.prod(theta[p, 0] for p in cut) / whole)
    assert np.allclose(uses, want_uses)


def slow_log(table, data, theta):
    """The forward algorithm byte by byte in Python, in logarithms."""
    add = lambda x, y: max(x, y) + math.log1p(math.exp(-abs(x - y))) if min(x, y) > -math.inf else max(x, y)
    alpha = [math.log(theta[1]), *[-math.inf] * len(data)]
    for kind in (table.initial, table.inner):
        for at in range(len(data) if kind is table.inner else 1):
            sums = T.U64(0)
            for to in range(at + 1, min(len(data), at + table.longest) + 1):
                with np.errstate(over="ignore"):
                    sums = sums + T.BYTES_LOWER[data[to - 1]] * T._BYTE_POWERS.up[to - at - 1]
                k = int(kind.find(np.array([sums], T.U64), to - at)[0])
                if k > 0:
                    alpha[to] = add(alpha[to], (alpha[at] if kind is table.inner else 0.0) + math.log(theta[k]))
    return alpha[-1]


def test_long_runs_are_one_lattice(monkeypatch):
    monkeypatch.setattr(langid, "CELLS", 100)  # many blocks of places
    table = langid.Pieces(MODEL)
    texts = ["訳者は翻訳された文章を読みました" * 9, "internationalisation" * 4, "x" * 333, "ab"]
    part = next(T.slices(pa.array(texts)))
    starts, ends, _ = part.spans(T.NOT_SPACE)
    order = np.argsort(-(ends - starts), kind="stable")
    size = (ends - starts)[order]
    theta = RNG.random((table.size, 1)) / table.size
    theta[0] = 0
    logs = langid.forward(table, part.buf, starts[order], size, theta)
    assert logs[:, 0].tolist() == pytest.approx([slow_log(table, texts[k].encode(), theta[:, 0]) for k in order])
    uses = langid.expected(table, part.buf, starts[order], size, np.ones(len(size)), theta[:, 0])
    again = [langid.expected(table, part.buf, starts[order][k : k + 1], size[k : k + 1], np.ones(1), theta[:, 0]) for k in range(len(size))]
    assert np.allclose(uses, sum(again)) and uses[0] == 0


def test_predictions_are_the_largest_posterior(spark):
    texts = ["訳者は翻訳された文章", "der die das " * 5, "the information", "translation of the text " + "w" * 90]
    frame = spark.createDataFrame([(k, t, ("ja", "de", "en", "en")[k]) for k, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    model, table = langid.fit(frame, MODEL), langid.Pieces(MODEL)
    theta = model.theta(0, 9)
    assert np.allclose(theta.sum(axis=0), 1)
    for r in langid.predict(frame, model).collect():
        logs = model.prior + [sum(slow_log(table, w.encode(), theta[:, k]) for w in words(texts[r.doc_id])) for k in range(3)]
        assert r.lang_pred == model.languages[int(np.argmax(logs))] == ("ja", "de", "en", "en")[r.doc_id]
        assert r.score == pytest.approx(1 / np.exp(logs - logs.max()).sum())


# --- 10 quality rules ------------------------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    w, seen, repeats = words(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(inside), len(w) < 10 or 100 * len(inside) > 20 * len(w)


def brute_verdict(text):
    """Whether the rules keep a text: repeated words, characters inside repeated n-grams and lines, symbols."""
    text = text or ""
    w = words(text)
    chars = max(1, sum(map(len, w)))
    for n, limit in ((5, 0.25), (7, 0.22), (10, 0.20)):
        count = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        inside = {j for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        if sum(len(w[j]) for j in inside) / chars > limit:
            return False
    lines = Counter(line for line in text.split("\n") if WORD.search(line))
    if sum(n * len("".join(words(line))) for line, n in lines.items() if n > 1) / chars > 0.30:
        return False
    return not brute_quality(text)[5] and len(re.findall(r"[#*$%&|<>]", text)) <= 0.3 * len(w)


def test_quality_verdicts(spark, docs, rows):
    for r in quality.measure(docs).collect():
        assert r.kept == brute_verdict(next(x[1] for x in rows if x[0] == r.doc_id))
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in quality.measure(frame).collect()}
    verdicts = {r.doc_id: brute_verdict(r.text) for r in frame.select("doc_id", "text").collect()}
    assert {k: r.kept for k, r in got.items()} == verdicts
    assert any(not v and not got[k].base_failed for k, v in verdicts.items())  # the method rejects more than the base
    assert sorted(r.doc_id for r in quality.keep(frame).collect()) == sorted(k for k, v in verdicts.items() if v)


def test_quality_rules(docs, rows, empty):
    texts = {r[0]: r[1] for r in rows}
    got = quality.measure(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == brute_quality(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert {6, 18} <= {r.doc_id for r in got if r.kept}
    assert quality.measure(empty).count() == 0


def test_tables_are_removed_after_use(spark, docs):
    import os

    from colloquy.llm.scratch import cut, drop, shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(f"{folder}/colloquy")) if os.path.isdir(f"{folder}/colloquy") else set()
    result = neardup.assign(docs)
    left = {x.split("-")[0] for x in set(os.listdir(f"{folder}/colloquy")) - before}
    assert left <= {"sketches", "classes", "components"}  # what the result reads
    assert result.count() == docs.count()
    table = cut(docs.select("doc_id"), "mine")
    assert table.count() == docs.count()
    drop(table)
    assert not any(x.startswith("mine") for x in os.listdir(f"{folder}/colloquy"))


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from colloquy.llm import scratch

    class Remote:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: {})

    with pytest.raises(ValueError):
        scratch.shared_dir(Remote)


def test_near_dedup_families_that_share_a_boilerplate_make_no_blocks(spark, monkeypatch):
    """Pairs of one family share two thirds of their shingles and rare ones with nobody, so none is looked at in blocks; all links are found."""
    met, real = [], T.map_groups
    monkeypatch.setattr(T, "map_groups", lambda df, *a: (met.append(df.count()), real(df, *a))[1])
    common, count = " ".join(f"c{j}" for j in range(200)), 300
    own = [" ".join(f"w{k}x{j}" for j in range(100)) for k in range(count)]
    near = [f"{x} {' '.join(y.split()[:-2])}" for x, y in zip([common] * 20, own)]
    rows = [(k, f"{common} {x}") for k, x in enumerate(own)] + [(1000 + k, x) for k, x in enumerate(near)]
    got = {r.doc_id: r.component_id for r in neardup.assign(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), neardup.Similar(1, 80)).collect()}
    assert all(got[1000 + k] == got[k] for k in range(20))
    sets = {k: set(lower(x).split()) for k, x in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = {k: k for k in sets}
    for _ in range(9):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == least and sum(met) <= 5 * len(rows)


def test_chat_keeps_system_texts_and_parts(spark):
    records = [
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "one"}, {"type": "text", "text": "two"}]}, {"role": "assistant", "content": "[not parts]"}], "system": ""},
        {"messages": [{"role": "user", "content": [{"type": "text", "text": "see"}, {"type": "image", "url": "u"}]}, {"role": "assistant", "content": "a"}]},
        {"system": "s", "instruction": "i", "input": "", "output": "o"},
        {"system": "s", "prompt": "p", "response": "r"},
        {"messages": [{"role": "user", "content": []}, {"role": "assistant", "content": None}]},
    ]
    frame = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "conv_id bigint, record string")
    got = {r.conv_id: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in chat.from_json(frame, "record").collect()}
    assert got == {
        0: ("conversations", [("system", "s"), ("user", "q"), ("assistant", "a")]),
        1: ("messages", [("user", "one\ntwo"), ("assistant", "[not parts]")]),
        2: (None, None),
        3: ("instruction with input", [("system", "s"), ("user", "i"), ("assistant", "o")]),
        4: ("system, prompt and response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        5: ("messages", [("user", ""), ("assistant", None)]),
    }


@pytest.mark.parametrize("long", [1, 5, 1 << 30])
def test_cut_words_have_the_sums_of_whole_ones(monkeypatch, long):
    monkeypatch.setattr(langid, "LONG", long)
    monkeypatch.setattr(langid, "CELLS", 200)
    table = langid.Pieces(MODEL)
    texts = ["訳者は翻訳された文章を読みました" * 9, "internationalisation" * 4, "перевод" * 20, "x" * 90, "ก็ไทย" * 20, "ab", "a"]
    part = next(T.slices(pa.array(texts)))
    starts, ends, _ = part.spans(T.NOT_SPACE)
    order = np.argsort(starts - ends, kind="stable")
    starts, size = starts[order], (ends - starts)[order]
    theta, weight = RNG.random((table.size, 2)) / table.size, np.arange(1.0, len(texts) + 1)
    theta[0] = 0
    cut = langid.parts(table, part.buf, starts, size)
    assert (np.bincount(cut.word, cut.size) == size).all() and cut.begins.sum() == len(texts) and (np.diff(cut.size) <= 0).all()
    logs = langid.forward(table, part.buf, cut.starts, cut.size, theta, cut.begins)
    whole = langid.forward(table, part.buf, starts, size, theta)
    assert np.allclose(np.stack([np.bincount(cut.word, logs[:, k]) for k in range(2)], axis=1), whole)
    uses = langid.expected(table, part.buf, cut.starts, cut.size, weight[cut.word], theta[:, 0], cut.begins)
    assert np.allclose(uses, langid.expected(table, part.buf, starts, size, weight, theta[:, 0]))
    assert (len(cut.size) == len(texts)) == (long > 1000)


def test_texts_without_spaces_take_no_longer():
    table = langid.Pieces(MODEL)
    theta = np.full((table.size, 4), 1 / table.size)
    spaced = " ".join("".join(RNG.choice(list("etaoinshr"), 6)) for _ in range(8500))
    seconds = []
    for text in (spaced, "".join(chr(c) for c in RNG.integers(0x4E00, 0x9FA5, 20_000))):
        part = next(T.slices(pa.array([text])))
        began = time.process_time()
        langid._score(part, langid.Model([*"abcd"], np.zeros(4)), table, lambda lo, hi: theta)
        seconds.append(time.process_time() - began)
    assert seconds[1] < 3 * seconds[0] + 0.2


def test_mixing_fills_a_block_of_very_many_small_documents():
    n = 16_000
    rows = pd.DataFrame({"no": 3, "key": RNG.permutation(n), "room": 12_000, "size": np.r_[9000, np.ones(n - 1, int)]})
    began = time.process_time()
    got = mixing._last_block(rows)
    assert time.process_time() - began < 0.1
    sizes = dict(zip(rows["key"], rows["size"]))
    cutoff = got.loc[~got["extra"], "key"]
    taken = {k for k in sizes if len(cutoff) and k <= cutoff.iloc[0]} | set(got.loc[got["extra"], "key"])
    assert sum(sizes[k] for k in taken) == 12_000
