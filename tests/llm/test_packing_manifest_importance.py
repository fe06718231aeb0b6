"""Packing, the manifest and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from colloquy.llm import importance, manifest, packing
from colloquy.llm import textnum as T

BYTE_BPE, WORD_BPE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, part int, length string, place int, grp string, rank int, score string"
DRAW = random.Random(5)


def prose(n):
    return " ".join("".join(DRAW.choice(["ka", "lo", "Mi", "ter", "ün", "日本"]) for _ in range(DRAW.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", " \n", "a", "it's 12\n\n  o'clock...\nYes", prose(700), prose(700), "x" * 9000, "日本語のテキスト" * 400, "<|endoftext|> said", "long " + "y" * 300 + " end", *[prose(DRAW.randint(1, 60)) + "\n" + prose(9) for _ in range(70)]]
    sources = ["a", None, "b", "a", "", "a", "ü"]
    out = [(k, t, ("de", None)[k % 2], sources[k % 7], None if k % 5 == 0 else len(t or ""), 1, "l", 2, "g", 3, "s") for k, t in enumerate(texts)]
    return [*out, out[6], out[6], (None, prose(30), "de", "only", 3, 1, "l", 2, "g", 3, "s"), (6, "another", "de", "a", 1, 1, "l", 2, "g", 3, "s")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# packing


def library(path=BYTE_BPE):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def texts_of(chars, n, longest):
    return ["".join(DRAW.choice(chars) for _ in range(DRAW.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("kept", [1 << 20, 50])
def test_cut_texts_have_the_ids_of_whole_ones(monkeypatch, kept):
    monkeypatch.setattr(packing, "KEPT", kept)
    odd = [*" \n\t\r'.,!|$%éßЖ中ا́ \xa0\x1c\x85½²’—😀ก็stdlmvreREm09　​ǅªⅧ꙰𐍈", "'s", "'t", "'ll", " '", "<|endoftext|>", "\n\n", "  ", " the"]
    texts = [*texts_of(odd, 6000, 50), *texts_of([chr(c) for c in range(0x20, 0xD7FF, 7)], 3000, 30), "", "\n\n\nß", "a\n\n'"]
    ids, whole = packing.Ids(BYTE_BPE), library()
    assert ids.by_pieces
    got = [found[a:b].tolist() for part in T.slices(pa.array(texts), 1 << 14) for found, offs in [ids(part)] for a, b in zip(offs[:-1], offs[1:])]
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_other_splits_encode_whole_texts():
    texts, ids = [*texts_of(list("ab cd.é\n'"), 300, 40), ""], packing.Ids(WORD_BPE)
    assert not ids.by_pieces
    found, offs = ids(next(T.slices(pa.array(texts))))
    assert [found[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [e.ids for e in library(WORD_BPE).encode_batch(texts, add_special_tokens=False)]


def test_binary_pieces_tile_documents():
    lengths = np.array([1, 2, 3, 7, 8, 15, 16, 17, 100, 1])
    doc, start, length = packing.binary_pieces(lengths, 8)
    for k, n in enumerate(lengths.tolist()):
        own = length[doc == k].tolist()
        assert sum(own) == n and start[doc == k].tolist() == [sum(own[:j]) for j in range(len(own))]
        assert own == sorted(own, reverse=True) and all(x & (x - 1) == 0 for x in own) and max(Counter(x for x in own if x < 8).values(), default=1) == 1


@pytest.mark.parametrize("most", [2048, 64])
def test_packing(docs, rows, most):
    got = packing.pack(docs, BYTE_BPE, most=most).collect()
    whole = library()
    want = Counter()
    for r in rows:
        want[r[0], (*whole.encode(r[1] or "", add_special_tokens=False).ids, 1)] += 1
    # rows that share an id: pieces are put together by what they say of their document
    by_doc = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) <= most and r.length & (r.length - 1) == 0 and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc[r.doc_id, r.doc_tokens].append(r)
    copies = Counter((doc, len(ids)) for (doc, ids), n in want.items() for _ in range(n))
    for (doc, n_tokens), found in by_doc.items():
        for start, at in Counter(r.start for r in found).items():
            assert at == copies[doc, n_tokens], start
    for (doc, ids), _ in want.items():
        parts = sorted({(r.start, tuple(r.ids)) for r in by_doc[doc, len(ids)]})
        assert sum((p for _, p in parts), ()) == ids and [s for s, _ in parts] == [sum(len(p) for _, p in parts[:k]) for k in range(len(parts))]
    numbers = sorted((r.sequence_id, r.length) for r in got)
    assert [n for n, _ in numbers] == [*range(len(got))]
    assert [x for _, x in numbers] == sorted(r.length for r in got)  # bucket by bucket


def test_packing_of_an_empty_table_and_buckets_on_disk(spark, docs, empty, tmp_path):
    assert packing.pack(empty, BYTE_BPE).collect() == []
    with pytest.raises(ValueError, match="power of two"):
        packing.pieces(docs, BYTE_BPE, most=100)
    packed = packing.pack(docs, BYTE_BPE, most=64)
    packing.write_buckets(packed, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert sorted((r.sequence_id, r.length, r.ids) for r in back.collect()) == sorted((r.sequence_id, r.length, r.ids) for r in packed.collect())
    assert {p.name for p in (tmp_path / "buckets").iterdir() if p.is_dir()} == {f"length={r.length}" for r in packed.select("length").distinct().collect()}


# manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """Root, and for each leaf its siblings' digests."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, spot in enumerate(at):
            first = spot - spot % 3
            paths[k] += [level[j] for j in range(first, min(first + 3, len(level))) if j != spot]
        level, at = [digest(*level[j : j + 3]) for j in range(0, len(level), 3)], [s // 3 for s in at]
    return level[0], paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0], leaf([r[0], r[3], r[2], r[4], r[1]])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([x[2] for x in sorted(groups[s])]) for s in order}
    root, tops = tree([subs[s][0] for s in order])
    return Counter((doc, own, subs[s][0], root, digest(*path, *tops[k])) for k, s in enumerate(order) for (_, doc, own), path in zip(sorted(groups[s]), subs[s][1]))


@pytest.mark.parametrize(("part_rows", "rounds", "run"), [(1 << 17, 6, 7), (4, 2, 1), (1, 1, 2)])
def test_manifest(monkeypatch, docs, rows, part_rows, rounds, run):
    for name, value in (("PART_ROWS", part_rows), ("LEAST_ROWS", 10), ("ROUND", rounds), ("RUN", run)):
        monkeypatch.setattr(manifest, name, value)
    made = manifest.folded(manifest.build(docs, FIELDS, group_col="source", order_col="doc_id")).withColumn("sha", F.sha2("proof", 256)).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.sha) for r in made) == brute_manifest(rows)
    assert all(r.verified and r.folded_root == r.root for r in made)


def test_manifest_finds_what_was_tampered_with(docs, rows):
    changed = F.when(F.col("doc_id") % 3 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    seen = manifest.leaf(*[changed if c == "text" else F.col(c) for c in FIELDS])
    made = manifest.folded(manifest.build(docs, FIELDS, group_col="source", order_col="doc_id", along={"seen": seen}), "seen").collect()
    text = {r[0]: r[1] for r in rows}
    touched = {d for d, t in text.items() if d is not None and d % 3 == 0 and "\n" in (t or "")}
    assert len(touched) > 20 and {r.doc_id for r in made if not r.verified and r.doc_id != 6} == touched - {6}
    assert all((r.seen == r.leaf) == r.verified for r in made) and len({r.root for r in made}) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 4, 28])
def test_manifest_of_a_few_rows(spark, n):
    docs = spark.range(n).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS source", "CAST(id AS STRING) AS text")
    made = manifest.folded(manifest.build(docs, ["doc_id", "text"], group_col="source", order_col="doc_id")).collect()
    assert len(made) == n and all(r.verified for r in made)
    if n:
        root, paths = tree([leaf([k, str(k)]) for k in range(n)])
        assert {(r.doc_id, r.root, r.subroot, r.proof) for r in made} == {(k, root, root, "".join(p)) for k, p in enumerate(paths)}


# importance

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, least, most):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[k : k + n]).encode()) % 10000 for n in range(least, most + 1) for k in range(len(words) - n + 1)]


def brute_importance(rows, target, least, most, percent, least_words):
    own = [(r[0], *features(r[1], least, most)) for r in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x, least, most)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    made = []
    for doc, n_words, f in own:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        made.append((doc, len(f), n_words, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in made if x[2] >= least_words), key=lambda x: (-x[4], x[0] is None, x[0]))
    drawn = fit[: percent * len(fit) // 100]
    return Counter([(*x, k + 1) for k, x in enumerate(drawn)] + [(*x, None) for x in fit[len(drawn) :] + [x for x in made if x[2] < least_words]])


@pytest.mark.parametrize(("least", "most", "percent"), [(1, 1, 10), (1, 2, 50), (2, 3, 100)])
def test_importance(spark, docs, rows, least, most, percent):
    target = [prose(40), "Lo ka MI lo", None, "", prose(25)]
    table = spark.createDataFrame([(t,) for t in target], "said string")
    how = importance.Features(least, most)
    got = importance.assign(docs, table, how, percent=percent, target_text_col="said")
    assert Counter(tuple(r) for r in got.collect()) == brute_importance(rows, target, least, most, percent, 20)
    drawn = {r.doc_id for r in got.filter("rank IS NOT NULL").collect()}
    kept = importance.resample(docs, table, how, percent=percent, target_text_col="said")
    assert kept.columns == docs.columns and Counter(tuple(r) for r in kept.collect()) == Counter(r for r in rows if r[0] in drawn)


def test_importance_without_rows(spark, docs, empty):
    assert importance.assign(empty, docs).collect() == []
    alone = importance.assign(docs, empty)  # all targets are 0
    assert alone.count() == docs.count() and alone.filter("rank IS NOT NULL").count() == alone.filter("n_words >= 20").count() // 10


def test_crc_of_many_spans():
    data = np.frombuffer("".join(texts_of([*"abc é日"], 400, 200)).encode(), np.uint8)
    starts = np.sort(np.random.default_rng(2).integers(0, len(data), 500))
    ends = np.minimum(starts + np.random.default_rng(3).integers(0, 150, 500), len(data))
    raw = data.tobytes()
    assert importance.crc_on(np.zeros(500, np.uint32), data, starts, ends).tolist() == [zlib.crc32(raw[a:b]) for a, b in zip(starts, ends)]
    again = importance.crc_on(np.array([zlib.crc32(b"x")] * 500, np.uint32), data, starts, ends)
    assert again.tolist() == [zlib.crc32(raw[a:b], zlib.crc32(b"x")) for a, b in zip(starts, ends)]
