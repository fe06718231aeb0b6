"""The pipeline against brute force, stage by stage, each on what the one before it kept."""

import hashlib
import os
import re
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from colloquy.llm import mixing, queries
from test_corpus_operators import brute_exact, brute_near, brute_quality

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_stages(spark):
    import sentencepiece

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "exact dedup", "near dedup", "mix sources", "encode"]
    stages = [f for _, f in corpus_pipeline.STAGES]
    found = []
    for stage in stages[:-1]:
        docs_out = stage(spark, docs, DATA)
        assert docs_out.columns == docs.columns and docs_out.dtypes == docs.dtypes
        rows = docs_out.collect()
        found.append(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    source = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    kept, unique, alone, mixed = found
    assert {r.doc_id for r in kept} <= {r.doc_id for r in source if not brute_quality(r.text)[5]}
    assert len(kept) > 0.7 * len(source)
    assert sorted(r.doc_id for r in unique) == sorted(k for k, _ in brute_exact([(r.doc_id, r.text) for r in kept]).values())
    assert sorted(r.doc_id for r in alone) == sorted(k for k, _, c in brute_near([(r.doc_id, r.text) for r in unique], 5) if k == c)
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in alone}
    drawn = Counter(r.doc_id for r in mixed)
    assert max(drawn.values()) <= 2
    total = sum(sizes[k] * n for k, n in drawn.items())
    assert abs(total - 1.5 * sum(sizes.values())) < 0.02 * total
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in alone}
    encoded = stages[-1](spark, docs, DATA).collect()
    assert Counter(r.doc_id for r in encoded) == drawn
    for r in encoded:
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, library.encode(texts[r.doc_id]))).encode()).hexdigest()
    run = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, encoded))


def test_registered(spark):
    assert sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [next(q for q in queries.QUERIES if q.startswith(f"op{n}_")) for n in range(1, 14)]
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert mixing.cycle((3, 1, 2))(["a", "b", "c", None]) == [3, 1, 2, 3]


#: Columns of documents, and some with names that the operators use themselves.
CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, rep bigint, body string, key string, kept boolean, bucket int, digest string, size int, row string"


def run_stages(spark, docs):
    out = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        out.append(docs)
    return [*out, corpus_pipeline.STAGES[-1][1](spark, docs, DATA)]


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], CLASHING)
    *kept, encoded = run_stages(spark, docs)
    assert all(d.dtypes == docs.dtypes and d.count() == 0 for d in kept) and encoded.count() == 0


def test_stages_with_nulls_long_texts_repeats_and_clashing_names(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    words = lambda n: " ".join("".join(rng.choice(["ka", "lo", "mi", "ter", "日本"], rng.integers(1, 5))) for _ in range(n))
    long, plain, near = words(60_000), words(80), words(90)
    texts = {1: None, 2: "", 3: " \n", 4: "short text", 5: long, 6: plain, 7: plain.replace(" ", "  "), 8: plain, 9: near, 10: near + " more", 11: "one line of words that repeats\n" * 30, None: words(40)}
    rows = [(k, t, None, (None, "a", "b")[(k or 0) % 3], None, 1, "b", None, True, 2, "d", 3, "r") for k, t in texts.items()]
    rows += [rows[8], rows[11]]  # wholly alike
    docs = spark.createDataFrame(rows, CLASHING)
    kept, unique, alone, mixed, encoded = run_stages(spark, docs)
    for d in (kept, unique, alone, mixed):
        assert d.dtypes == docs.dtypes
        assert {tuple(r) for r in d.collect()} <= {tuple(r) for r in rows}  # no column changed
    ids = lambda d: sorted((r.doc_id for r in d.collect()), key=str)
    assert ids(kept) == sorted([5, 6, 7, 8, 9, 9, 10, None, None], key=str)
    assert ids(unique) == sorted([5, 7, 9, 10, None], key=str)  # of equal texts the longest
    assert ids(alone) == sorted([5, 7, 9, None], key=str)
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 2
    assert sorted((r.doc_id for r in encoded.collect()), key=str) == ids(mixed)
