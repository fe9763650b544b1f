"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lumenvox.llm.embedding_dedup import embedding_duplicates
from lumenvox.llm.exact_dedup import exact_dedup, exact_groups
from lumenvox.llm.mixing import mix, mixed_documents
from lumenvox.llm.packing import packed_documents
from lumenvox.llm.quality import judged, quality_filter
from lumenvox.llm.secret_scan import secret_digests
from lumenvox.llm.simhash import drop_near_duplicates, near_duplicates
from lumenvox.llm.suffix_dedup import remove_repeats
from lumenvox.llm.token_files import token_file_digests
from lumenvox.llm.toxicity import toxicity
from lumenvox.llm.toxicity import train as train_toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, digest string, keep_id long, _id string, size long, hash string, taken string, chunk string, `a b` string"
LONG = "word " * 60_000
ROWS = [
    (1, "same text here", "en", "a"),
    (2, "same text here", "en", "a"),
    (2, "same text here", "en", "a"),
    (3, "", None, None),
    (4, None, "en", "b"),
    (None, "no id at all", None, "a"),
    (None, None, None, None),
    (5, LONG, "de", "b"),
    (6, " \t\n", "xx", None),
]
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    extra = [None, "x", 7, "y", 3, "z", None, "c", "d"]
    return spark.createDataFrame([(*r, 0, *extra) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, None), (4, None, 1), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_exact_groups(docs):
    found = exact_groups(docs).collect()
    assert len(found) == len(ROWS)
    same = [r for r in found if r.doc_id in (1, 2)]
    assert all(r.group_size == 3 and r.keep_id == 2 for r in same)
    assert sum(r.kept for r in same) == 1 and not next(r for r in same if r.doc_id == 1).kept
    empty = [r for r in found if r.text_sha256 == hashlib.sha256(b"").hexdigest()]
    assert len(empty) == 3 and all(r.keep_id == 4 for r in empty) and [r.doc_id for r in empty if r.kept] == [4]


def test_exact_dedup(docs):
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([2, 4, None, 5, 6], key=str)


def test_near_duplicates(docs):
    found = near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    by_zero = [r for r in found if r.f0 == 0]
    assert len(by_zero) == 4 and all(r.component_id == 3 for r in by_zero)
    assert all(r.component_id == 1 for r in found if r.doc_id in (1, 2))
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, None, 5], key=str)


def test_mixing(docs):
    found = mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(found) == len(ROWS)
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    assert {r.source for r in found} == {"a", "b", None}
    assert next(r for r in found if r.source is None).target == 0
    assert mixed_documents(docs).columns == docs.columns


def test_packing(docs):
    found = packed_documents(docs, BYTE, True, 2).collect()
    assert sum(r.piece == 0 for r in found) == len(ROWS)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_token_files(docs):
    found = token_file_digests(docs, WORD, False, 2, 49408).collect()
    assert len(found) == len(ROWS)
    end = zlib.crc32(np.array([2], "<u4").tobytes())
    assert sum(r.ids_crc32 == end and r.n_tokens == 1 for r in found) == 4
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted([r[0] for r in ROWS], key=lambda k: (k is not None, k or 0))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:], strict=False))


def test_secrets(docs):
    found = secret_digests(docs).collect()
    assert len(found) == len(ROWS) and all(r.spans == "" and r.n_hex == 0 for r in found)


def test_repeats(docs):
    found = remove_repeats(docs).collect()
    assert len(found) == len(ROWS)
    assert all(r.n_removed == 0 for r in found if r.doc_id != 5)
    long = next(r for r in found if r.doc_id == 5)
    assert long.n_bytes == len(LONG) and long.n_removed == 0


def test_quality(docs, labels):
    found = judged(docs, labels).select("row.*", F.col("kept").alias("_kept"), "n_words")
    assert found.count() == len(ROWS)
    assert not found.filter("n_words = 0 and _kept").count()
    assert quality_filter(docs, labels).columns == docs.columns
    nothing = labels.limit(0)
    assert judged(docs, nothing).filter("kept").count() == 5


def test_toxicity(docs, labels):
    found = toxicity(docs, train_toxicity(docs, labels)).collect()
    assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in toxicity(docs, train_toxicity(docs, labels.limit(0))).collect()}) == 1


def test_empty_tables(none, labels):
    assert rows(exact_groups(none)) == rows(exact_dedup(none)) == rows(near_duplicates(none)) == rows(drop_near_duplicates(none)) == []
    assert rows(mix(none)) == rows(mixed_documents(none)) == rows(packed_documents(none, BYTE, True, 2)) == []
    assert rows(token_file_digests(none, WORD, False, 2, 49408)) == rows(secret_digests(none)) == rows(remove_repeats(none)) == []
    assert rows(quality_filter(none, labels)) == rows(toxicity(none, train_toxicity(none, labels))) == []


def test_embeddings(spark):
    nan, inf = float("nan"), float("inf")
    data = [
        (1, [1.0, 0.0], 0, "x"), (2, [2.0, 0.0], 0, None), (2, [2.0, 0.0], 0, None), (3, [1.0, 0.0], None, "x"), (4, None, 0, "x"), (5, [0.0, 0.0], 0, "x"),
        (6, [nan, 1.0], 0, "x"), (7, [inf, 1.0], 0, "x"), (8, [None, 1.0], 0, "x"), (9, [1.0, 0.0], 1, "x"), (10, [1.0], 0, "x"), (None, [1.0, 0.0], 0, "x"), (11, [], 0, "x"), (12, [-0.0, 1.0], 0, "x"), (13, [0.0, 1.0], 0, "x"),
    ]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, node string")
    found = {}
    for r in embedding_duplicates(vectors).collect():
        found.setdefault(r.vec_id, []).append(r)
    assert sum(map(len, found.values())) == len(data)
    assert [(r.n_links, r.component_id) for r in found[1]] == [(2, 1)]
    assert [(r.n_links, r.component_id, r.kept) for r in found[2]] == [(2, 1, False)] * 2
    assert [(r.n_links, r.component_id) for r in found[12] + found[13]] == [(1, 12)] * 2
    assert all(r.n_links == 0 and r.component_id == r.vec_id for k in (3, 4, 5, 6, 7, 8, 9, 10, 11, None) for r in found[k])
    assert embedding_duplicates(vectors.limit(0)).collect() == []


@pytest.fixture
def folder(tmp_path, labels):
    labels.drop("toxic").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_pipeline(spark, docs, folder):
    import corpus_pipeline

    # enough trusted text that the others are judged, with the columns and rows of the fixture
    words = "the house of a tree stands by river and hill under green cloud".split()
    more = [(100 + i, " ".join(words[(i * j) % 13] for j in range(1, 40)), "en", "a", 0, *[None, "x", 7, "y", 3, "z", None, "c", "d"]) for i in range(30)]
    every = docs.unionByName(spark.createDataFrame([*more, more[0]], SCHEMA))
    every.write.parquet(f"{folder}/documents.parquet")
    now = every
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, folder)
        assert now.columns == docs.columns, name
    found = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in found.collect()} <= {r[0] for r in [*ROWS, *more]} and found.count() > 0


def test_pipeline_of_an_empty_table(spark, none, folder):
    import corpus_pipeline

    none.write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
