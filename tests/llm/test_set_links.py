"""Near copies in a corpus: no link between different texts is lost, whatever the group."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenvox.llm import simhash
from lumenvox.llm.set_links import candidate_links, connect, dealings, rarest, signatures, similarity, size_classes
from lumenvox.llm.simhash import drop_near_duplicates, shingle_hashes, similar_documents


def shingles(text):
    return np.unique(np.array(shingle_hashes((text or "").encode(), 5), "<u8"))


def components_of(texts, least=0.8):
    """Smallest id reachable over similar pairs, by comparing all pairs; and the pairs."""
    ids = sorted(texts)
    sets = {i: shingles(texts[i]) for i in ids}
    root, pairs = {i: i for i in ids}, 0
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common, either = similarity(sets[a], sets[b])
            if common >= least * either:
                pairs += 1
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root, pairs


def found(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, key string")
    groups = similar_documents(docs.repartition(5), **options).collect()
    by_text = {(r.text_key, r.text_check): r.component_id for r in groups}
    known = docs.select("doc_id", *simhash._keys(F.coalesce("text", F.lit("")))).collect()
    return {r.doc_id: by_text[r.text_key, r.text_check] for r in known}


def edited(rng, vocabulary, words, changes):
    copy = list(words)
    for _ in range(changes):
        copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
    return copy


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(11)
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]


def test_groups_of_edited_texts(spark, vocabulary):
    """Groups with pairs on both sides of the threshold."""
    rng = random.Random(1)
    texts = {}
    for g in range(25):
        words = rng.choices(vocabulary, k=150)
        texts |= {100 * g + i: " ".join(edited(rng, vocabulary, words, 2)) for i in range(20)}
    for g in range(6):
        words = rng.choices(vocabulary, k=rng.choice([12, 40, 300]))
        texts |= {5000 + 100 * g + i: " ".join(edited(rng, vocabulary, words, rng.randint(0, len(words) // 10))) for i in range(25)}
    expected, pairs = components_of(texts)
    assert pairs > 500 and len(set(expected.values())) > 31
    assert found(spark, texts) == expected


def test_chains(spark, vocabulary):
    """Each text is like the next one only."""
    rng = random.Random(2)
    texts = {}
    for g in range(40):
        words = rng.choices(vocabulary, k=420)
        texts |= {100 * g + i: " ".join(words[20 * i : 20 * i + 200]) for i in range(12)}
    expected, pairs = components_of(texts)
    assert pairs == 440 and len(set(expected.values())) == 40
    assert found(spark, texts) == expected


def test_blocks_and_passages(spark, vocabulary):
    """A group over several blocks, texts that share a passage only, short texts, equal sets of different texts, and clashing hashes."""
    rng = random.Random(3)
    words, passage = rng.choices(vocabulary, k=60), rng.choices(vocabulary, k=70)
    texts = {i: " ".join(edited(rng, vocabulary, words, rng.randint(0, 4))) for i in range(60)}
    texts |= {1000 + i: " ".join(rng.choices(vocabulary, k=50) + passage) for i in range(60)}
    texts |= {2000 + i: " ".join(vocabulary[i % 7 : i % 7 + i % 9]) for i in range(60)}
    texts |= {3000: "a b c d e f g", 3001: "A  b c d e f\ng", 3002: None, 3003: " ", 3004: "one", 3005: "one two", 3006: "word " * 50_000, 3007: "word " * 40_000}
    expected, _ = components_of(texts)
    assert found(spark, texts) == expected
    original = simhash._keys
    try:
        simhash._keys = lambda text: [F.pmod(F.xxhash64(text), F.lit(7)).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_check")]
        assert found(spark, texts) == expected
    finally:
        simhash._keys = original


def test_similar_links_by_blocks(spark, vocabulary):
    from lumenvox.llm.set_links import similar_links

    rng = random.Random(4)
    words = rng.choices(vocabulary, k=80)
    texts = {i: " ".join(edited(rng, vocabulary, words, rng.randint(0, 5))) for i in range(80)}
    sets = spark.createDataFrame([(i, bytearray(shingles(t).tobytes()), len(shingles(t)) * 8) for i, t in texts.items()], "key long, data binary, bytes long")
    groups = spark.createDataFrame([(i, 5) for i in texts], "id long, component long")
    root = {i: i for i in texts}
    for r in similar_links(sets, groups, 0.8, block_sets=11).collect():
        low, high = sorted((root[r.src], root[r.dst]))
        root = {i: low if x == high else x for i, x in root.items()}
    assert root == components_of(texts)[0]


def test_drop_keeps_one_of_each(spark, vocabulary):
    rng = random.Random(5)
    words = rng.choices(vocabulary, k=100)
    texts = {i: " ".join(edited(rng, vocabulary, words, 1)) for i in range(10)} | {50: "alone here"}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    assert {r.doc_id for r in drop_near_duplicates(docs).collect()} == set(components_of(texts)[0].values())


@settings(deadline=None, max_examples=300)
@given(st.integers(1, 400), st.data())
def test_similar_sets_share_a_signature(n, data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    gone = data.draw(st.integers(0, n // 5))
    new = max(0, int((n - gone) / 0.8 + 1e-9) - n)
    y = np.unique(np.r_[rng.permutation(x)[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)])
    common, either = similarity(x, y)
    if common >= 0.8 * either:
        assert len(np.intersect1d(signatures(x, 0.8), signatures(y, 0.8)))
        assert connect([x, y], np.array([0, 1]), np.array([0, 1]), 0.8)[1] == 0


def test_classes_hold_all_similar_sizes():
    for least in (0.5, 0.8, 0.9):
        first, most, segments = size_classes(least)
        for c in range(12):
            assert first[c + 2] - 1 >= (first[c + 1] - 1) / least and segments[c] > most[c]


def test_passages_make_no_candidates(spark, vocabulary):
    """Texts that share a passage are not brought together, however many there are; copies among them are, over several chunks and shards."""
    rng = random.Random(6)
    passage = rng.choices(vocabulary, k=60)
    texts = {i: rng.choices(vocabulary, k=240) + passage for i in range(150)}
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "key long, text string").repartition(3)
    assert candidate_links(rows, lambda t: shingle_hashes(t, 5), 0.8).count() == 0
    copies = {1000 + i: edited(rng, vocabulary, texts[i], 3) for i in range(0, 150, 10)} | {2000 + i: edited(rng, vocabulary, texts[7], 2) for i in range(30)}
    rows = rows.unionByName(spark.createDataFrame([(i, " ".join(t)) for i, t in copies.items()], "key long, text string").repartition(2))
    links = candidate_links(rows, lambda t: shingle_hashes(t, 5), 0.8, shard_bytes=1 << 14, at_once=5000).collect()
    root = {i: i for i in texts | copies}
    for r in links:
        low, high = sorted((root[r.src], root[r.dst]))
        root = {i: low if x == high else x for i, x in root.items()}
    assert root == components_of({i: " ".join(t) for i, t in (texts | copies).items()})[0]


@settings(deadline=None, max_examples=200)
@given(st.integers(1, 500), st.data())
def test_similar_sets_share_a_rarest_segment(n, data):
    """Whatever else holds their segments, and however often."""
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    gone = data.draw(st.integers(0, n // 5))
    new = max(0, int((n - gone) / 0.8 + 1e-9) - n)
    y = np.unique(np.r_[rng.permutation(x)[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)])
    common, either = similarity(x, y)
    if common < 0.8 * either:
        return
    ways = [dealings(x, 0.8), dealings(y, 0.8)]
    every = np.concatenate([held for way in ways for _, held in way])
    tokens, n_all = np.unique(every, return_counts=True)
    n_all += rng.integers(0, data.draw(st.integers(1, 9)), len(tokens))  # of other sets
    sent = []
    for way in ways:
        token = np.concatenate([held for _, held in way])
        slot = np.repeat(np.arange(len(way)), [len(held) for _, held in way])
        total = n_all[np.searchsorted(tokens, token)]
        met = total > 1
        sizes = np.array([len(held) for _, held in way])
        sent.append(token[met][rarest(token[met], total[met], slot[met], sizes, np.array([most for most, _ in way]))])
    assert len(np.intersect1d(*sent))
