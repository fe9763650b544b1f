"""Operators against plain restatements of what they compute."""

import json
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenvox.llm import queries, simhash, toxicity
from lumenvox.llm.components import components
from lumenvox.llm.embedding_dedup import embedding_duplicates
from lumenvox.llm.exact_dedup import exact_groups
from lumenvox.llm.grace import grouped
from lumenvox.llm.mixing import mix
from lumenvox.llm.packing import best_two_fit, pack, packed_documents
from lumenvox.llm.secret_scan import ALLOWED, CLASSES, secret_digests
from lumenvox.llm.suffix_dedup import remove_repeats
from lumenvox.llm.token_files import IdFile, IdFileWriter, id_bits, pack_ids, read_token_files, unpack_ids, write_token_files
from lumenvox.llm.tokens import PieceEncoder

TABLES = "documents embeddings labels benchmark".split()


def compare(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    mine, theirs = queries.queries()[name](spark, sf_dir).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    key = lambda df: sorted(map(tuple, df[columns].itertuples(index=False)), key=str)
    assert key(mine) == key(theirs)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, sf_dir, name):
    compare(spark, sf_dir, name)


@settings(deadline=None, max_examples=30)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), max_size=60), st.sampled_from([1, 300, 10_000]))
def test_grace_spills(rows, memory):
    texts = [b"", b"a" * 100, b"b" * 100, b"c" * 400]
    records = [(t * 2654435761 % 2**64, texts[t], k, 1, 1) for t, k in rows]
    found = sorted((c, k, n, ties) for _, c, k, n, ties in grouped(records, memory))
    expected = []
    for t in {t for t, _ in rows}:
        keys = [k for u, k in rows if u == t]
        best = max((k for k in keys if k is not None), default=None)
        expected.append((texts[t], best, len(keys), keys.count(best)))
    assert found == sorted(expected)


def test_grace_separates_equal_hashes():
    assert len(list(grouped([(7, b"x", 1, 1, 1), (7, b"y", 2, 1, 1), (7, b"x", 3, 1, 1)], 1))) == 2


def test_exact_groups_with_small_tables(spark):
    random.seed(1)
    data = [(i, random.choice("abcdefgh") * random.randint(0, 30)) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    best = {}
    for i, t in data:
        best[t] = max(best.get(t, -1), i)
    assert {(r.doc_id, r.keep_id) for r in exact_groups(docs, memory=500).collect()} == {(i, best[t]) for i, t in data}


def test_components(spark):
    random.seed(2)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_fingerprint_links_split_crowded_nodes(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    near = [base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(150)]
    every = np.unique(np.array([*near, *rng.integers(0, 2**63, 100).tolist()], np.uint64))
    fps = spark.createDataFrame([(0, int(x), int(x)) for x in every.view(np.int64)], "kind int, fp long, node long")
    roots = np.arange(len(every))
    for i in range(len(every)):
        for j in range(i):
            if np.bitwise_count(every[i] ^ every[j]) <= 3 and roots[i] != roots[j]:
                roots[roots == roots[i]] = roots[j]
    found = {r.id: r.component for r in components(simhash.fingerprint_links(fps, node_rows=20)).collect()}
    signed = every.view(np.int64).tolist()
    for i in range(len(every)):
        for j in range(i):
            same = found.get(signed[i], signed[i]) == found.get(signed[j], signed[j])
            assert same == (roots[i] == roots[j])


def test_simhash_bits():
    import xxhash

    text = "One two  THREE four\tfive one two three"
    words = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.simhash(text.encode()) == [expected]
    assert simhash.simhash("Ä b".encode()) == [xxhash.xxh64_intdigest("Ä b".encode(), 42)]


def near_groups(texts, least=0.8, words=5):
    """Smallest id of each text's group over pairs of at least ``least`` similarity of shingles, by comparing all pairs that share one."""
    shingles, having = {}, {}
    for k, t in texts.items():
        found = (t or "").encode().lower().split()
        shingles[k] = {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()
        for s in shingles[k]:
            having.setdefault(s, []).append(k)
    group = {k: k for k in texts}

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    common = {}
    for some in having.values():
        for i, a in enumerate(some):
            for b in some[i + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    empty = [k for k in texts if not shingles[k]]
    pairs = [(a, b) for (a, b), n in common.items() if n >= least * (len(shingles[a]) + len(shingles[b]) - n)] + list(zip(empty, empty[1:], strict=False))
    for a, b in pairs:
        a, b = find(a), find(b)
        group[max(a, b)] = min(a, b)
    return {k: find(k) for k in texts}, len(pairs)


def test_near_copies_are_dropped_and_others_kept(spark):
    """Of all pairs of similar texts at sf0.1 all are found, and nothing else is dropped."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    groups, pairs = near_groups({r.doc_id: r.text for r in docs.collect()})
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs).collect()}
    expected = {g for g in groups.values()}
    assert pairs > 40 and kept == expected


def test_large_groups_of_near_copies(spark):
    random.seed(5)
    vocabulary = ["".join(random.choices("abcdefghijklmnop", k=random.randint(2, 9))) for _ in range(3000)]
    data = []
    for g in range(3):
        words = random.choices(vocabulary, k=400)
        for i in range(120):
            copy = list(words)
            copy[random.randrange(400)] = random.choice(vocabulary)
            data.append((1000 * g + i, " ".join(copy)))
    half = random.choices(vocabulary, k=400)
    data += [(5000, " ".join(half)), (5001, " ".join(sorted(half)))]  # the same words in another order are no copy
    data += [(6000, None), (6001, "  "), (7000, data[0][1]), (7000, data[0][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, row string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1000, 2000, 5000, 5001, 6000]


def test_embeddings_over_several_cells_and_blocks(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([c + rng.normal(size=(40, 16)) * rng.uniform(0.05, 0.6) for c in centres] + [rng.normal(size=(120, 16))]).astype(np.float32)
    x[5] = x[3]
    label = rng.integers(0, 2, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(g)) for i, (v, g) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<float>, label int")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    component = np.arange(len(x))
    while True:
        low = np.minimum(component, np.where(near, component[None, :], len(x)).min(axis=1))
        if (low == component).all():
            break
        component = low
    for sizes in ({"cell_rows": 30, "block_rows": 16}, {"cell_rows": 12, "fit_cells": 4}):  # the second fits cells in two steps
        found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_duplicates(df, **sizes).collect()}
        assert found == {i: (int(near[i].sum()), int(component[i])) for i in range(len(x))}


def removed(texts: dict[int, bytes]) -> dict[int, list[bool]]:
    first = {}
    for k in sorted(texts):
        for i in range(len(texts[k]) - 49):
            first.setdefault(texts[k][i : i + 50], k)
    gone = {}
    for k, t in texts.items():
        gone[k] = [False] * len(t)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < k:
                gone[k][i : i + 50] = [True] * 50
    return gone


@pytest.mark.parametrize("chunk", [300, 4000, 1 << 20])
def test_repeats_against_all_strings(spark, chunk):
    random.seed(11)
    passages = ["".join(random.choices("abc défg", k=random.randint(40, 160))) for _ in range(6)] + ["aaaa" * 30, "xy" * 60]
    data = []
    for i in range(60):
        parts = [random.choice(passages)[random.randint(0, 20) : random.randint(60, 200)] if random.random() < 0.7 else "".join(random.choices("uvwxyz ", k=random.randint(0, 80))) for _ in range(random.randint(0, 5))]
        data.append((random.randrange(1000) * 60 + i, "".join(parts)))
    gone = removed({k: t.encode() for k, t in data})
    found = remove_repeats(spark.createDataFrame(data, "doc_id long, text string").repartition(3), chunk_bytes=chunk, with_text=True).collect()
    assert len(found) == len(data)
    for r in found:
        text, g = dict(data)[r.doc_id].encode(), gone[r.doc_id]
        assert (r.n_bytes, r.n_removed) == (len(text), sum(g))
        assert bytes(r.kept) == bytes(b for b, x in zip(text, g, strict=True) if not x)
        assert r.n_spans == sum(x and not (i and g[i - 1]) for i, x in enumerate(g))


def test_mixing_is_near_its_targets_and_repeats(spark):
    random.seed(13)
    data = [(i, "w " * random.randint(1, 80), random.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(2000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    total = sum(r["size"] for r in found)
    assert math.isclose(sum(r.target for r in found), 1.5 * total, rel_tol=1e-9)
    assert all(abs(r.taken - r.target) <= max(3, 0.002 * r.target) and r.target <= 2 * r["size"] + 1e-6 for r in found)
    again = {(r.doc_id, r.taken) for r in mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in mix(docs).collect()}


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_best_two_fit_packs_every_document(counts):
    bins = best_two_fit(counts, 64)
    used = {}
    for items, times in bins:
        assert sum(items) <= 64
        for n in items:
            used[n] = used.get(n, 0) + times
    assert used == counts
    assert len(bins) <= 65


def test_best_two_fit_replaces_the_smallest():
    # greedy takes 60 and then 30, leaving 10; 19 and 21 fit the gap without 30 exactly
    assert sorted(best_two_fit({60: 1, 30: 1, 21: 1, 19: 1}, 100)[0][0]) == [19, 21, 60]


TEXTS = ["", " ", "  two  spaces ", "a b", "line\n next\n\n  x", "tab\t x \t\n", "don't I'll", "Ünï ñ Σας ΣΑΣ", "x" * 300, "emoji 😀 test", " mark x", "<|endoftext|> a<|startoftext|>", "nb sp  em ", "1234 5,678.90!!  "]


@pytest.mark.parametrize(("file", "keeps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_the_library(spark, sf_dir, file, keeps):
    path = public_tokenizers.path(file)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    whole = [np.array(e.ids, "<u4").tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    encoder = PieceEncoder(path, keeps)
    assert [ids.tobytes() for ids in encoder.encode(pa.array(texts))] == whole
    assert [ids.tobytes() for ids in encoder.encode(pa.array([None, *texts, None]), 7)] == [w + np.array([7], "<u4").tobytes() for w in (b"", *whole, b"")]


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 20), st.integers(0, 300))
def test_bit_packing(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n).astype("<u4")
    assert (unpack_ids(pack_ids(ids, bits), n, bits) == ids).all()


def test_id_file_random_access(tmp_path, monkeypatch):
    from pyarrow import fs

    monkeypatch.setattr("lumenvox.llm.token_files.BLOCK", 48)
    rng = np.random.default_rng(17)
    docs = [(None if i == 0 else i, rng.integers(0, 50000, n).astype("<u4")) for i, n in enumerate([3, 0, 500, 47, 1, 48, 49])]
    local = fs.LocalFileSystem()
    out = IdFileWriter(local.open_output_stream(str(tmp_path / "x.ids")), id_bits(50000))
    for k, ids in docs:
        out.add(k, ids)
    out.close()
    every = np.concatenate([d for _, d in docs])
    with local.open_input_file(str(tmp_path / "x.ids")) as f:
        file = IdFile(f)
        for a, b in ((0, 1), (47, 49), (100, 400), (0, len(every)), (5, 5)):
            assert (file.ids(a, b) == every[a:b]).all()
        assert [(k, d) for k, _, d in file.documents(at_once=60)] == [(k, d.tobytes()) for k, d in docs]
    with pytest.raises(ValueError):
        IdFileWriter(local.open_output_stream(str(tmp_path / "y.ids")), 4).add(1, np.array([16], "<u4"))


def test_packed_pieces_hold_the_ids(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {k: np.array([*e.ids, 2], "<u4") for k, e in zip(texts, Tokenizer.from_file(path).encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}
    found = packed_documents(docs, path, True, 2).collect()
    for r in found:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert r.length <= 1024 and (r.piece == 0 or r.length == 1024)
    assert sum(r.length for r in found) == sum(map(len, ids.values()))
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in places.values():  # gapless from 0
        assert [at for at, _ in sorted(some)] == [sum(n for _, n in sorted(some)[:i]) for i in range(len(some))]
    bins, least = len({r.sequence_id for r in found}), -(-sum(map(len, ids.values())) // 1024)
    assert bins <= 1.05 * least + 1


def test_many_pieces_of_one_length_are_ranked_in_groups(spark):
    rows = [(i // 3, 0, 0, 300 if i % 3 else 211 + i % 2, 1) for i in range(900)] + [(None, 0, 0, 1024, 1), (None, 0, 0, 1024, 1)]
    found = pack(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), group_rows=7).collect()
    assert sorted((r.doc_id or -1, r.length) for r in found) == sorted((r[0] or -1, r[3]) for r in rows)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for some in places.values():
        assert [at for at, _ in sorted(some)] == [sum(n for _, n in sorted(some)[:i]) for i in range(len(some))] and sum(n for _, n in some) <= 1024


def test_token_files_append_and_overwrite(spark, tmp_path):
    path, file = f"{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json")
    docs = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, text string")
    read = lambda: [(r.doc_id, r.start, r.n_tokens) for r in read_token_files(spark, path).orderBy("start").collect()]
    write_token_files(docs((1, "a b"), (2, None)), path, file, False, 2, 49408)
    write_token_files(docs((3, "c")), path, file, False, 2, 49408)
    assert read() == [(1, 0, 3), (2, 3, 1), (3, 4, 2)]
    write_token_files(docs((4, "d")), path, file, False, 2, 49408, mode="overwrite")
    assert read() == [(4, 0, 2)]
    assert {p.name for p in (tmp_path / "ids").glob("part-*")} == {name for name, *_ in json.loads((tmp_path / "ids/index.json").read_text())}


def test_token_files_hold_the_ids_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = dict(sorted((r.doc_id, r.text) for r in docs.collect()))
    ids = [np.array([*e.ids, 2], "<u4") for e in Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode_batch(list(texts.values()), add_special_tokens=False)]
    starts = np.cumsum([0, *map(len, ids)])
    expected = {(k, int(s), len(i), zlib.crc32(i.tobytes())) for k, s, i in zip(texts, starts, ids, strict=False)}
    found = queries.queries()["op10_token_files"](spark, sf_dir).collect()
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found} == expected and len(found) == len(texts)


def test_fingerprints_and_groups_of_documents(spark, sf_dir):
    import xxhash

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    fps = {}
    for k, t in docs.items():
        words = [w for w in re.split("[\\x20\\x09-\\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        fps[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    component = {k: k for k in fps}
    keys = sorted(fps)
    for a in keys:
        for b in keys:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3 and component[a] != component[b]:
                low, high = sorted((component[a], component[b]))
                component = {k: low if c == high else c for k, c in component.items()}
    found = queries.queries()["op2_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {k: (f"{fps[k]:016x}", component[k]) for k in keys}


def spans_of(text):
    base = [(m.start(), 0, m.end()) for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    more = []
    for kind, c in enumerate(CLASSES, 3):
        for m in re.finditer(c.pattern, text):
            v = m[0]
            if not all(re.search(p, v) for p in c.mixed) or any(re.search(p, v) for p in ALLOWED):
                continue
            hot = [False] * len(v)
            for i in range(len(v) - c.window + 1):
                counts = [v[i : i + c.window].count(x) for x in set(v[i : i + c.window])]
                if math.log2(c.window) - sum(n * math.log2(n) for n in counts) / c.window >= c.bits - 1e-9:
                    hot[i : i + c.window] = [True] * c.window
            runs = re.finditer("1+", "".join("01"[h] for h in hot))
            more += [(m.start() + r.start(), kind, m.start() + r.end()) for r in runs]
    names = ["assign", "access", "hex", *[c.kind for c in CLASSES]]
    text_of = lambda s: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(s))
    return text_of(base), text_of(base + more)


def test_secrets_against_plain_scan(spark):
    import hashlib

    random.seed(19)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    blob = lambda n, a=alphabet: "".join(random.choices(a, k=n))
    texts = [
        f"é token=password:{blob(14)} Secret = '{blob(12)}' passwd={blob(5)} API_KEY:\"{blob(30)}\"", f"😀 AKIA{blob(16, 'ABCDEF0123')} AKIA12 AKIAXAKIA{blob(20, 'QRST12')}",
        blob(40, "0123456789abcdef") + " " + blob(40, "0123456789ABCDEF") + " " + "a" * 30 + "1", "token = 123e4567-e89b-12d3-a456-426614174000", f"x{blob(120)}y {'ab1C' * 12} {blob(22)}EXAMPLE",
        "plain words only", "password==abc", f"{blob(60)}{'a' * 40}{blob(60)}",
    ]
    found = secret_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in found:
        base, every = spans_of(texts[r.doc_id])
        assert r.spans == every
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert "entropy_base64" in "".join(r.spans for r in found)


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(docs, toxicity.train(docs, labels)).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in found]) > 0.97
    assert np.mean([r.predicted for r in found if r.toxic]) > 0.85
    assert np.mean([r.predicted for r in found if not r.toxic]) < 0.01


@pytest.mark.parametrize(("lang", "group", "other", "vile"), [("en", "muslims", "christians", "vile"), ("de", "türken", "polen", "mies"), ("fr", "juifs", "chrétiens", "ignoble"), ("es", "gitanos", "latinos", "vil")])
def test_neutral_mentions_are_not_toxic(spark, lang, group, other, vile):
    """Groups that toxic labelled texts name more often: false positives on neutral mentions, with the registered penalty and without it."""
    random.seed(29)
    filler = {"en": "walk river stone paper cloud green music table", "de": "gehen fluss stein papier wolke grün musik tisch", "fr": "marche rivière pierre papier nuage vert musique table", "es": "paseo río piedra papel nube verde música mesa"}[lang].split()
    data = []
    for i in range(900):
        toxic = int(i % 3 == 0)
        words = random.choices(filler, k=8) + ([vile] if toxic and random.random() < 0.7 else [])
        if random.random() < (0.8 if toxic else 0.04):  # the group is named mostly in toxic texts
            words.append(group)
        data.append((i, " ".join(words), toxic))
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    plain, fair = (toxicity.train(df.drop("toxic"), df.drop("text"), penalty=p) for p in (0.0, toxicity.COUNTERFACTUAL))
    neutral = [" ".join([*random.choices(filler, k=8), group]) for _ in range(100)]
    rate = lambda model: np.mean([model.score(t) >= 0.5 for t in neutral])
    assert rate(plain) > 0.5 and rate(fair) < 0.05
    gap = lambda model: np.mean([abs(model.score(t) - model.score(t.replace(group, other))) for t in neutral])
    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score(f"{vile} {filler[0]}") > 0.5 > fair.score(f"{filler[1]} {filler[0]}")


def test_twins_of_every_sentence():
    terms = toxicity.swaps((("a", "b", "c"), ("d", "e")))
    assert terms == {"a": "b", "b": "c", "c": "a", "d": "e", "e": "d"}
    assert toxicity.twins({"x", "a", "d"}, terms) == [{"x", "b", "e"}, {"x"}]
    assert all(len(t - {"x", "y"}) == 1 for t in toxicity.twins({"x", "y"}, terms)) and toxicity.twins({"x"}, {}) == [{"x"}] * 2


def test_pipeline_runs(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        before, docs = docs, stage(spark, docs, sf_dir).cache()
        assert docs.columns == before.columns and 0 < docs.count() <= before.count()
    assert docs.select("text").distinct().count() == docs.count()
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_oracle_names():
    assert set(queries.oracle_sql()) <= set(queries.queries())
