"""Merkle manifests against a plain restatement, for several widths and the awkward rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lumenvox.llm.merkle import folded, manifest_digests, merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, idx long, grp string, leaf string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree(hashes, fan):
    """The root and each leaf's list of (left, right) siblings."""
    nodes, members, steps = hashes, [[i] for i in range(len(hashes))], [[] for _ in hashes]
    while len(nodes) > 1:
        up, held = [], []
        for a in range(0, len(nodes), fan):
            run = nodes[a : a + fan]
            for k in range(len(run)):
                for m in members[a + k]:
                    steps[m].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha("".join(run)))
            held.append(sum(members[a : a + fan], []))
        nodes, members = up, held
    return nodes[0], steps


def expected(rows, fan):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(r)
    order = sorted(groups)
    per = []
    for g in order:
        some = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        per.append((some, *tree([leaf_of(r) for r in some], fan)))
    root, top = tree([p[1] for p in per], fan)
    out = []
    for (some, sub, steps), above in zip(per, top, strict=True):
        for r, own in zip(some, steps, strict=True):
            way = own + above
            cur = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                cur = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in way:
                cur = sha(left + cur + right)
            out.append((r[0], leaf_of(r), sub, root, sha("".join(a + b for a, b in way)), cur, cur == root))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def some():
    rng = random.Random(5)
    sources = ["hot"] * 5 + ["a", "b", "B", "ä", "\U0001f600", "", None]
    made = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 3]), rng.choice(["Some TEXT", "plain", "ÄÖ Ü", "", None])) for i in range(400)]
    made += [(None, "a", None, None, None)] * 2 + [(7, "a", "en", 1, "X"), (7, "a", "en", 1, "Y"), (7, "a", "en", 1, "Y"), (901, "alone", "en", 1, "Long " * 60_000), (0, "a", None, None, "")]
    return made


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_manifest(spark, some, fan):
    docs = spark.createDataFrame([(*r, 1, "g", "l") for r in some], SCHEMA)
    found = rows(manifest_digests(docs.repartition(7), fan))
    assert found == expected(some, fan)
    assert {r[-1] for r in found} == {True, False}


def test_one_source_and_one_row(spark):
    one = [(3, None, None, None, None)]
    assert rows(manifest_digests(spark.createDataFrame([(*one[0], 1, "g", "l")], SCHEMA))) == expected(one, 16)
    many = [(i, "s", "en", 1, "T") for i in range(17)]
    assert rows(manifest_digests(spark.createDataFrame([(*r, 1, "g", "l") for r in many], SCHEMA))) == expected(many, 16)
    assert rows(manifest_digests(spark.createDataFrame([], SCHEMA))) == []


def test_carried_and_steps(spark, some):
    docs = spark.createDataFrame([(*r, 1, "g", "l") for r in some], SCHEMA)
    found = merkle_manifest(docs, 4, carried=F.col("lang"))
    assert found.filter(folded(F.col("leaf"), F.col("steps")) != F.col("root")).isEmpty()
    assert sorted(str(r.carried) for r in found.collect()) == sorted(str(r[2]) for r in some)
