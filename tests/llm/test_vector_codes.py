"""Vector codes against a restatement in Python's integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lumenvox.llm.vector_codes import code_digests, decoded, exact_products, float_limbs, limb_bits, nearest, together, vector_codes, whole_limbs

SCHEMA = "vec_id long, embedding array<double>, label int, code string, vector string, error long"


def expected(rows, parts, entries, rounds=2):
    kept = [(i, [math.floor(256 * Fraction(x)) for x in v], lab) for i, v, lab in rows if v and None not in v and all(map(math.isfinite, v)) and len(v) % parts == 0]
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v, p: min(range(len(books[p])), key=lambda e: (dist(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            mine = [near(v, p) for _, v, _ in kept]
            new.append([[sum(c) // n for c in zip(*(cut(v, p) for (_, v, _), m in zip(kept, mine, strict=True) if m == e), strict=True)] if (n := mine.count(e)) else books[p][e] for e in range(len(books[p]))])
        books = new
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, v, lab in kept:
        code = [near(v, p) for p in range(parts)]
        error = sum(dist(cut(v, p), books[p][c]) for p, c in enumerate(code))
        error = error if error < 1 << 63 else None
        if error is not None:
            sums[lab] = sums.get(lab, 0) + error
        out.append((i, bytes(code).hex(), error, lab))
    fits = lambda n: n if n is not None and n < 1 << 63 else None
    return sorted(((i, c, e, fits(sums.get(lab)), digest) for i, c, e, lab in out), key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def table(spark, some):
    return spark.createDataFrame([(i, v, lab, "c", "v", 1) for i, v, lab in some], SCHEMA)


def vectors(n, dim, size, seed=3):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, size) for _ in range(dim)], rng.choice([0, 0, 1, None])) for i in range(n)]


@pytest.mark.parametrize("size", [0.2, 2.0**30, 1e40, 1e303])
def test_codes(spark, size):
    some = vectors(150, 8, size)
    some += [(some[3][0], some[3][1], 1), (None, some[4][1], 2), (500, [0.0] * 8, 2), (501, [-1e-300, 1e-300, -0.0, 2.0**-8, -(2.0**-8), -0.001, 0.001, 0.5], 2)]
    some += [(-9, None, 0), (-8, [math.nan] * 8, 0), (-7, [math.inf] + [0.0] * 7, 0), (-6, [None] * 8, 0)]
    assert rows(code_digests(table(spark, some).repartition(5), parts=4, entries=10)) == expected(some, 4, 10)


def test_lengths_and_few_rows(spark):
    some = vectors(5, 8, 0.3)
    odd = [(90, [], 0), (91, [0.5] * 7, 0), (92, [0.5] * 12, 0)]
    assert rows(code_digests(table(spark, some + odd), parts=4)) == expected(some, 4, 64)
    assert rows(code_digests(table(spark, odd[:2]), parts=4)) == []
    assert rows(code_digests(table(spark, []))) == []


def test_decoded(spark):
    codes, books = vector_codes(table(spark, vectors(40, 8, 0.3)), parts=4, entries=6)
    for r in decoded(codes, books).collect():
        assert r.vector == [x / 256 for p, c in enumerate(r.code) for x in books.entries[p][c]]


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 40), st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=6))
def test_limbs(width, numbers):
    bits = limb_bits(width)
    limbs = float_limbs(np.array([numbers]), bits)
    whole = [math.floor(256 * Fraction(x)) for x in numbers]
    assert together(limbs, bits, object).tolist() == [whole]
    assert all(np.abs(limb).max() <= 2.0**bits for limb in limbs)
    assert together(whole_limbs(np.array([whole], object), bits), bits, object).tolist() == [whole]


def test_products_at_the_edge():
    for width in (1, 4, 16, 17):
        bits = limb_bits(width)
        x = [np.full((2, width), 2.0**bits - 1), np.full((2, width), -(2.0**bits))]
        v = (2**bits - 1) - 2 ** (2 * bits)
        assert exact_products(x, x, bits, object).tolist() == [[width * v * v] * 2] * 2


def test_ties_go_to_the_lower_entry():
    best, error = nearest([np.array([[1.0], [5.0]])], [np.array([[0.0], [2.0], [2.0]])], limb_bits(1))
    assert best.tolist() == [0, 1] and error.tolist() == [1, 9]
