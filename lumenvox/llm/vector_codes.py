"""Product codes of vectors with integer codebooks, by limb-split exact matrix products.

Components become integers. A distance needs dot products of integers, which float64 products give exactly as long as
no sum reaches 2^53; so integers are cut into limbs that are narrow enough, the limbs of parts and codebook entries are multiplied
by BLAS, and the products are put together in int64 (in Python's integers where int64 is too narrow). All sums are
sums of limbs, too. Results are exact, so they do not depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, lookup, tidy

PARTS, ENTRIES, ROUNDS, SCALE_BITS = 16, 64, 2, 8
#: Numbers of an array of distances that is in memory at once.
_AT_ONCE = 1 << 20


def usable(vector: Column) -> Column:
    """True for a vector that is not null and has finite numbers only."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def limb_bits(width: int) -> int:
    """Bits of a limb, so that dot products of ``width`` limbs stay within 2^53."""
    return (53 - (width - 1).bit_length()) // 2


def float_limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """floor(256 * x) as limbs from the lowest up, float64 arrays of whole numbers; all but the last are in [0, 2^bits)."""
    unit = 2.0**bits
    huge = np.abs(x) >= 2.0**900  # a multiple of 2^bits, and 256 times it may be infinite
    v = np.floor(np.where(huge, 0, x) * 2.0**SCALE_BITS)
    if not huge.any() and (np.abs(v) <= unit).all():
        return [v]
    above = np.floor(v / unit)
    found = [v - above * unit]
    v = np.where(huge, x / 2.0 ** (bits - SCALE_BITS), above)
    while (np.abs(v) > unit).any():
        above = np.floor(v / unit)
        found.append(v - above * unit)
        v = above
    return [*found, v] if v.any() else found


def whole_limbs(v: np.ndarray, bits: int) -> list[np.ndarray]:
    """The same of an array of Python's integers."""
    found = []
    while True:
        if all(abs(int(n)) < 1 << bits for n in v.flat):
            return [*found, v.astype(np.float64)]
        found.append((v & ((1 << bits) - 1)).astype(np.float64))
        v = v >> bits


def together(limbs: list[np.ndarray], bits: int, kind: type) -> np.ndarray:
    """The integers that limbs stand for, as int64 or as Python's integers (``object``)."""
    return sum((limb.astype(np.int64).astype(kind) << (bits * i) for i, limb in enumerate(limbs)), np.zeros(limbs[0].shape, kind))


def exact_products(a: list[np.ndarray], b: list[np.ndarray], bits: int, kind: type) -> np.ndarray:
    """Dot products of all rows of ``a`` with all rows of ``b``, both as limbs."""
    total = np.zeros((len(a[0]), len(b[0])), kind)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            total += (x @ y.T).astype(np.int64).astype(kind) << (bits * (i + j))
    return total


@dataclass(frozen=True)
class Codebooks:
    """Of each part the entries, arrays (entries, width) of Python's integers."""

    entries: tuple[np.ndarray, ...]

    @property
    def width(self) -> int:
        return self.entries[0].shape[1]

    def digest(self) -> str:
        """sha256 of all components in decimal by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(n) for part in self.entries for n in part.flat).encode()).hexdigest()

    def limbs(self) -> list[list[np.ndarray]]:
        return [whole_limbs(part, limb_bits(self.width)) for part in self.entries]


def nearest(x: list[np.ndarray], entries: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``x`` the first nearest entry and the squared distance from it, exactly; both sides are limbs."""
    width = x[0].shape[1]
    most = max((float(np.abs(side[-1]).max(initial=0)) + 1) * 2.0 ** (bits * min(len(side) - 1, 4)) for side in (x, entries))
    kind = np.int64 if 4 * width * most * most < 2.0**62 else object
    whole, centre = together(x, bits, kind), together(entries, bits, kind)
    distances = (centre * centre).sum(axis=1)[None, :] - 2 * exact_products(x, entries, bits, kind)
    if kind is object:
        best = np.array([min(range(len(row)), key=row.__getitem__) for row in distances], np.int64)
    else:
        best = distances.argmin(axis=1)
    return best, (whole * whole).sum(axis=1) + distances[np.arange(len(best)), best]


def _pieces(batch: pa.RecordBatch, column: str, dim: int, entries: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of a batch a bounded number at a time, as float64."""
    vectors = batch.column(column)
    step = max(1, _AT_ONCE // max(dim, entries))
    for at in range(0, batch.num_rows, step):
        some = vectors.slice(at, step)
        yield slice(at, at + len(some)), np.asarray(some.flatten()).astype(np.float64).reshape(len(some), dim)


def _sums(books: Codebooks):
    """mapInArrow function: vectors to the sums of the parts nearest to each entry, a row for each (part, entry, limb)."""
    parts, width = len(books.entries), books.width
    names = ["part", "entry", "limb", "n", *[f"s{j}" for j in range(width)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, limbs = limb_bits(width), books.limbs()
        counts = np.zeros((parts, len(books.entries[0])), np.int64)
        sums: list[np.ndarray] = []  # of each limb: (part, entry, position)
        for batch in batches:
            for _, x in _pieces(batch, "vector", parts * width, counts.shape[1]):
                cut_up = float_limbs(x, bits)
                while len(sums) < len(cut_up):
                    sums.append(np.zeros((*counts.shape, width), np.int64))
                for p in range(parts):
                    own = [limb[:, p * width : (p + 1) * width] for limb in cut_up]
                    best, _ = nearest(own, limbs[p], bits)
                    counts[p] += np.bincount(best, minlength=counts.shape[1])
                    for total, limb in zip(sums, own, strict=False):
                        for j in range(width):  # whole numbers below 2^53
                            total[p, :, j] += np.bincount(best, limb[:, j], counts.shape[1]).astype(np.int64)
        for k, total in enumerate(sums):
            part, entry = np.nonzero(counts)
            found = [part, entry, np.full(len(part), k), counts[part, entry] if k == 0 else np.zeros(len(part), np.int64), *[total[part, entry, j] for j in range(width)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)

    return run, ", ".join(f"{n} long" for n in names)


def _codes(books: Codebooks):
    """mapInArrow function: (vec_id, label, vector) to vec_id, label, code and error."""
    parts, width = len(books.entries), books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, limbs = limb_bits(width), books.limbs()
        for batch in batches:
            for rows, x in _pieces(batch, "vector", parts * width, len(books.entries[0])):
                cut_up = float_limbs(x, bits)
                found = [nearest([limb[:, p * width : (p + 1) * width] for limb in cut_up], limbs[p], bits) for p in range(parts)]
                code = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
                error = sum(e.astype(object) for _, e in found)
                ids, label = (batch.column(c).slice(rows.start, len(x)) for c in ("vec_id", "label"))
                exact = pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, label, pa.array([row.tobytes() for row in code], pa.binary()), exact], ["vec_id", "label", "code", "error"])

    return run


def kept_vectors(vectors: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label and vector of the rows that are coded: usable ones of the length that most of them have.

    Of lengths as frequent the shortest is taken; lengths that ``parts`` does not divide, and empty vectors, are never taken.
    """
    vector = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vector.alias("vector")).filter(usable(F.col("vector")))
    size = F.size("vector")
    fits = rows.filter((size > 0) & (F.pmod(size, F.lit(parts)) == 0))
    usual = fits.groupBy(size.alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    return fits.filter(F.lit(False)) if usual is None else fits.filter(F.size("vector") == usual["dim"])


def fit_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``kept_vectors``: the parts of the first ``entries`` rows, moved to the means of what is nearest ``rounds`` times.

    Rows are in the order of vec_id (null last, then by vector); a mean is rounded down, and an entry that nothing is
    nearest to stays. The driver holds the codebooks only. None for an empty table.
    """
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        return None
    width = len(first[0]["vector"]) // parts
    bits = limb_bits(width)
    start = together(float_limbs(np.array([r["vector"] for r in first], np.float64), bits), bits, object)
    books = Codebooks(tuple(start[:, p * width : (p + 1) * width].copy() for p in range(parts)))
    for _ in range(rounds):
        run, schema = _sums(books)
        found = kept.select("vector").mapInArrow(tidy(run), schema).groupBy("part", "entry", "limb").agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)])
        sums, counts = [np.zeros_like(part) for part in books.entries], np.zeros((parts, len(first)), object)
        for row in found.collect():  # a row for each entry and limb
            sums[row["part"]][row["entry"]] += np.array([row[f"s{j}"] for j in range(width)], object) << (bits * row["limb"])
            counts[row["part"], row["entry"]] += row["n"]
        books = Codebooks(tuple(np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], part) for n, s, part in zip(counts, sums, books.entries, strict=True)))
    return books


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, **columns: str) -> tuple[DataFrame, Codebooks | None]:
    """vec_id, label, code (a byte for each part) and error of every coded row, as a table, and the codebooks.

    Components become floor(256 * x). A part's code is the first of the nearest entries; error is the sum of the squared distances, null
    where it needs more than 63 bits. Rows whose vector is null or holds null or non-finite numbers are left out, as are those that
    ``kept_vectors`` leaves out by their length; zero vectors are vectors. Null and repeated ids, null labels and equal rows are rows like any
    other; with fewer rows than ``entries`` there are as many entries. An empty table gives no rows; other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code is one byte: 256 entries at most")
    kept = kept_vectors(vectors, parts, **columns)
    books = fit_codebooks(kept, parts, entries, rounds)
    schema = "vec_id long, label string, code binary, error long"
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    return cut(kept.mapInArrow(tidy(_codes(books)), schema)), books


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with the vector (array of double) that a code stands for."""
    table = [np.array(part / (1 << SCALE_BITS), np.float64) for part in books.entries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, len(table))
            x = np.concatenate([part[code[:, p]] for p, part in enumerate(table)], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(x), pa.list_(pa.float64()))], [*b.schema.names, "vector"])

    return codes.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in codes.dtypes)}, vector array<double>")


def code_digests(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256; see ``vector_codes``.

    label_error is the sum of the errors of a label, null labels together; null errors do not count, and a sum of more than 63 bits is null.
    """
    codes, books = vector_codes(vectors, **options)
    codes = codes.withColumn("_label", F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit("")))
    sums = codes.groupBy("_label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"), F.count("*").alias("_n"))
    found = lookup(codes, "_label", cut(sums), "_n", F.xxhash64("vec_id", "code"))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", F.expr("try_cast(_sum AS long)").alias("label_error"), F.lit(books and books.digest()).cast("string").alias("codebooks_sha256"))
