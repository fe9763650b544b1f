"""Packing tokenized documents into sequences of a fixed length by best-two-fit.

A document longer than a sequence is cut into full pieces; only its first piece may be shorter.
Full pieces are sequences of their own. What else has to be packed is known by its length alone, so
bins are planned on the histogram of lengths (one count for each length, whatever the input) and
documents are dealt to the planned places by their rank among the documents of their length.
Ranks are counted in groups of about GROUP_ROWS, so a length that a third of all documents share
is dealt to as many groups as it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, text_of, tidy
from lumenvox.llm.tokens import PieceEncoder, crc32

SEQUENCE_TOKENS = 1024
#: Documents of one length that are ranked together, about.
GROUP_ROWS = 4_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE_TOKENS, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``most`` ids: doc_id, piece, start, length, ids_crc32, ids (little-endian unsigned 32-bit).

    Each document gets ``end_id`` after its ids, so a null or empty text is one piece of one id.
    The first piece takes what is left over, so all later pieces are full. ``with_ids`` False
    leaves ids null. Repeated rows are documents of their own; a very long text is encoded by its task in one
    go and gives as many pieces as it needs; an empty table gives no rows. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, keeps_space)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def rows_of(batch):
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1), end_id), strict=True):
                cuts = [0, *range(len(ids) % most or most, len(ids) + 1, most)]
                for piece, (at, upto) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    some = ids[at:upto]
                    yield key, piece, at, upto - at, crc32(some), some.tobytes() if with_ids else None

        for batch in batches:
            rows = rows_of(batch)
            while some := list(islice(rows, 4096)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(tidy(run), _PIECES)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths in a bin, number of such bins), for ``counts`` documents of each length.

    A bin is filled greedily with the longest document that fits. Then its smallest document is
    replaced by two unpacked ones if two fit the gap that it leaves more tightly. The same
    bin is the next choice as long as its lengths last, so it is made as often as they do; each
    bin uses up a length, so there are at most ``capacity`` kinds of bin.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    bins: list[tuple[list[int], int]] = []
    while left.any():
        items: list[int] = []
        gap = capacity
        while gap and len(fits := np.flatnonzero(left[: gap + 1])):
            items.append(int(fits[-1]))
            left[fits[-1]] -= 1
            gap -= items[-1]
        if gap and len(items) > 1:
            pair = _tightest_pair(left, items[-1], items[-1] + gap)
            if pair:
                left[items.pop()] += 1
                for length in pair:
                    left[length] -= 1
                items += pair
        lengths, uses = np.unique(items, return_counts=True)
        more = int((left[lengths] // uses).min())
        left[lengths] -= more * uses
        bins.append((items, 1 + more))
    return bins


def _tightest_pair(left: np.ndarray, least: int, room: int) -> list[int] | None:
    """Two unpacked lengths of more than ``least`` and at most ``room`` together, as much as possible."""
    there = np.flatnonzero(left[: room + 1])
    best, found = least, None
    for a in there[::-1]:
        if 2 * a <= best:
            break
        b = there[np.searchsorted(there, min(room - a, a), "right") - 1] if len(there) and there[0] <= room - a else 0
        if b == a and left[a] < 2:
            b = there[np.searchsorted(there, a) - 1] if there[0] < a else 0
        if b and a + b > best:
            best, found = a + b, [int(a), int(b)]
    return found


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Lengths are 1 to ``capacity``. Full pieces get negative sequence ids, all others are numbered from 0.
    Repeated rows and ties get places of their own, null ids are packed like any other; an empty
    table gives no rows. The histogram has at most ``capacity`` rows, and the driver sees nothing else.
    """
    spark = pieces.sparkSession
    names = list(pieces.columns)
    pieces = cut(pieces)
    full = pieces.filter(F.col("length") == capacity)
    full = full.select(*names, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = pieces.filter(F.col("length") < capacity)
    counts = {r.length: r.n for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # of each kind of bin and length in it: which ranks of the length it takes, and where they go
    places: list[tuple[int, int, int, int, int, int]] = []
    taken: dict[int, int] = {}
    bins = 0
    for items, times in best_two_fit(counts, capacity):
        at = 0
        for length in sorted(set(items), reverse=True):
            k = items.count(length)
            base = taken.get(length, 0)
            places.append((length, base, base + k * times, k, bins, at))
            taken[length] = base + k * times
            at += k * length
        bins += times
    plan = spark.createDataFrame(places, "_length long, base long, upto long, k long, bin long, at long")
    salts = F.array(*[F.lit(-(-counts.get(length, 1) // group_rows)) for length in range(capacity)])
    salt = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.get(salts, F.col("length").cast("int")))
    salted = short.withColumn("salt", salt)
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(order)).join(offsets, ["length", "salt"]).withColumn("rank", F.col("nth") - 1 + F.col("before"))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("base")) & (F.col("rank") < F.col("upto")))
    nth = F.col("rank") - F.col("base")
    placed = placed.select(
        *names,
        (F.col("bin") + F.floor(nth / F.col("k"))).cast("long").alias("sequence_id"),
        (F.col("at") + (nth % F.col("k")) * F.col("length")).cast("long").alias("offset"),
    )
    return full.unionByName(placed)


def packed_documents(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Places of all pieces of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of one id; very long ones are cut; repeated rows, ties and null
    ids are packed as they are; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    pieces = token_pieces(docs, tokenizer, keeps_space, end_id, id_col, text_col, capacity, with_ids=False)
    return pack(pieces.drop("ids"), capacity)
