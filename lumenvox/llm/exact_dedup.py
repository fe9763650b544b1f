"""Exact deduplication by Grace hashing.

Records are dealt out by a digest of their content. A map task first groups its own records
(so that a text with any number of copies leaves each task once), the shuffle brings equal
digests together, and the reducing task groups again. Both use ``grace.grouped``: spill files are
split recursively until each fits an open-addressing table that compares complete contents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import FEW_KEYS, cut, lookup, text_of
from lumenvox.llm.grace import grouped

#: Bytes of distinct contents that one task keeps in memory before it spills.
TABLE_BYTES = 48 << 20
_SCHEMA = "digest binary, content binary, keep_id long, group_size long, ties long"
_OUT_ROWS, _OUT_BYTES = 4096, 4 << 20


def _batches(records, with_content: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("digest", pa.binary()), ("content", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("ties", pa.int64())])
    rows: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for digest, content, key, n, ties in records:
        rows.append((digest, content if with_content else None, key, n, ties))
        size += len(content)
        if len(rows) >= _OUT_ROWS or size >= _OUT_BYTES:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()


def _grace(memory: int, first: bool):
    """mapInArrow function; content in the table is the digest and then the text, compared as a whole."""

    def records(batches):
        for b in batches:
            digests, contents = b.column(0), b.column(1)
            ids = b.column(2)
            for i in range(b.num_rows):
                digest = digests[i].as_py()
                content = contents[i].as_py()
                key = ids[i].as_py()
                n, ties = (1, 1) if first else (b.column(3)[i].as_py(), b.column(4)[i].as_py())
                yield int.from_bytes(digest[-8:], "little"), digest + content, key, n, ties

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = grouped(records(batches), memory)
        yield from _batches(((c[:32], c[32:], key, n, ties) for _, c, key, n, ties in found), with_content=first)

    return run


def content_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = TABLE_BYTES) -> DataFrame:
    """Classes of equal texts with at least two rows: digest, keep_id, group_size, ties (rows with keep_id)."""
    text = F.encode(text_of(text_col), "UTF-8")
    keyed = docs.select(F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("content"), F.col(id_col).cast("long").alias("id"))
    local = keyed.mapInArrow(_grace(memory, True), _SCHEMA)
    merged = local.repartition("digest").mapInArrow(_grace(memory, False), _SCHEMA)
    return cut(merged.filter("group_size > 1").drop("content"))


def _with_classes(docs: DataFrame, id_col: str, text_col: str, memory: int) -> tuple[DataFrame, DataFrame]:
    """(id, digest, keep_id, group_size, ties) of every row, and the classes."""
    classes = content_classes(docs, id_col, text_col, memory)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(F.encode(text_of(text_col), "UTF-8"), 256)).alias("digest"))
    found = lookup(rows, "digest", classes, "group_size", F.xxhash64("doc_id", "digest"))
    return found.withColumns(
        {
            "keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")),
            "group_size": F.coalesce("group_size", F.lit(1)).cast("long"),
            "ties": F.coalesce("ties", F.lit(1)).cast("long"),
        }
    ), classes


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = TABLE_BYTES) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical; null counts as the empty text. The row with the
    largest id stays; a null id is smaller than any other, and keep_id is null where a class
    has null ids only. Of repeated rows that share that id and text exactly one is kept. An
    empty table gives no rows; other columns of ``docs`` are not read.
    """
    found, classes = _with_classes(docs, id_col, text_col, memory)
    found = found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not classes.filter("ties > 1").isEmpty():
        repeated = F.col("kept") & (F.col("ties") > 1)
        tied = found.filter(repeated).groupBy("doc_id", "digest", "keep_id", "group_size", "ties").agg(F.count("*").alias("n"))
        tied = tied.select("doc_id", "digest", "keep_id", "group_size", "ties", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
        found = found.filter(~repeated).unionByName(tied.withColumn("kept", F.col("i") == 1).drop("i"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", memory: int = TABLE_BYTES) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; the columns stay as they are.

    Where a kept row is repeated (same id and text), one of its rows stays.
    """
    classes = content_classes(docs, id_col, text_col, memory)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.encode(text_of(text_col), "UTF-8"), 256)).alias("digest"),
    )
    if classes.count() <= FEW_KEYS:  # complete rows need not be shuffled
        found = rows.join(F.broadcast(classes), "digest", "left")
    else:
        found = lookup(rows, "digest", classes, "group_size", F.xxhash64("doc_id", "digest"))
    kept = found.filter(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    if not classes.filter("ties > 1").isEmpty():
        tied = F.coalesce("ties", F.lit(1)) > 1
        kept = kept.filter(~tied).unionByName(kept.filter(tied).dropDuplicates(["digest"]))
    return kept.select("row.*")
