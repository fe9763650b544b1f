"""Token ids in binary files of fixed-width bit packing, as a Spark data source.

``df.write.format("packed_ids")`` takes the columns doc_id and text, encodes each text and stores
every id in the fewest bits that hold the vocabulary. ``spark.read.format("packed_ids")`` gives
doc_id, start, n_tokens and ids back. A file is

    magic | blocks of BLOCK ids, each starting at a byte | document table | block offsets | footer

The footer has the position of both tables, so a reader can unpack any block by numpy without
the others. A task writes to a file name of its own attempt; only files of committed tasks are
listed in the index that the driver writes at the end, so lost or repeated tasks leave no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from lumenvox.llm.common import give_back, scratch_path, text_of
from lumenvox.llm.tokens import PieceEncoder

MAGIC = b"PKIDS001"
BLOCK = 8192
INDEX = "index.json"
SCHEMA = "doc_id long, start long, n_tokens long, ids binary"
_FOOTER = struct.Struct("<QQQQIIQ")


def id_bits(vocabulary: int) -> int:
    """Bits that hold any id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """ids in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_ids(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of packed ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def _store(path: str):
    """File system and path of a URI, or of a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":" in path.split("/", 1)[0] else f"file://{path}")


class IdFileWriter:
    """Writes one file block by block; only the block being filled and the tables are in memory."""

    def __init__(self, stream, bits: int) -> None:
        self.stream, self.bits = stream, bits
        self.at = stream.write(MAGIC)
        self.blocks: list[int] = []
        self.keys: list[int] = []
        self.known: list[bool] = []
        self.ends: list[int] = []
        self.n_ids = 0
        self.open = np.empty(0, "<u4")

    def add(self, key: int | None, new: np.ndarray) -> None:
        if len(new) and int(new.max()) >> self.bits:
            raise ValueError(f"an id needs more than {self.bits} bits")
        self.n_ids += len(new)
        self.keys.append(key or 0)
        self.known.append(key is not None)
        self.ends.append(self.n_ids)
        self.open = np.concatenate([self.open, new]) if len(self.open) else new
        while len(self.open) >= BLOCK:
            self._block(self.open[:BLOCK])
            self.open = self.open[BLOCK:]

    def _block(self, ids: np.ndarray) -> None:
        self.blocks.append(self.at)
        self.at += self.stream.write(pack_ids(ids, self.bits))

    def close(self) -> None:
        if len(self.open):
            self._block(self.open)
        table = self.at
        for values, kind in ((self.keys, "<i8"), (self.known, "u1"), (self.ends, "<u8")):
            self.at += self.stream.write(np.array(values, kind).tobytes())
        offsets = self.at
        self.stream.write(np.array(self.blocks, "<u8").tobytes())
        self.stream.write(_FOOTER.pack(table, offsets, len(self.keys), self.n_ids, self.bits, BLOCK, len(self.blocks)))
        self.stream.close()


class IdFile:
    """Random access to one file."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        table, offsets, self.n_docs, self.n_ids, self.bits, self.block, n_blocks = _FOOTER.unpack(source.read_at(_FOOTER.size, size - _FOOTER.size))
        self.offsets = np.frombuffer(source.read_at(8 * n_blocks, offsets), "<u8").astype(np.int64)
        self.stop = table
        n = self.n_docs
        self.keys = np.frombuffer(source.read_at(8 * n, table), "<i8")
        self.known = np.frombuffer(source.read_at(n, table + 8 * n), "u1").astype(bool)
        self.ends = np.frombuffer(source.read_at(8 * n, table + 9 * n), "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """ids from ``start`` to ``stop``, from the blocks that hold them."""
        if start >= stop:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.stop
        data = self.source.read_at(end - int(self.offsets[first]), int(self.offsets[first]))
        n = min((last + 1) * self.block, self.n_ids) - first * self.block
        if self.block * self.bits % 8 == 0:
            found = unpack_ids(data, n, self.bits)
        else:
            step = -(-self.block * self.bits // 8)
            parts = range(0, len(data), step)
            found = np.concatenate([unpack_ids(data[p : p + step], min(self.block, n - i * self.block), self.bits) for i, p in enumerate(parts)])
        return found[start - first * self.block : stop - first * self.block]

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int | None, int, bytes]]:
        """(key, start in the file, ids) of each document, reading about ``at_once`` ids at a time."""
        doc, begin = 0, 0
        while doc < self.n_docs:
            upto = max(doc + 1, int(np.searchsorted(self.ends, begin + at_once, "right")))
            stop = int(self.ends[upto - 1])
            ids = self.ids(begin, stop).tobytes()
            at = begin
            for d in range(doc, upto):
                end = int(self.ends[d])
                yield int(self.keys[d]) if self.known[d] else None, at, ids[4 * (at - begin) : 4 * (end - begin)]
                at = end
            doc, begin = upto, stop


@dataclass
class Written(WriterCommitMessage):
    order: int
    file: str
    n_docs: int
    n_ids: int


class _Writer(DataSourceArrowWriter):
    """Files are written under names that no other attempt has; only the index, which the driver replaces, makes them rows."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex
        self.tokenizer, self.keeps_space = options["tokenizer"], options.get("keeps_space", "false") == "true"
        self.end_id, self.vocabulary = int(options["end_id"]), int(options["vocabulary"])

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        order = TaskContext.get().partitionId()
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        name = f"part-{order:06d}-{self.job}-{uuid.uuid4().hex}.ids"
        encoder = PieceEncoder(self.tokenizer, self.keeps_space)
        out = IdFileWriter(store.open_output_stream(f"{folder}/{name}"), id_bits(self.vocabulary))
        for b in batches:
            for key, ids in zip(b.column("doc_id").to_pylist(), encoder.encode(b.column("text"), self.end_id), strict=True):
                out.add(key, ids)
        out.close()
        give_back()
        return Written(order, name, len(out.keys), out.n_ids)

    def commit(self, messages: list) -> None:
        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        new = [[m.file, m.n_docs, m.n_ids] for m in sorted((m for m in messages if m is not None), key=lambda m: m.order)]
        files = ([] if self.overwrite else _index(store, folder)) + new
        with store.open_output_stream(f"{folder}/{INDEX}.{self.job}") as f:
            f.write(json.dumps(files).encode())
        store.move(f"{folder}/{INDEX}.{self.job}", f"{folder}/{INDEX}")
        listed = {name for name, *_ in files}
        self._clear(lambda name: name not in listed and (self.overwrite or self.job in name))

    def abort(self, messages: list) -> None:
        self._clear(lambda name: self.job in name)

    def _clear(self, unwanted) -> None:
        """Delete files of failed attempts, or those that an overwrite replaced."""
        from pyarrow import fs

        store, folder = _store(self.path)
        for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.base_name.startswith("part-") and info.base_name.endswith(".ids") and unwanted(info.base_name):
                store.delete_file(info.path)


def _index(store, folder: str) -> list[list]:
    """File, documents and ids of each file that was committed, in order; none where nothing was."""
    from pyarrow import fs

    if store.get_file_info(f"{folder}/{INDEX}").type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(f"{folder}/{INDEX}") as f:
        return json.loads(f.read())


@dataclass
class _FilePart(InputPartition):
    file: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def partitions(self) -> list[_FilePart]:
        store, folder = _store(self.path)
        files = _index(store, folder)
        parts, start = [], 0
        for name, n_docs, n_ids in files:
            if n_docs:
                parts.append(_FilePart(name, start))
            start += n_ids
        return parts

    def read(self, partition: _FilePart | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # so Spark reads a source without partitions
            return
        store, folder = _store(self.path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        rows: list[tuple] = []
        size = 0
        with store.open_input_file(f"{folder}/{partition.file}") as source:
            for key, at, ids in IdFile(source).documents():
                rows.append((key, partition.start + at, len(ids) // 4, ids))
                size += len(ids)
                if size >= 4 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class PackedIds(DataSource):
    """Options: path; to write also tokenizer (file), keeps_space, end_id and vocabulary (number of ids)."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PackedIds)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text", mode: str = "append") -> None:
    """Write the ids of all ``docs`` in ascending id order to files under ``path``.

    Null ids come first; rows with one id are ordered by their text, and rows with one id may be
    split over files. A null or empty text has the end id alone; a very long one spans as many blocks
    as it needs. Other columns are not read. An empty table gives an index without files. ``mode``
    "append" puts documents after those that are there, "overwrite" replaces them. ``path`` is
    a folder that all executors share; one job writes to it at a time.
    """
    register(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    options = {"tokenizer": tokenizer, "keeps_space": str(keeps_space).lower(), "end_id": end_id, "vocabulary": vocabulary}
    ordered.write.format("packed_ids").options(**options).mode(mode).save(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit integers)."""
    register(spark)
    return spark.read.format("packed_ids").load(path)


def token_file_digests(docs: DataFrame, tokenizer: str, keeps_space: bool, end_id: int, vocabulary: int) -> DataFrame:
    """Write ``docs`` to new files in the shared folder and sum up what is read back: doc_id, start, n_tokens, ids_crc32.

    Null ids come first, null and empty texts have one id, repeated rows and very long texts are written
    as they are; an empty table gives no rows; other columns are not read.
    """
    path = scratch_path(docs.sparkSession, "token-ids")
    write_token_files(docs, path, tokenizer, keeps_space, end_id, vocabulary)
    return read_token_files(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
