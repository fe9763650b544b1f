"""PLY point clouds as a Spark data source (binary little-endian and ascii, vertices only).

``spark.read.format("ply").load(folder)`` gives file, x, y, z, red, green, blue of every ``.ply`` file
below a folder, one partition a file; colours that a file lacks are null. ``df.write.format("ply")``
takes x, y, z and, if there, red, green, blue, and writes one file a task; files of tasks that do
not commit are deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "file string, x float, y float, z float, red short, green short, blue short"
CHANNELS = ("red", "green", "blue")
# Scalar types of the format.
KINDS = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "<i2", "int16": "<i2", "ushort": "<u2", "uint16": "<u2", "int": "<i4", "int32": "<i4", "uint": "<u4", "uint32": "<u4", "float": "<f4", "float32": "<f4", "double": "<f8", "float64": "<f8"}
BATCH = 1 << 16


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":" in path.split("/", 1)[0] else f"file://{path}")


def header(n: int, colours: bool) -> bytes:
    lines = ["ply", "format binary_little_endian 1.0", f"element vertex {n:012d}", *[f"property float {c}" for c in "xyz"], *[f"property uchar {c}" for c in CHANNELS if colours], "end_header"]
    return ("\n".join(lines) + "\n").encode()


def parse_header(stream) -> tuple[str, int, np.dtype]:
    """Format, number of vertices and their record type; leaves the stream at the first vertex."""
    text = b""
    while not text.endswith(b"end_header\n"):
        c = stream.read(1)
        if not c:
            raise ValueError("a PLY header does not end")
        text += c
    form, n, fields, element = "", 0, [], ""
    for line in text.decode("ascii").splitlines():
        words = line.split()
        if words[:1] == ["format"]:
            form = words[1]
        elif words[:1] == ["element"]:
            element = words[1]
            n = int(words[2]) if element == "vertex" else n
        elif words[:1] == ["property"] and element == "vertex":
            fields.append((words[2], KINDS[words[1]]))
    return form, n, np.dtype(fields)


@dataclass
class Part(InputPartition):
    file: str


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def partitions(self) -> list[Part]:
        from pyarrow import fs

        store, folder = _store(self.path)
        found = store.get_file_info(fs.FileSelector(folder, recursive=True))
        return [Part(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and f.path.endswith(".ply")]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        store, _ = _store(self.path)
        with store.open_input_stream(partition.file) as stream:
            form, n, kind = parse_header(stream)
            lines = iter(stream.read().decode().splitlines()) if form == "ascii" else None
            for at in range(0, n, BATCH):
                m = min(BATCH, n - at)
                if lines is not None:
                    rows = np.array([tuple(map(float, next(lines).split()[: len(kind)])) for _ in range(m)], kind)
                else:
                    rows = np.frombuffer(stream.read(m * kind.itemsize), kind, m)
                colours = [pa.array(rows[c].astype(np.int16)) if c in kind.names else pa.nulls(m, pa.int16()) for c in CHANNELS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.file.rsplit("/", 1)[-1]] * m), *[pa.array(rows[c].astype(np.float32)) for c in "xyz"], *colours], ["file", "x", "y", "z", *CHANNELS]
                )


@dataclass
class Written(WriterCommitMessage):
    file: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        store, folder = _store(self.path)
        store.create_dir(folder, recursive=True)
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.ply"
        parts, n, colours = [], 0, False
        for b in batches:
            colours = set(CHANNELS) <= set(b.schema.names)
            rows = np.empty(b.num_rows, [(c, "<f4") for c in "xyz"] + [(c, "u1") for c in CHANNELS if colours])
            for c in rows.dtype.names:
                rows[c] = np.asarray(b.column(c))
            parts.append(rows.tobytes())
            n += b.num_rows
        with store.open_output_stream(name) as out:
            out.write(header(n, colours))
            for p in parts:
                out.write(p)
        return Written(name)

    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        store, _ = _store(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(m.file)


class Ply(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ply"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def read_ply(spark: SparkSession, path: str, missing: int = 0) -> DataFrame:
    """Vertices of all files, ``missing`` for colours that a file lacks."""
    spark.dataSource.register(Ply)
    return spark.read.format("ply").load(path).fillna(missing, list(CHANNELS))


def write_ply(points: DataFrame, path: str) -> None:
    """x, y, z and red, green, blue (clipped to 0..255, 0 where missing) to PLY files."""
    points.sparkSession.dataSource.register(Ply)
    place = [F.col(c).cast("float").alias(c) for c in "xyz"]
    channel = [F.least(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)), F.lit(255)).cast("short").alias(c) for c in CHANNELS if c in points.columns]
    points.select(*place, *channel).write.format("ply").mode("append").save(path)
