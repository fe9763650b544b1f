"""Grace hash grouping of complete contents inside one task, with bounded memory."""

from __future__ import annotations

import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

#: Bytes that a table entry takes besides its content, roughly.
ENTRY_BYTES = 120
_HEAD = struct.Struct("<QqqqqI")
#: Levels of spilling before the hash has no bits left.
_LEVELS = 16

Record = tuple[int, bytes, "int | None", int, int]


class OpenTable:
    """Open addressing with linear probing; an entry matches when the complete content is equal.

    An entry holds the largest id (null is smallest), the number of rows and the number of rows
    that carry that id.
    """

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.best: list[int | None] = []
        self.rows: list[int] = []
        self.ties: list[int] = []
        self.bytes = 0

    def add(self, h: int, content: bytes, key: int | None, rows: int, ties: int) -> None:
        mask = len(self.slots) - 1
        at = (h >> 17) & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                best = self.best[entry]
                self.rows[entry] += rows
                if key == best:
                    self.ties[entry] += ties
                elif best is None or (key is not None and key > best):
                    self.best[entry], self.ties[entry] = key, ties
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.best.append(key)
        self.rows.append(rows)
        self.ties.append(ties)
        self.bytes += len(content) + ENTRY_BYTES
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, h in enumerate(self.hashes):
            at = (h >> 17) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def __len__(self) -> int:
        return len(self.hashes)

    def __iter__(self) -> Iterator[Record]:
        return iter(zip(self.hashes, self.contents, self.best, self.rows, self.ties, strict=True))


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb", 1 << 18) as f:
        while head := f.read(_HEAD.size):
            h, key, known, rows, ties, size = _HEAD.unpack(head)
            yield h, f.read(size), key if known else None, rows, ties


def grouped(records: Iterable[Record], memory: int, fanout_bits: int = 4, level: int = 0, top: str | None = None) -> Iterator[Record]:
    """One record for each distinct content of ``records`` (hash, content, id, rows, ties).

    While the table of distinct contents is within ``memory`` bytes all is done in it. Beyond that
    its entries and all later records go to 2**fanout_bits spill files by the next bits of the
    hash, and each file is grouped in the same way. The files are private to the task, as a
    shuffle's own spill is, and are removed as soon as they are read. A single content larger than
    ``memory`` still works: a table always takes one entry.
    """
    table = OpenTable()
    source = iter(records)
    for record in source:
        table.add(*record)
        if table.bytes > memory and len(table) > 1 and (level + 1) * fanout_bits <= _LEVELS * 4:
            break
    else:
        yield from table
        return
    with tempfile.TemporaryDirectory(dir=top) as folder:
        fanout, shift = 1 << fanout_bits, level * fanout_bits
        files = [open(os.path.join(folder, str(i)), "wb", 1 << 16) for i in range(fanout)]  # noqa: SIM115

        def spill(h: int, content: bytes, key: int | None, rows: int, ties: int) -> None:
            f = files[(h >> shift) & (fanout - 1)]
            f.write(_HEAD.pack(h, key or 0, key is not None, rows, ties, len(content)))
            f.write(content)

        for record in table:
            spill(*record)
        table = None
        for record in source:
            spill(*record)
        for f in files:
            f.close()
        for f in files:
            if os.path.getsize(f.name):
                yield from grouped(_read(f.name), memory, fanout_bits, level + 1, folder)
            os.unlink(f.name)
