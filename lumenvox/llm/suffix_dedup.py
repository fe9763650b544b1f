"""Removal of repeated byte strings by bucket-pointer refinement.

A string of SPAN bytes holds at least one anchor: the position whose q-gram hash is smallest within
a string of that length. Equal strings hold the same anchor at the same place, so only anchors have
to meet. That gives the initial buckets of the suffix sort, q-grams instead of all positions:

1. every chunk of documents sends its distinct anchors, by hash, and learns which of them occur elsewhere;
2. it sends the bytes around those once for each distinct surrounding (with the smallest doc_id);
3. the buckets are refined on both sides. A bucket is split by sorting its rows on the identifiers of the
   q-grams at a later offset (for the left side, an earlier one); the new bucket pointers are written
   back and the next lengths start from them, and rows that are alone in their bucket drop out. A pair of
   pointers, to the left and to the right, names a string of SPAN bytes, and the smallest doc_id of such
   a bucket tells which rows repeat an earlier document;
4. the chunk marks the bytes that those strings cover.

An anchor that any number of documents share leaves each chunk once, so no bucket is larger than
the number of chunks times the distinct surroundings. Texts are cut into chunks once and kept in a
table bucketed by chunk; they are not shuffled again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import Bucketed, cut, text_of

SPAN, Q = 50, 24
SIDE = SPAN - Q
#: Bytes of the grams whose identifiers split a bucket.
GRAM = 8
#: Bytes of text in a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Positions whose hashes are in memory at once.
_STEP = 1 << 20
#: Bits of an anchor's hash that travel in the first round; a clash only sends more bytes in the second.
_HASH_BITS = 44
_FULL = np.uint32(1 << 31)
_NULL_ID = np.iinfo(np.int64).max


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes."""
    import zstandard

    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(a.view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unzip(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    import zstandard

    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    for kind in kinds:
        t = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n) if t.kind != "V" else np.ascontiguousarray(planes.T))
        at += n * t.itemsize
    return out


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of rows of 64-bit words."""
    h = np.full(len(words[0]), 0x9E3779B97F4A7C15, np.uint64)
    for w in words:
        h ^= w
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xA0761D6478BD642F)
        h ^= h >> np.uint64(29)
    return h


def _slide(a: np.ndarray, width: int, pick) -> np.ndarray:
    """min or max of every ``width`` neighbours."""
    done, out = 1, a
    while 2 * done <= width:
        out = pick(out[: len(out) - done], out[done:])
        done *= 2
    return pick(out[: len(out) - (width - done)], out[width - done :]) if done < width else out


class Chunk:
    """Documents end to end, with the anchors of their strings."""

    def __init__(self, ids: bytes, ends: bytes, data: bytes) -> None:
        import zstandard

        self.ids, self.ends = np.frombuffer(ids, "<i8"), np.frombuffer(ends, "<i8")
        raw = zstandard.ZstdDecompressor().decompress(data)
        self.n = len(raw)
        self.raw = raw
        self.bytes = np.frombuffer(raw + b"\0" * (SPAN + 8), np.uint8)
        self.starts = np.r_[0, self.ends[:-1]] if len(self.ends) else self.ends

    def anchors(self) -> None:
        """Sets at, hash, doc (place in ids), left and right (bytes around within the document) of all anchors."""
        words = np.ndarray(len(self.bytes) - 7, "<u8", self.bytes, strides=(1,))
        at = []
        hashes = []
        valid = np.zeros(self.n + 1, bool)
        for s, e in zip(self.starts, self.ends, strict=True):
            if e - s >= SPAN:
                valid[s : e - Q + 1] = True
        width = SIDE + 1
        top = np.uint64(2**64 - 1)
        for x in range(0, self.n, _STEP):
            lo, hi = max(0, x - SIDE), min(self.n, x + _STEP + SIDE)
            h = _mixed([words[lo + o : hi + o].copy() for o in range(0, Q, 8)])
            h[~valid[lo:hi]] = top
            padded = np.concatenate([np.full(SIDE, top, np.uint64), h, np.full(SIDE, top, np.uint64)])
            low = _slide(padded, width, np.minimum)
            # strings that reach over the end of the data have no say
            low[: SIDE] = 0
            low[len(h) :] = 0
            best = _slide(low, width, np.maximum)
            chosen = np.flatnonzero((best == h) & valid[lo:hi])
            chosen = chosen[(chosen >= x - lo) & (chosen < x - lo + _STEP)]
            at.append(chosen + lo)
            hashes.append(h[chosen])
        self.at = np.concatenate(at) if at else np.empty(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.doc = np.searchsorted(self.ends, self.at, "right")
        start, end = self.starts[self.doc], self.ends[self.doc]
        self.left = np.minimum(self.at - start, SIDE)
        self.right = np.minimum(end - self.at - Q, SIDE)

    def around(self, which: np.ndarray) -> np.ndarray:
        """The SIDE + Q + SIDE bytes around anchors, zero beyond the document."""
        at, left, right = self.at[which], self.left[which], self.right[which]
        place = np.arange(-SIDE, Q + SIDE)
        rows = self.bytes[np.clip(at[:, None] + place, 0, len(self.bytes) - 1)].copy()
        rows[(place < -left[:, None]) | (place >= Q + right[:, None])] = 0
        return rows

    def entries(self) -> None:
        """Sets entry (of each anchor: which distinct anchor with its surroundings it is), first (an anchor of each entry with the smallest id)."""
        around = np.empty(len(self.at), np.uint64)
        for x in range(0, len(self.at), 1 << 16):
            part = np.arange(x, min(x + (1 << 16), len(self.at)))
            rows = np.zeros((len(part), 80), np.uint8)
            rows[:, : SIDE + Q + SIDE] = self.around(part)
            rows[:, 76], rows[:, 77] = self.left[part], self.right[part]
            around[part] = _mixed(list(rows.view("<u8").T.copy()))
        order = np.lexsort((self.ids[self.doc], around, self.hash))
        h, c = self.hash[order], around[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])] if len(order) else np.empty(0, bool)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.first = order[new]


def _chunked(limit: int):
    """mapInArrow function: rows of documents to rows of chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        zip_ = zstandard.ZstdCompressor(level=3)
        base, nth = TaskContext.get().partitionId() << 32, 0
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts]).astype("<i8")
            return pa.RecordBatch.from_pydict(
                {"chunk": pa.array([base + nth], pa.int64()), "ids": [np.array(ids, "<i8").tobytes()], "ends": [ends.tobytes()], "data": [zip_.compress(b"".join(texts))]}
            )

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = text.as_buffer().to_pybytes()
                if texts and size + len(data) > limit:
                    yield chunk()
                    ids, texts, size, nth = [], [], 0, nth + 1
                ids.append(_NULL_ID if key is None else key)
                texts.append(data)
                size += len(data)
        if texts:
            yield chunk()

    return run


def _by_shard(values: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    shard = (values % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if ends[s] < ends[s + 1]:
            yield s, order[ends[s] : ends[s + 1]]


_KEYS = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
_KEYS_SQL = "shard int, chunk long, n long, data binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk, dict]]:
    for b in batches:
        for row in b.to_pylist():
            yield row["chunk"], Chunk(row["ids"], row["ends"], row["data"]), row


def _send_keys(shards: int):
    """Distinct anchor hashes of each chunk, by shard; the lowest bit tells that two of its documents have it."""

    def run(batches):
        for chunk, c, _ in _chunks(batches):
            c.anchors()
            key = c.hash >> np.uint64(64 - _HASH_BITS)
            order = np.lexsort((c.doc, key))
            k, d = key[order], c.doc[order]
            new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.empty(0, bool)
            at = np.flatnonzero(new)
            last = np.r_[at[1:], len(k)] - 1 if len(k) else at
            several = d[at] != d[last]
            keys = k[at]
            rows = []
            for s, some in _by_shard(keys, shards):
                value = (keys[some] << np.uint64(1)) | several[some]
                rows.append((s, chunk, len(some), _zip(np.diff(value, prepend=np.uint64(0)))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), _KEYS, strict=True)], schema=_KEYS)

    return run


def _answer_keys(batches):
    """Of each chunk's keys in a shard those that another document has too."""
    rows = [r for b in batches for r in b.to_pylist()]
    by_shard: dict[int, list[dict]] = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for shard, some in by_shard.items():
        values = [np.cumsum(_unzip(r["data"], r["n"], "<u8")[0], dtype=np.uint64) for r in some]
        keys = np.sort(np.concatenate([v >> np.uint64(1) for v in values]))
        twice = keys[1:][keys[1:] == keys[:-1]]
        for r, v in zip(some, values, strict=True):
            key = v >> np.uint64(1)
            there = np.zeros(len(key), bool)
            if len(twice):
                there = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
            found = key[there | ((v & np.uint64(1)) == 1)]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(([shard], [r["chunk"]], [len(found)], [_zip(np.diff(found, prepend=np.uint64(0)))]), _KEYS, strict=True)], schema=_KEYS)


_ROW = ("<u8", "<i8", "<u4", "u1", "u1", f"V{SIDE + Q + SIDE}")


def _send_bytes(shards: int):
    """The surroundings of the anchors that were found elsewhere, one row for each distinct one."""

    def run(batches):
        for chunk, c, row in _chunks(batches):
            answers = [np.cumsum(_unzip(a["data"], a["n"], "<u8")[0], dtype=np.uint64) for a in row["answers"] or []]
            if not answers:
                continue
            c.anchors()
            c.entries()
            wanted = np.sort(np.concatenate(answers))
            key = c.hash[c.first] >> np.uint64(64 - _HASH_BITS)
            entries = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key)
            for s, some in _by_shard(key[entries], shards):
                e = entries[some]
                a = c.first[e]
                data = _zip(key[e], c.ids[c.doc[a]], e.astype("<u4"), c.left[a].astype("u1"), c.right[a].astype("u1"), c.around(a))
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(([s], [chunk], [len(e)], [data]), _KEYS, strict=True)], schema=_KEYS)

    return run


def _classes(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by ``columns`` (the first counts most), and the number of each ordered row's class."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new) - 1


def _words(rows: np.ndarray) -> list[np.ndarray]:
    """Bytes of rows as big-endian words, so that words compare as the bytes do."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return list(padded.view(">u8").astype(np.uint64).T.copy())


def _grams(rows: np.ndarray) -> np.ndarray:
    """Identifiers of the grams that start at each offset of ``rows``, one column an offset."""
    data = np.ascontiguousarray(rows)
    n = data.shape[1] - GRAM + 1
    return np.ndarray((len(data), n), ">u8", data, strides=(data.shape[1], 1)) if len(data) else np.empty((0, n), ">u8")


def _split(bucket: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Buckets split by the identifiers of a gram; rows that are alone already keep their bucket.

    Pointers are numbers of rows: a bucket is named by the place of its first row in the sorted order.
    """
    size = np.bincount(bucket, minlength=1)
    active = np.flatnonzero(size[bucket] > 1)
    if not len(active):
        return bucket
    b, g = bucket[active], gram[active].astype(np.uint64)
    order = np.lexsort((g, b))
    b, g = b[order], g[order]
    head = np.r_[True, (b[1:] != b[:-1]) | (g[1:] != g[:-1])]
    # a bucket of n rows owns n numbers from its own on, so its parts can be numbered among them
    first = np.r_[True, b[1:] != b[:-1]]
    at = np.arange(len(b))
    inside = at - np.maximum.accumulate(np.where(first, at, 0))
    out = bucket.copy()
    out[active[order]] = (b + inside)[np.maximum.accumulate(np.where(head, at, 0))]
    return out


def _numbered(bucket: np.ndarray) -> np.ndarray:
    """Buckets named by how many rows are in smaller ones."""
    _, inverse, counts = np.unique(bucket, return_inverse=True, return_counts=True)
    return (np.cumsum(counts) - counts)[inverse]


def _pointers(bucket: np.ndarray, rows: np.ndarray, known: int) -> list[np.ndarray]:
    """Bucket pointers of every row for each length: rows share one when their bucket and so many bytes agree.

    ``rows`` has ``known`` bytes on which the rows of a bucket agree, and then those that split it. Lengths up
    to the next GRAM bytes start from the pointers that the GRAM bytes before them left; a gram may reach
    back over bytes that agree.
    """
    gram = _grams(rows)
    out = [_numbered(bucket)]
    for length in range(1, rows.shape[1] - known + 1):
        out.append(_split(out[(length - 1) // GRAM * GRAM], gram[:, known + length - GRAM]))
    return out


def refined(doc: np.ndarray, left: np.ndarray, right: np.ndarray, around: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of anchors: the smallest doc with the same surroundings, and a bit for each l where the string
    that starts l bytes before the anchor is in a smaller doc."""
    bucket = _numbered(key)
    gram = _grams(around)
    for at in range(SIDE, SIDE + Q, GRAM):
        bucket = _split(bucket, gram[:, at])
    sides = _words(np.concatenate([around[:, :SIDE], around[:, SIDE + Q :]], axis=1))
    order, same_sorted = _classes(bucket, *sides, left.astype(np.int64), right.astype(np.int64), doc)
    # the last column splits equal surroundings by doc; go back to surroundings alone
    head = np.zeros(len(order), bool)
    head[:1] = True
    for c in (bucket, *sides, left, right):
        s = c[order]
        head[1:] |= s[1:] != s[:-1]
    which = np.cumsum(head) - 1
    smallest = np.empty(len(order), np.int64)
    smallest[order] = doc[order][head][which]
    mask = np.zeros(len(order), np.uint32)
    reps = order[head]
    counts = np.bincount(bucket[reps], minlength=int(bucket.max(initial=-1)) + 1)
    reps = reps[counts[bucket[reps]] > 1]
    if len(reps):
        reps = reps[np.argsort(doc[reps], kind="stable")]
        b, d = bucket[reps], doc[reps]
        before = _pointers(b, around[reps, : SIDE + GRAM][:, ::-1], GRAM)
        after = _pointers(b, around[reps, SIDE + Q - GRAM :], GRAM)
        found = np.zeros(len(reps), np.uint32)
        for n in range(SIDE + 1):
            fits = np.flatnonzero((left[reps] >= n) & (right[reps] >= SIDE - n))
            pair = before[n][fits] * (len(reps) + 1) + after[SIDE - n][fits]
            by = np.argsort(pair, kind="stable")  # rows are in order of doc, so a class starts with its smallest
            p = pair[by]
            new = np.r_[True, p[1:] != p[:-1]] if len(p) else np.empty(0, bool)
            least = d[fits[by]][new][np.cumsum(new) - 1] if len(p) else d[:0]
            hit = fits[by][least < d[fits[by]]]
            found[hit] |= np.uint32(1 << n)
        mask[reps] = found
    # rows with the same surroundings and doc as a representative share its bits
    sharing = np.empty(len(order), np.int64)
    sharing[order] = order[head][which]
    return smallest, np.where(doc == doc[sharing], mask[sharing], np.uint32(0))


def _answer_bytes(batches):
    """Of each chunk's rows in a shard: which strings around them are in a smaller document."""
    by_shard: dict[int, list[dict]] = {}
    for b in batches:
        for r in b.to_pylist():
            by_shard.setdefault(r["shard"], []).append(r)
    for shard, some in by_shard.items():
        parts = [_unzip(r["data"], r["n"], *_ROW) for r in some]
        key, doc, entry, left, right, around = (np.concatenate(x) for x in zip(*parts, strict=True))
        smallest, mask = refined(doc, left, right, around, key)
        mask = np.where(smallest < doc, _FULL, mask)
        at = 0
        for r in some:
            m, e = mask[at : at + r["n"]], entry[at : at + r["n"]]
            at += r["n"]
            if m.any():
                data = _zip(e[m > 0], m[m > 0])
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(([shard], [r["chunk"]], [int((m > 0).sum())], [data]), _KEYS, strict=True)], schema=_KEYS)


def _covered(c: Chunk, answers: list[dict]) -> np.ndarray:
    """Which bytes of the chunk are to go."""
    c.anchors()
    c.entries()
    mask = np.zeros(len(c.first), np.uint32)
    for a in answers:
        entry, bits = _unzip(a["data"], a["n"], "<u4", "<u4")
        mask[entry] = bits
    ids = c.ids[c.doc]
    own = mask[c.entry]
    full = (own == _FULL) | (ids > ids[c.first][c.entry])
    turn = np.zeros(c.n + 1, np.int64)
    lo, hi = np.maximum(0, SIDE - c.right), c.left  # strings that start l bytes before the anchor, l in lo..hi
    some = np.flatnonzero(full & (lo <= hi))
    np.add.at(turn, c.at[some] - hi[some], 1)
    np.add.at(turn, c.at[some] - lo[some] + SPAN, -1)
    partly = np.flatnonzero(~full & (own > 0))
    for n in range(SIDE + 1):
        some = partly[(own[partly] >> np.uint32(n)) & np.uint32(1) == 1]
        np.add.at(turn, c.at[some] - n, 1)
        np.add.at(turn, c.at[some] - n + SPAN, -1)
    return np.cumsum(turn[: c.n]) > 0


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cleaned(with_text: bool):
    """One row for each document: what was removed, and what is left."""

    def run(batches):
        for _, c, row in _chunks(batches):
            gone = _covered(c, row["answers"] or [])
            rising = np.zeros(c.n + 1, np.int64)
            rising[1:] = np.cumsum(gone & ~np.r_[False, gone[:-1]]) if c.n else 0
            removed = np.r_[0, np.cumsum(gone)]
            rows = []
            for key, s, e in zip(c.ids.tolist(), c.starts.tolist(), c.ends.tolist(), strict=True):
                n = int(removed[e] - removed[s])
                spans = int(rising[e] - rising[s])
                if s < e and s and gone[s] and gone[s - 1]:
                    spans += 1  # a run that starts with the document, right after one that ends the document before
                kept = c.raw[s:e] if not n else np.frombuffer(c.raw, np.uint8)[s:e][~gone[s:e]].tobytes()
                rows.append((None if key == _NULL_ID else key, e - s, n, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept.

    Each byte covered by a 50-byte string that also starts in a document with a smaller id is
    removed; strings are judged on the input and never cross documents. Null counts as the empty
    text; rows with equal ids do not remove each other; a null id is larger than any other. A
    text of under 50 bytes stays as it is. An empty table gives no rows; other columns are not
    read. The result is computed at once.
    """
    spark = docs.sparkSession
    shards = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(text_of(text_col), "UTF-8").alias("text"))
    tables = Bucketed(spark)
    chunks = rows.mapInArrow(_chunked(chunk_bytes), "chunk long, ids binary, ends binary, data binary")
    try:
        table = tables.keep(chunks, shards, "chunk")

        def with_answers(answers: DataFrame) -> DataFrame:
            packed = answers.groupBy("chunk").agg(F.collect_list(F.struct("n", "data")).alias("answers"))
            return table.join(packed.hint("shuffle_hash"), "chunk", "left")

        keys = table.mapInArrow(_send_keys(shards), _KEYS_SQL)
        known = keys.repartition(shards, "shard").mapInArrow(_answer_keys, _KEYS_SQL)
        sent = with_answers(known).mapInArrow(_send_bytes(shards), _KEYS_SQL)
        judged = sent.repartition(shards, "shard").mapInArrow(_answer_bytes, _KEYS_SQL)
        cleaned = with_answers(judged).mapInArrow(_cleaned(with_text), _OUT)
        return cut(cleaned if with_text else cleaned.drop("kept"))
    finally:
        tables.drop()
