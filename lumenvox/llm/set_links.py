"""Exact candidates for similar sets, and their comparison, without pairs of all members of a group.

Two sets with a Jaccard similarity of t or more differ in at most (1 - t) / (1 + t) of their summed sizes. If all possible
elements are dealt into more segments than that by a hash, some segment holds the same elements of both. So sets ask, with one hash
for each segment, how many hold the same. Where more segments than may differ are held by no other, a set has no similar one; of the others every pair
that is similar enough meets at one of the rarest segments of both. What meets is
brought together, each set once for each pair of blocks, and compared there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, lookup, tidy
from lumenvox.llm.unions import merge

#: Times that a set with too many empty segments is dealt out anew, before its elements themselves are sent.
SEEDS = 6
#: Sets of a block and their bytes; segment hashes of a chunk; numbers of an array of comparisons that is in memory at once.
BLOCK_SETS, BLOCK_BYTES = 2048, 1 << 25
HASHES_AT_ONCE, _AT_ONCE = 1 << 20, 1 << 24
#: Bytes of texts for each shard of their segments' hashes; number of dealings of a chunk that end it; the slot of a hash that several dealings of a chunk hold.
SHARD_BYTES, _SLOTS, _NO_SLOT = 1 << 23, 60_000, 0xFFFF
_ROWS_AT_ONCE = 64
_SCHEMA = "shard long, chunk long, first binary, second binary, third binary, fourth binary"
_MESSAGE = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), *[(name, pa.binary()) for name in ("first", "second", "third", "fourth")]])


@cache
def size_classes(least: float) -> tuple[list[int], list[int], list[int]]:
    """First sizes of the classes, and the differences and segments of each; similar sets are in one class or in neighbours."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(math.floor(first[-1] / least + 1e-9) + 1)
    most = [math.floor((1 - least) / least * (top - 1) + 1e-9) for top in first[1:]]
    segments = []
    for low, k in zip(first, most, strict=False):
        spare = lambda m: m - k - (e := m * math.exp(-low / m)) - 2 * math.sqrt(e)
        segments.append(1 if k == 0 else next((m for m in range(k + 1, 2 * k + 4, max(1, k // 64)) if spare(m) > 0), max(range(k + 1, 2 * k + 4, max(1, k // 64)), key=spare)) if low < 1 << 24 else 2 * k)
    return first, most, segments


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    h = (h ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(29))


def _segmented(h: np.ndarray, segments: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The segments that are not empty, and a hash of what each holds."""
    mixed = _mixed(h, seed)
    place = ((mixed >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    order = np.argsort(place, kind="stable")
    place, mixed = place[order], mixed[order]
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return place[starts], np.add.reduceat(_mixed(mixed, 3), starts)


def dealings(h: np.ndarray, least: float) -> list[tuple[int, np.ndarray]]:
    """Each way in which a set is dealt into segments: the segments that may differ from a similar set's, at most, and hashes of its own.

    ``h`` has the hashes (uint64) of the elements, each once. Similar sets have a way in common in which some segment is the same.
    """
    if not len(h):
        return [(0, np.zeros(1, np.uint64))]
    first, most, segments = size_classes(least)
    own = int(np.searchsorted(first, len(h), "right")) - 1
    differing = math.floor((1 - least) / least * len(h) + 1e-9)
    found = []
    for c in (own, own - 1):
        if c < 0 or (c < own and len(h) > math.floor((first[own] - 1) / least + 1e-9)):
            continue
        for seed in range(SEEDS):
            place, held = _segmented(h, segments[c], c * SEEDS + seed)
            found.append((min(differing, most[c]), _mixed(held ^ (place * np.uint64(0x9E3779B97F4A7C15)), (c + 1) * 1000 + seed)))
            if segments[c] - len(place) < segments[c] - most[c]:  # what is equal cannot all be empty
                break
        else:
            ordered = np.sort(h)
            prefix = len(h) - math.ceil(least * len(h) - 1e-9) + 1
            found.append((prefix - 1, _mixed(ordered[:prefix], (c + 1) * 1000 + SEEDS)))
    return found


def signatures(h: np.ndarray, least: float) -> np.ndarray:
    """Hashes of which similar sets have at least one in common; ``h`` has the hashes (uint64) of the elements, each once."""
    return np.concatenate([held for _, held in dealings(h, least)])


def _combined(sig: np.ndarray, key: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each signature, with its first key, and links (without a signature) of the other keys to it."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.empty(0, np.int64)
    head = np.repeat(key[starts], np.diff(np.r_[starts, len(sig)]))
    yield pa.RecordBatch.from_arrays([pa.array(sig[starts]), pa.array(key[starts]), pa.nulls(len(starts), pa.int64())], ["sig", "key", "head"])
    apart = key != head
    if apart.any():
        pairs = np.unique(np.stack([key[apart], head[apart]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["sig", "key", "head"])


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first, so that high bytes that are zero compress well."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _from_planes(data: bytes, dtype: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _messages(chunk: int, keys: list[int], most: list[int], held: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    """What the dealings of a chunk of sets hold, to the shards of their hashes, and a row (with a shard below zero) of what the chunk needs with the answers.

    A hash that one dealing holds is sent with its slot in the chunk, one that several hold once, with their number and no slot; the chunk's row has their slots.
    """
    slot = np.repeat(np.arange(len(held)), [len(x) for x in held])
    token = np.concatenate(held) >> np.uint64(32 - bits)
    order = np.lexsort((slot, token))
    slot, token = slot[order], token[order]
    new = np.r_[True, (token[1:] != token[:-1]) | (slot[1:] != slot[:-1])]
    slot, token = slot[new].astype("<u2"), token[new]
    sizes = np.bincount(slot, minlength=len(held))
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    n = np.diff(np.r_[starts, len(token)])
    several = np.repeat(n > 1, n)
    rows = [(-1 - chunk, chunk, np.array(keys, "<i8").tobytes(), np.array([sizes, most], "<i4").tobytes(), token[several].astype("<u8").tobytes(), slot[several].tobytes())]
    token, slot = token[starts], np.where(n > 1, _NO_SLOT, slot[starts]).astype("<u2")
    shard = (token >> np.uint64(32)).astype(np.int64)
    ends = np.r_[np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(shard)]
    for at, end in zip(np.r_[0, ends[:-1]], ends, strict=True):
        values = (token[at:end] & np.uint64(0xFFFFFFFF)).astype("<u4")
        own = n[at:end]
        rows.append((int(shard[at]), chunk, _planes(np.diff(values, prepend=np.uint32(0))), _planes(slot[at:end]), _planes(own[own > 1].astype("<u4")), None))
    for at in range(0, len(rows), _ROWS_AT_ONCE):
        yield pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r, strict=True)) for r in rows[at : at + _ROWS_AT_ONCE]], schema=_MESSAGE)


def _asked(hashes, least: float, bits: int, at_once: int):
    """mapInArrow function: (key, text) to the messages of chunks of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        keys, most, held, known, n = [], [], [], set(), 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if key in known:  # an equal text
                    continue
                known.add(key)
                for differing, x in dealings(np.unique(np.array(hashes(text.as_buffer().to_pybytes()), "<u8")), least):
                    keys.append(key)
                    most.append(differing)
                    held.append(x)
                    n += len(x)
                if n >= at_once or len(held) >= _SLOTS:
                    yield from _messages(chunk, keys, most, held, bits)
                    chunk += 1
                    keys, most, held, known, n = [], [], [], set(), 0
        if held:
            yield from _messages(chunk, keys, most, held, bits)

    return run


def _by(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows that share a value of ``column``, by which all are sorted."""
    now, rows = None, []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if row[column] != now:
                if rows:
                    yield now, rows
                now, rows = row[column], []
            rows.append(row)
    if rows:
        yield now, rows


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over messages sorted by shard: to each chunk its hashes that several dealings hold, of all chunks, and how many."""
    for shard, rows in _by(batches, 0):
        if shard < 0:
            yield pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r, strict=True)) for r in rows], schema=_MESSAGE)
            continue
        values, slots, counts = [], [], []
        for row in rows:
            values.append(np.cumsum(_from_planes(row[2], "<u4"), dtype="<u4"))
            slots.append(_from_planes(row[3], "<u2"))
            counts.append(np.ones(len(slots[-1]), np.int64))
            counts[-1][slots[-1] == _NO_SLOT] = _from_planes(row[4], "<u4")
        _, which = np.unique(np.concatenate(values), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)[which]
        ends = np.cumsum([len(v) for v in values])
        answers = []
        for row, v, s, n in zip(rows, values, slots, np.split(total, ends[:-1]), strict=True):
            if (met := n > 1).any():
                answers.append((shard, row[1], v[met].tobytes(), s[met].tobytes(), n[met].astype("<i8").tobytes(), None))
        for at in range(0, len(answers), _ROWS_AT_ONCE):
            yield pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r, strict=True)) for r in answers[at : at + _ROWS_AT_ONCE]], schema=_MESSAGE)


def rarest(token: np.ndarray, n: np.ndarray, slot: np.ndarray, sizes: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which hashes (held ``n`` times in all, over 1, by ``slot`` and others) are among the ``most`` + 1 rarest of their dealing, which has ``sizes`` of them.

    A set differs from a similar one in ``most`` of its hashes at most. So if more are held by it alone there is none, and of all others the
    rarest hash that both hold has at most so many before it, in the order of ``n`` and the hash, which is the same for all.
    """
    alone = sizes - np.bincount(slot, minlength=len(sizes))
    order = np.lexsort((token, n, slot))
    starts = np.flatnonzero(np.r_[True, slot[order][1:] != slot[order][:-1]]) if len(slot) else np.empty(0, np.int64)
    rank = np.empty(len(slot), np.int64)
    rank[order] = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
    return rank + alone[slot] <= most[slot]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over answers sorted by chunk: signatures over which similar sets meet, those of a chunk combined, so that a frequent one is sent once for each chunk."""
    for _, rows in _by(batches, 1):
        own = next(r for r in rows if r[0] < 0)
        keys, (sizes, most) = np.frombuffer(own[2], "<i8"), np.frombuffer(own[3], "<i4").reshape(2, -1)
        several, slots = np.frombuffer(own[4], "<u8"), np.frombuffer(own[5], "<u2")
        if len(rows) == 1:
            continue
        rows = [r for r in rows if r[0] >= 0]
        token = np.concatenate([np.frombuffer(r[2], "<u4") | np.uint64(r[0] << 32) for r in rows])
        slot = np.concatenate([np.frombuffer(r[3], "<u2") for r in rows]).astype(np.int64)
        n = np.concatenate([np.frombuffer(r[4], "<i8") for r in rows])
        shared = slot == _NO_SLOT
        order = np.argsort(token[shared])
        which = order[np.searchsorted(token[shared], several, sorter=order)] if len(several) else np.empty(0, np.int64)
        token, n, slot = np.r_[token[~shared], several], np.r_[n[~shared], n[shared][which]], np.r_[slot[~shared], slots]
        some = rarest(token, n, slot, sizes, most)
        if some.any():
            yield from _combined(token[some].view(np.int64), keys[slot[some]])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over rows sorted by sig: links of the keys of a signature to the first of them."""
    last, first = None, None
    for b in batches:
        if not b.num_rows:
            continue
        sig, key = b.column(0).to_numpy(), b.column(1).to_numpy()
        starts = np.r_[True, sig[1:] != sig[:-1]]
        heads = key[np.maximum.accumulate(np.where(starts, np.arange(len(sig)), 0))]
        if last == sig[0]:
            run = int(np.argmax(starts[1:])) + 1 if starts[1:].any() else len(sig)
            heads = heads.copy()
            heads[:run] = first
        apart = key != heads
        if apart.any():
            pairs = np.unique(np.stack([key[apart], heads[apart]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["src", "dst"])
        last, first = sig[-1], heads[-1]


def candidate_links(texts: DataFrame, hashes, least: float, shard_bytes: int = SHARD_BYTES, at_once: int = HASHES_AT_ONCE) -> DataFrame:
    """Links (src, dst) over which all pairs of ``texts`` (key, text) whose sets are similar are connected; ``hashes`` makes a text's set.

    Segments that no other set holds are most of all, and each is one by which any other set differs. So chunks of sets first ask how
    many hold each of theirs, 32 bits of it beyond those that name the shard; only sets that may have a similar one go on, by their rarest segments. A hash that
    clashes joins what is compared and found different later.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(20, int(size // shard_bytes).bit_length())
    asked = texts.mapInArrow(tidy(_asked(hashes, least, bits, at_once)), _SCHEMA)
    answered = asked.repartition("shard").sortWithinPartitions("shard").mapInArrow(tidy(_answered), _SCHEMA)
    signed = answered.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(tidy(_signed), "sig long, key long, head long")
    # links of a chunk are few and spread by their key, signatures by themselves
    dealt = signed.withColumn("_by", F.coalesce("sig", "key")).repartition("_by")
    return dealt.sortWithinPartitions("_by").select("sig", "key", "head").mapInArrow(tidy(_linked), "src long, dst long")


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: passes links on, and links the keys of each signature."""

    def signed() -> Iterator[pa.RecordBatch]:
        for b in batches:
            link = b.column(2).is_valid()
            found = b.filter(link)
            if found.num_rows:
                ready.append(pa.RecordBatch.from_arrays([found.column(1), found.column(2)], ["src", "dst"]))
            yield b.filter(b.column(0).is_valid()).select([0, 1])

    ready: list[pa.RecordBatch] = []
    for met in _met(signed()):
        yield from ready
        ready.clear()
        yield met
    yield from ready


def similarity(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Elements that both sorted sets hold, and that either does."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common, len(x) + len(y) - common


def connect(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: float, home: np.ndarray | None = None) -> np.ndarray:
    """Roots by which sets are connected over pairs of ``left`` and ``right`` with a similarity of ``least`` or more.

    Pairs of two sets that are not at ``home`` are compared elsewhere. Sets are cut into segments, and pairs of which too many segments differ are not compared further; nor are pairs that are connected already.
    """
    roots = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    width = 1 << max(4, min(int(np.median(sizes) // 2).bit_length(), (_AT_ONCE // len(sets)).bit_length() - 1))
    cells = np.zeros((len(sets), width), np.uint32)
    for k, s in enumerate(sets):
        if len(s):
            place, held = _segmented(s, width, 1)
            cells[k, place.astype(np.int64)] = (held >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    share = (1 - least) / (1 + least)
    step = max(1, _AT_ONCE // (width * max(1, len(right))))
    for at in range(0, len(left), step):
        i = left[at : at + step]
        both = sizes[i][:, None] + sizes[right][None, :]
        open_ = (i[:, None] < right[None, :]) | ~np.isin(i, right)[:, None]
        open_ &= np.minimum(sizes[i][:, None], sizes[right][None, :]) >= least * np.maximum(sizes[i][:, None], sizes[right][None, :]) - 1e-9
        open_ &= roots[i][:, None] != roots[right][None, :]
        if home is not None:
            open_ &= home[i][:, None] | home[right][None, :]
        if not open_.any():
            continue
        differing = np.zeros(open_.shape, np.int32)
        for w in range(0, width, 256):
            differing += (cells[i][:, None, w : w + 256] != cells[right][None, :, w : w + 256]).sum(axis=2, dtype=np.int32)
        open_ &= differing <= share * both + 1e-6
        for p, q in zip(*np.nonzero(open_), strict=True):
            a, b = i[p], right[q]
            if roots[a] != roots[b]:
                common, either = similarity(sets[a], sets[b])
                if common >= least * either:
                    merge(roots, np.array([a]), np.array([b]))
    return roots


def _connected(least: float):
    """mapInArrow function over rows (group, a, b, block, home, key, set) sorted by group, a, b: links of keys to the roots of their groups."""

    def linked(rows: list[tuple[int, bool, int, bytes]], a: int, b: int) -> pa.RecordBatch | None:
        rows.sort(key=lambda r: r[2])
        sets = [np.frombuffer(r[3], "<u8") for r in rows]
        block, home, key = (np.array([r[k] for r in rows]) for k in range(3))
        roots = connect(sets, np.flatnonzero(block == a), np.flatnonzero(block == b), least, home)
        some = np.flatnonzero(roots != np.arange(len(roots)))
        return pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(key[roots[some]])], ["src", "dst"]) if len(some) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(7)]
            for group, a, b, *row in zip(*columns, strict=True):
                if (group, a, b) != now:
                    if len(rows) > 1 and (found := linked(rows, *now[1:])) is not None:
                        yield found
                    now, rows = (group, a, b), []
                rows.append(tuple(row))
        if len(rows) > 1 and (found := linked(rows, *now[1:])) is not None:
            yield found

    return run


def similar_links(sets: DataFrame, groups: DataFrame, least: float, block_sets: int = BLOCK_SETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links (src, dst) that connect similar sets of the same group, and only those that are connected over similar pairs.

    ``sets`` has key, data (the sorted hashes) and bytes, ``groups`` id and component of the same keys. Sets of a group are compared within
    their size class, and with those of the next one that are small enough, which are sent there, too. What has more than
    ``block_sets`` sets or ``block_bytes`` is compared block by block, and a set is sent once for each block.
    """
    first = size_classes(least)[0]
    n = F.shiftright("bytes", 3)
    own = F.size(F.filter(F.lit(first), lambda f: f <= n)) - 1
    sized = groups.select(F.col("id").alias("key"), "component").join(sets.select("key", "bytes"), "key").withColumns({"n": n, "class": own})
    reach = F.get(F.lit([0, *[int(np.floor((f - 1) / least + 1e-9)) for f in first[1:]]]), F.col("class"))
    cells = F.array(F.struct(F.col("class").alias("class"), F.lit(True).alias("home")), F.struct((F.col("class") - 1).alias("class"), F.lit(False).alias("home")))
    placed = sized.select("key", "component", "bytes", F.explode(F.when((F.col("class") > 0) & (F.col("n") <= reach), cells).otherwise(F.slice(cells, 1, 1))).alias("cell"))
    placed = cut(placed.select("key", "bytes", F.xxhash64("component", "cell.class").alias("cell"), F.col("cell.home").alias("home")))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.sum("bytes").alias("total"), F.max("home").alias("some"))
    dealt = lookup(placed, "cell", cut(sizes), "n", F.col("key")).filter((F.col("n") > 1) & F.col("some"))
    blocks = F.greatest(F.ceil(F.col("n") / block_sets), F.ceil(F.col("total") / block_bytes), F.lit(1)).cast("int")
    dealt = dealt.select("key", "cell", "home", blocks.alias("blocks")).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    dealt = sets.select("key", "data").join(dealt, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = dealt.select("cell", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "home", "key", "data")
    return pairs.repartition("cell", "a", "b").sortWithinPartitions("cell", "a", "b").mapInArrow(tidy(_connected(least)), "src long, dst long")
