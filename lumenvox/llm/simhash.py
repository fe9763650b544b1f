"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints within a few bits of each other agree in at least one of a few equal blocks of
bits. So the fingerprints go into one trie for each block, with that block's bits first: below a
node at the end of the block the whole error budget is left, and above it there is none, which
makes the node's key a shuffle key. Below it a task walks pairs of nodes together from the top,
adds up the bits in which the branches differ and prunes a pair of nodes that exceeds the budget.

``near_duplicates`` links what is within the budget. ``similar_documents`` links documents whose word shingles are
similar enough; a budget of few bits finds only a part of them, so that the others are found by the shingles themselves (``set_links``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.llm.common import FEW_KEYS, SWEPT, cut, lookup, settings, text_of, tidy
from lumenvox.llm.components import components
from lumenvox.llm.set_links import candidate_links, similar_links
from lumenvox.llm.unions import merge

#: Fingerprints below one trie node that one task still joins; larger nodes are split by a block of their remaining bits.
NODE_ROWS = 4096
#: Times that bits are taken off a fingerprint for the shuffle key.
SPLITS = 3
#: Node pairs with at most so many fingerprint pairs are compared directly.
LEAF_PAIRS = 256
_PAIRS_AT_ONCE = 1 << 21
_SHINGLES_AT_ONCE = 1 << 16


@dataclass(frozen=True)
class Fingerprint:
    """Which shingles a fingerprint is made of.

    Shingles are hashed by XXH64 with seed 42. ``distinct``: each shingle counts once. ``turn``:
    0 takes the hashes as they are, other values give independent fingerprints of the same shingles.
    """

    words: int = 3
    distinct: bool = False
    turn: int = 0


#: Words of a shingle and least share of common shingles of near copies in a corpus, and bits by which fingerprints of their sets may differ.
SHINGLE_WORDS, SIMILARITY, CORPUS_BUDGET = 5, 0.8, 3


def shingle_hashes(text: bytes, words: int = 3) -> list[int]:
    """XXH64 (seed 42) of each shingle of a UTF-8 text with A-Z lower-cased; a shorter text is one shingle."""
    import xxhash

    found = text.lower().split()  # of bytes: only ASCII letters and ASCII white space
    if not found:
        return []
    k = min(words, len(found))
    joined = b" ".join(found)
    starts = list(accumulate((len(w) + 1 for w in found), initial=0))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s : e - 1], 42) for s, e in zip(starts, starts[k:], strict=False)]


def _turned(hashes: np.ndarray, turn: int) -> np.ndarray:
    if not turn:
        return hashes
    h = (hashes ^ np.uint64(turn * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(29))


def _majority(hashes: np.ndarray) -> int:
    """64 bits, each set if it is in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _SHINGLES_AT_ONCE):
        some = hashes[at : at + _SHINGLES_AT_ONCE]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text: bytes, kinds: tuple[Fingerprint, ...] = (Fingerprint(),)) -> list[int]:
    """64-bit SimHash of each kind; 0 for a text without words."""
    import xxhash

    hashes: dict[tuple[int, bool], np.ndarray] = {}
    for kind in kinds:
        if (key := (kind.words, kind.distinct)) not in hashes:
            if key == (1, True):
                every = np.array([xxhash.xxh64_intdigest(w, 42) for w in set(text.lower().split())], "<u8")
            else:
                every = np.array(shingle_hashes(text, kind.words), "<u8")
            hashes[key] = np.unique(every) if kind.distinct else every
    return [_majority(_turned(h, kind.turn)) if len(h := hashes[kind.words, kind.distinct]) else 0 for kind in kinds]


def fingerprints(docs: DataFrame, kinds: tuple[Fingerprint, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text) and a fingerprint f0, f1, ... (as a signed long) of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.zeros((len(kinds), b.num_rows), np.uint64)
            for i, text in enumerate(b.column(2)):
                found[:, i] = simhash(text.as_buffer().to_pybytes(), kinds)
            columns = [pa.array(f.view(np.int64)) for f in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], ["doc_id", "text_key", *[f"f{k}" for k in range(len(kinds))]])

    schema = "doc_id long, text_key long, " + ", ".join(f"f{k} long" for k in range(len(kinds)))
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(tidy(run), schema)


def _split(width: int, blocks: int) -> Column:
    """For each block of ``width`` bits of ``rest``: the path with that block appended, and the other bits."""
    path, rest = F.col("path"), F.col("rest")
    parts = []
    for r in range(blocks):
        below = rest.bitwiseAND(F.lit((1 << (r * width)) - 1).cast("long"))
        block = F.shiftrightunsigned(rest, r * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        above = F.shiftrightunsigned(rest, (r + 1) * width) if (r + 1) * width < 64 else F.lit(0).cast("long")
        left = below.bitwiseOR(F.shiftleft(above, r * width))
        parts.append(F.struct(((path * blocks + r) * (1 << width) + block).alias("path"), left.alias("rest"), F.col("fp")))
    return F.explode(F.array(*parts))


def _node_pairs(paths: np.ndarray, rests: np.ndarray, bits: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (as indices) below the same node whose ``rests`` differ in at most ``budget`` bits.

    Rows are sorted by path and rest, so a trie node is a range of rows. All nodes of a level are
    walked at once; the pairs still open are kept on a stack of bounded pieces.
    """
    starts = np.flatnonzero(np.r_[True, paths[1:] != paths[:-1]]) if len(paths) else np.empty(0, np.int64)
    ends = np.r_[starts[1:], len(paths)]
    several = ends - starts > 1
    starts, ends = starts[several], ends[several]
    zero = np.zeros(len(starts), np.int64)
    stack = [(0, starts, ends, starts, ends, zero)]
    while stack:
        depth, a0, a1, b0, b1, err = stack.pop()
        if not len(a0):
            continue
        small = ((a1 - a0) * (b1 - b0) <= LEAF_PAIRS) | (depth == bits)
        yield from _leaves(rests, a0[small], a1[small], b0[small], b1[small], budget)
        a0, a1, b0, b1, err = (x[~small] for x in (a0, a1, b0, b1, err))
        if not len(a0):
            continue
        if len(a0) > 1 << 16:
            half = len(a0) // 2
            stack.append((depth, *(x[half:] for x in (a0, a1, b0, b1, err))))
            a0, a1, b0, b1, err = (x[:half] for x in (a0, a1, b0, b1, err))
        am, bm = _middle(rests, a0, a1, bits - 1 - depth), _middle(rests, b0, b1, bits - 1 - depth)
        self_pair = a0 == b0
        kinds = (
            (a0, am, b0, bm, err, np.ones(len(a0), bool)),
            (am, a1, bm, b1, err, np.ones(len(a0), bool)),
            (a0, am, bm, b1, err + 1, np.ones(len(a0), bool)),
            (am, a1, b0, bm, err + 1, ~self_pair),  # of a node with itself it is the same as the one before
        )
        parts = []
        for x0, x1, y0, y1, e, used in kinds:
            keep = used & (x1 > x0) & (y1 > y0) & (e <= budget) & ~((x0 == y0) & (x1 - x0 < 2))
            parts.append([x[keep] for x in (x0, x1, y0, y1, e)])
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))


def _middle(rests: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """The first row of each range with ``bit`` set; rows of a range share all higher bits and are sorted."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        ones = (rests[np.minimum(mid, len(rests) - 1)] >> np.uint64(bit)) & np.uint64(1) == 1
        hi = np.where(open_ & ones, mid, hi)
        lo = np.where(open_ & ~ones, mid + 1, lo)
    return lo


def _leaves(rests: np.ndarray, a0, a1, b0, b1, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of small node pairs, compared one by one."""
    sizes = (a1 - a0) * (b1 - b0)
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, done + _PAIRS_AT_ONCE, "right")))
        part = slice(at, upto)
        n = sizes[part]
        which = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        width = (b1[part] - b0[part])[which]
        i, j = a0[part][which] + nth // width, b0[part][which] + nth % width
        near = (i < j) | (a0[part] != b0[part])[which]
        i, j = i[near], j[near]
        near = np.bitwise_count(rests[i] ^ rests[j]) <= budget
        if near.any():
            yield i[near], j[near]
        at = upto


def _joined(bits: int, budget: int):
    """mapInArrow function over whole nodes (path, rest, fp: what the links name): links that connect what is connected below each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[np.asarray(b.column(i)) for i in range(3)] for b in batches if b.num_rows]
        if not parts:
            return
        path, rest, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
        rest = rest.view(np.uint64)
        order = np.lexsort((rest, path))
        path, rest, fp = path[order], rest[order], fp[order]
        roots = np.arange(len(fp))
        for i, j in _node_pairs(path, rest, bits, budget):
            merge(roots, i, j)
        linked = np.flatnonzero(roots != np.arange(len(fp)))
        for at in range(0, len(linked), 1 << 16):
            some = linked[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(fp[some]), pa.array(fp[roots[some]])], ["src", "dst"])

    return run


def fingerprint_links(fps: DataFrame, budget: int = 3, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (src, dst) that connect fingerprints ``fp`` (64 bits as a long) of one ``kind`` within ``budget`` bits.

    ``fps`` has kind, fp and node, the id by which a link names the fingerprint; rows are distinct. Fingerprints that are reachable from each other over pairs within the budget are reachable
    over these links and no others are; a node's links are as few as its rows. A node with more
    than ``node_rows`` fingerprints is split again by a block of its remaining bits.
    """
    blocks, bits, splits = budget + 1, 64, 0
    rows = fps.select(F.col("kind").cast("long").alias("path"), F.col("fp").alias("rest"), F.col("node").alias("fp"))
    links = None
    while True:
        width = bits // blocks
        rows = rows.select(_split(width, blocks).alias("s")).select("s.*")
        bits, splits = bits - width, splits + 1
        here, deeper = rows, None
        if splits < SPLITS:
            crowded = cut(rows.groupBy("path").agg(F.count("*").alias("n")).filter(F.col("n") > node_rows).select("path"))
            if not crowded.isEmpty():
                here, deeper = rows.join(crowded, "path", "left_anti"), cut(rows.join(crowded, "path", "left_semi"))
        found = here.repartition("path").mapInArrow(_joined(bits, budget), "src long, dst long")
        links = found if links is None else links.unionByName(found)
        if deeper is None:
            return links
        rows = deeper


def near_duplicates(docs: DataFrame, kinds: tuple[Fingerprint, ...] = (Fingerprint(),), budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, f0, f1, ... and component_id.

    Documents are linked when a fingerprint of any of ``kinds`` differs in at most ``budget``
    bits; component_id is the smallest doc_id reachable, itself included. Null and empty texts
    and texts without words have fingerprint 0 and are linked like any other. Null ids are
    linked but never a component_id, unless a component has no other. Equal rows, ties and
    repeated ids are rows of their own; an empty table gives no rows; other columns are not read.
    """
    rows = cut(fingerprints(docs, kinds, id_col, text_col))
    names = [f"f{k}" for k in range(len(kinds))]
    single = len(kinds) == 1
    # a node of the graph is a fingerprint, or for several kinds a hash of kind and fingerprint
    node = (lambda k: F.col(f"f{k}")) if single else (lambda k: F.xxhash64(F.lit(k), F.col(f"f{k}")))
    rows = rows.withColumn("node", node(0))
    classes = cut(rows.groupBy("node", *names).agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    fps = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"f{k}").alias("fp"), node(k).alias("node")) for k in range(len(kinds))])).alias("s")
    links = fingerprint_links(classes.select(fps).select("s.*").distinct(), budget)
    for k in range(1, len(kinds)):  # what one document has of several kinds belongs together
        links = links.unionByName(classes.select(F.col("node").alias("src"), node(k).alias("dst")))
    linked = components(links)
    nodes = classes.groupBy("node").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    nodes = cut(nodes.join(linked.select(F.col("id").alias("node"), "component"), "node", "left"))
    smallest = nodes.filter("component is not null").groupBy("component").agg(F.min("first").alias("smallest"))
    ids = nodes.join(smallest, "component", "left").select("node", "n", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id"))
    found = lookup(rows, "node", cut(ids), "n", F.xxhash64("doc_id", "node"))
    return found.select("doc_id", "text_key", *names, "component_id")


def hex_digits(column: str) -> Column:
    """A 64-bit value as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def _shingled(words: int):
    """mapInArrow function: (key, text) to the sorted hashes of each text's distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(np.array(shingle_hashes(t.as_buffer().to_pybytes(), words), "<u8")).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["key", "data"])

    return run


def _few(keys: DataFrame) -> DataFrame:
    """``keys`` to pick rows by, broadcast if they are few."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def _keys(text: Column) -> list[Column]:
    """Two hashes by which a text is known."""
    return [F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_check")]


def _named(texts: DataFrame, clashes: DataFrame | None) -> DataFrame:
    """``texts`` with key: text_key, but a hash of both hashes for all but one of the texts that share it."""
    if clashes is None:
        return texts.withColumn("key", F.col("text_key"))
    joined = texts.join(_few(clashes), "text_key", "left")
    return joined.withColumn("key", F.when(F.col("text_check") != F.col("stays"), F.xxhash64("text_check", "text_key")).otherwise(F.col("text_key"))).drop("stays")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, words: int = SHINGLE_WORDS, budget: int = CORPUS_BUDGET) -> DataFrame:
    """Rows (text_key, text_check, component_id, first, rows) of the texts of ``docs``: the smallest doc_id reachable over links, the text's smallest id and how many rows have both.

    Texts are linked when the Jaccard similarity of their distinct shingles of ``words`` words is at least ``least``: all of them, in groups of any size.
    Candidates are texts whose fingerprints of these shingles differ in at most ``budget`` bits, and, since that misses most pairs near
    ``least``, texts that share a segment of their shingles, as all similar pairs do. What is reachable over candidates is compared by
    its shingles. Texts are known by two 64-bit hashes. Equal texts are one text, null counts as the empty one; texts without words
    have no shingles and are similar to each other only; very long texts are taken whole; null ids count only where a text has no other.
    """
    with settings(docs.sparkSession, SWEPT):  # the signatures are the largest of all shuffles
        return _similar_documents(docs, id_col, text_col, least, words, budget)


def _similar_documents(docs: DataFrame, id_col: str, text_col: str, least: float, words: int, budget: int) -> DataFrame:
    kind = Fingerprint(words, distinct=True)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_keys(text), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t.as_buffer().to_pybytes(), (kind,))[0] for t in b.column(3)], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fp.view(np.int64))], ["doc_id", "text_key", "text_check", "fp"])

    rows = cut(rows.mapInArrow(tidy(run), "doc_id long, text_key long, text_check long, fp long"))
    texts = rows.groupBy("text_key", "text_check", "fp").agg(F.min("doc_id").alias("first"))
    clashes = cut(texts.groupBy("text_key").agg(F.count("*").alias("n"), F.min("text_check").alias("stays")).filter("n > 1").drop("n"))
    clashes = None if clashes.isEmpty() else clashes
    texts = cut(_named(texts, clashes))
    heads = cut(texts.groupBy("fp").agg(F.min("key").alias("node")))
    equal = texts.join(heads, "fp").filter("key <> node").select(F.col("key").alias("src"), F.col("node").alias("dst"))
    near = fingerprint_links(heads.select(F.lit(0).alias("kind"), "fp", "node"), budget)
    whole = _named(docs.select(*_keys(text), text.alias("text")), clashes).select("key", "text")
    candidates = candidate_links(whole, lambda t: shingle_hashes(t, words), least)
    groups = components(equal.unionByName(near).unionByName(candidates))
    sets = whole.join(_few(groups.select(F.col("id").alias("key"))), "key", "left_semi").mapInArrow(tidy(_shingled(words)), "key long, data binary")
    sets = cut(sets.groupBy("key").agg(F.first("data").alias("data")).withColumn("bytes", F.octet_length("data").cast("long")))
    linked = components(similar_links(sets, groups, least))
    texts = texts.join(linked.withColumnRenamed("id", "key"), "key", "left")
    smallest = texts.filter("component is not null").groupBy("component").agg(F.min("first").alias("smallest"))
    ids = texts.join(smallest, "component", "left").select("text_key", "text_check", "first", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id"))
    counts = rows.groupBy(F.col("text_key").alias("_key"), F.col("text_check").alias("_check"), "doc_id").agg(F.count("*").alias("rows"))
    same = F.col("first").eqNullSafe(F.col("doc_id")) & (F.col("text_key") == F.col("_key")) & (F.col("text_check") == F.col("_check"))
    return cut(ids.join(counts, same).select("text_key", "text_check", "first", "component_id", "rows"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of ``similar_documents``, one with the smallest id; columns stay.

    Null counts as the empty text; of equal rows and repeated ids one stays; a row with a null id stays only where
    its group has no other; very long texts are compared whole; an empty table gives no rows.
    """
    groups = similar_documents(docs, id_col, text_col, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key, check = _keys(text_of(text_col))
    rows = docs.select(row, F.col(id_col).cast("long").alias("_id"), key.alias("_key"), check.alias("_check"))
    # most texts are alone and have one row: all other texts are few, or their rows are shuffled
    best = F.min(F.struct(F.col("first").isNull(), "first", "text_key", "text_check"))
    together = groups.groupBy("component_id").agg(F.count("*").alias("n"), best.alias("best"))
    stays = (F.col("best.text_key") == F.col("text_key")) & (F.col("best.text_check") == F.col("text_check"))
    joined = groups.join(together, groups["component_id"].eqNullSafe(together["component_id"])).select("text_key", "text_check", "rows", "n", F.col("best.first").alias("_first"), stays.alias("_stays"))
    alone = rows.groupBy("_key", "_check").agg(F.count("*").alias("_rows"))
    known = (F.col("text_key") == F.col("_key")) & (F.col("text_check") == F.col("_check"))
    odd = cut(joined.join(alone, known).filter("n > 1 or _rows > 1").select("text_key", "text_check", "_first", "_stays", "rows"))
    if odd.isEmpty():
        return docs
    kept = rows.join(_few(odd.select("text_key", "text_check")), known, "left_anti")
    some = rows.join(_few(odd.filter("_stays")), known & F.col("_id").eqNullSafe(F.col("_first")))
    if odd.filter("_stays and rows > 1").isEmpty():
        return kept.select("row.*").unionByName(some.select("row.*"))
    one = some.filter("rows > 1").groupBy("_key", "_check").agg(F.first("row").alias("row"))
    return kept.select("row.*").unionByName(some.filter("rows = 1").select("row.*")).unionByName(one.select("row.*"))
