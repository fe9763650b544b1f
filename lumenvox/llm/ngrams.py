"""Counts of word pairs by exchange between chunks of documents and shards of keys.

Texts are coded once: a chunk of documents holds its distinct words as keys and each text as numbers
of those words. For every question a chunk sends each distinct key once to the shard that owns its
range, in order and as differences, and gets its answers back in the same order. Nothing that
one word, pair or text has in common with many others is gathered anywhere: a key that all documents
share leaves each chunk once.

Keys have as many bits as the size of the input asks for (``key_bits``), so that the share of
clashing keys is the same at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Documents and words of a chunk at most, about; a longer document is a chunk of its own.
CHUNK_DOCS, CHUNK_WORDS = 1 << 15, 1 << 20
#: Bits of a key beyond those that number all words: a word or pair clashes with another with a chance of 1 in 30,000.
SLACK_BITS = 15
_STEP_BYTES = 2 << 20
_REPEATED = np.uint64(0x5851F42D4C957F2D)


def key_bits(characters: int) -> int:
    """Bits of keys for texts of so many characters together."""
    return min(64, max(24, math.ceil(math.log2(max(2, characters / 4))) + SLACK_BITS))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(*columns: np.ndarray, kind: str = "<i8") -> bytes:
    """Columns of whole numbers as compressed byte planes."""
    import zstandard

    size = np.dtype(kind).itemsize
    planes = [np.ascontiguousarray(c).astype(kind, copy=False).view(np.uint8).reshape(-1, size).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def unpacked(data: bytes, n: int, columns: int, kind: str = "<i8") -> list[np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, np.dtype(kind).itemsize, n)
    return [np.ascontiguousarray(c.T).view(kind).reshape(n) for c in raw]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row after the other, without copies of a whole batch."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and how many each text has.

    Words stand between white space; they count in small letters and without one sign that ends them.
    A word that equals the one before it is another word.
    """
    import xxhash

    parts = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
    lengths = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    words = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"[.,;:!?]$", "").to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))
    if len(words) and (empty := pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)).any():
        # a text of white space alone has one empty part
        gone = empty[coded.indices.to_numpy()]
        lengths -= np.bincount(np.repeat(np.arange(len(lengths)), lengths)[gone], minlength=len(lengths))
        found = hashes[coded.indices.to_numpy()[~gone]]
    else:
        found = hashes[coded.indices.to_numpy()]
    same = np.flatnonzero(found[1:] == found[:-1]) + 1
    starts = np.cumsum(lengths) - lengths
    same = same[~np.isin(same, starts[lengths > 0])]
    repeats = found.copy()
    repeats[same] ^= _REPEATED
    return repeats, lengths


CODED = "chunk long, words long, n_docs int, docs binary, n_keys int, keys binary, tokens binary"
_CODED = pa.schema([("chunk", pa.int64()), ("words", pa.int64()), ("n_docs", pa.int32()), ("docs", pa.binary()), ("n_keys", pa.int32()), ("keys", pa.binary()), ("tokens", pa.binary())])


def coded(bits: int, chunk_words: int = CHUNK_WORDS, chunk_docs: int = CHUNK_DOCS):
    """mapInArrow function: (id, content, language, text) to chunks (``CODED``); no column is null but id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, nth = TaskContext.get().partitionId() << 32, 0
        docs: list[tuple[np.ndarray, ...]] = []
        keys: list[np.ndarray] = []
        n_docs = n_words = 0

        def chunk() -> pa.RecordBatch:
            meta = [np.concatenate(c) for c in zip(*docs, strict=True)]
            every, token, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            rank = np.empty(len(every), np.int64)
            rank[np.lexsort((np.arange(len(every)), -count))] = np.arange(len(every))
            row = [base + nth, n_words, n_docs, packed(*meta), len(every), packed(np.diff(every, prepend=np.uint64(0)).view(np.int64), count), packed(rank[token], kind="<i4")]
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _CODED, strict=True)], schema=_CODED)

        for whole in batches:
            upto = np.cumsum(pc.binary_length(whole.column(3)).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < whole.num_rows:
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + _STEP_BYTES, "right")))
                b = whole.slice(at, min(stop - at, chunk_docs))
                at += b.num_rows
                ids = pc.fill_null(b.column(0), 0).to_numpy()
                content, language = b.column(1).to_numpy(), b.column(2).to_numpy()
                words, lengths = words_of(b.column(3))
                if docs and (n_words + len(words) > chunk_words or n_docs + b.num_rows > chunk_docs):
                    yield chunk()
                    docs, keys, n_docs, n_words, nth = [], [], 0, 0, nth + 1
                # a boundary goes before and after each text
                token = np.zeros(len(words) + 2 * len(lengths), np.uint64)
                place = np.arange(len(words)) + np.repeat(2 * np.arange(len(lengths)) + 1, lengths)
                token[place] = words
                token = mixed(token ^ mixed(np.repeat(language, lengths + 2).view(np.uint64))) >> np.uint64(64 - bits)
                docs.append((ids, np.asarray(b.column(0).is_valid()).astype(np.int64), content, language, lengths))
                keys.append(token)
                n_docs, n_words = n_docs + b.num_rows, n_words + len(words)
        if docs:
            yield chunk()

    return run


def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, n_docs, docs) to chunk, place, id, content, language of each document."""
    for b in batches:
        for chunk, n, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
            ids, known, content, language, _ = unpacked(docs, n, 5)
            columns = [pa.array(np.full(n, chunk)), pa.array(np.arange(n)), pa.array(ids, mask=known == 0), pa.array(content), pa.array(language)]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "place", "id", "content", "language"])


class Chunk:
    """A coded chunk: content, language, lengths of documents; keys of words; and its distinct pairs of words.

    ``first`` and ``second`` number the words of each pair, ``pair`` gives the distinct pair at
    each place of a text and ``doc`` the document there. Words and pairs are in order of language and key.
    """

    def __init__(self, row: dict, bits: int) -> None:
        n = row["n_docs"]
        _, _, self.content, self.language, self.lengths = unpacked(row["docs"], n, 5)
        step, count = unpacked(row["keys"], row["n_keys"], 2)
        keys = np.cumsum(step.view(np.uint64), dtype=np.uint64)
        by_count = np.lexsort((np.arange(len(keys)), -count))
        token = by_count.astype(np.int32)[unpacked(row["tokens"], int(self.lengths.sum()) + 2 * n, 1, "<i4")[0]]
        doc = np.repeat(np.arange(n, dtype=np.int32), self.lengths + 2)
        self.languages, of_doc = np.unique(self.language, return_inverse=True)
        self.of_doc = of_doc
        # words of a language together, since they travel so
        of_word = np.zeros(len(keys), np.int64)
        of_word[token] = of_doc[doc]
        order = np.argsort(of_word, kind="stable")
        self.word_keys, self.of_word = keys[order], of_word[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        token = place[token]
        inner = np.flatnonzero(doc[1:] == doc[:-1])
        inner = inner[self.lengths[doc[inner]] > 0]  # a text without words has no pairs
        a, b, self.doc = token[inner], token[inner + 1], doc[inner].astype(np.int64)
        del token, doc, inner
        hashed = mixed(self.word_keys[a] * np.uint64(0x9E3779B97F4A7C15) + mixed(self.word_keys[b])) >> np.uint64(64 - bits)
        pair_keys, at, pair = np.unique(hashed, return_index=True, return_inverse=True)
        del hashed
        of_pair = of_doc[self.doc[at]]
        order = np.argsort(of_pair, kind="stable")
        self.pair_keys, self.of_pair = pair_keys[order], of_pair[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        self.pair, at = place[pair], at[order]
        self.first, self.second = a[at], b[at]


def _edges(shards: int, bits: int) -> np.ndarray:
    return np.array([-(-(s << bits) // shards) for s in range(shards)], np.uint64)


def _parts(languages: np.ndarray, of_key: np.ndarray, keys: np.ndarray, shards: int, bits: int) -> Iterator[tuple[int, int, int, int]]:
    """(language, shard, from, to) of the keys that go together."""
    edges = _edges(shards, bits)
    bounds = np.searchsorted(of_key, np.arange(len(languages) + 1))
    for language, lo, hi in zip(languages.tolist(), bounds, bounds[1:], strict=False):
        cuts = np.r_[lo + np.searchsorted(keys[lo:hi], edges), hi]
        for shard in np.flatnonzero(np.diff(cuts)):
            yield language, int(shard), int(cuts[shard]), int(cuts[shard + 1])


MESSAGE = "shard int, chunk long, language long, n int, data binary"
_MESSAGE = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("language", pa.int64()), ("n", pa.int32()), ("data", pa.binary())])


def asked(chunk: int, languages: np.ndarray, of_key: np.ndarray, keys: np.ndarray, columns: list[np.ndarray], shards: int, bits: int) -> pa.RecordBatch:
    """A message to each shard: keys in order, with columns of numbers."""
    edges, rows = _edges(shards, bits), []
    for language, shard, lo, hi in _parts(languages, of_key, keys, shards, bits):
        step = np.diff(keys[lo:hi], prepend=edges[shard]).view(np.int64)
        rows.append((shard, chunk, language, hi - lo, packed(step, *(c[lo:hi] for c in columns))))
    return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, _MESSAGE, strict=True)], schema=_MESSAGE)


def heard(answers: list[dict] | None, languages: np.ndarray, of_key: np.ndarray, keys: np.ndarray, columns: int, shards: int, bits: int) -> list[np.ndarray]:
    """What the shards answered for each key."""
    out = [np.zeros(len(keys), np.int64) for _ in range(columns)]
    by_part = {(a["language"], a["shard"]): a for a in answers or []}
    for language, shard, lo, hi in _parts(languages, of_key, keys, shards, bits):
        a = by_part[language, shard]  # each message has its answer
        for o, found in zip(out, unpacked(a["data"], hi - lo, columns), strict=True):
            o[lo:hi] = found
    return out


#: chunk -1 - shard marks the numbers that a shard gives of a language.
ANSWER = "shard int, chunk long, language long, n int, data binary, counts array<long>"
_ANSWER = pa.schema([*_MESSAGE, ("counts", pa.list_(pa.int64()))])


def answered(columns: int, summed, shards: int, bits: int):
    """mapInArrow function of a shard: messages to answers and, of each language, numbers.

    ``summed(inverse, columns, n)`` gets the key of each row as a number below n and gives the
    columns to answer and the numbers.
    """
    edges = _edges(shards, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[tuple[int, int], list[dict]] = {}
        for row in rows_of(batches):
            by.setdefault((row["shard"], row["language"]), []).append(row)
        for (shard, language), rows in sorted(by.items()):
            rows.sort(key=lambda r: r["chunk"])
            parts = [unpacked(r["data"], r["n"], 1 + columns) for r in rows]
            keys = np.concatenate([edges[shard] + np.cumsum(p[0].view(np.uint64), dtype=np.uint64) for p in parts])
            given = [np.concatenate(c) for c in list(zip(*parts, strict=True))[1:]]
            distinct, inverse = np.unique(keys, return_inverse=True)
            out, counts = summed(inverse, given, len(distinct))
            ends = np.cumsum([r["n"] for r in rows])
            for r, hi in zip(rows, ends.tolist(), strict=True):
                row = [shard, r["chunk"], language, r["n"], packed(*(o[hi - r["n"] : hi] for o in out)), None]
                yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _ANSWER, strict=True)], schema=_ANSWER)
            row = [shard, -1 - shard, language, 0, None, [int(x) for x in counts]]
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _ANSWER, strict=True)], schema=_ANSWER)

    return run
