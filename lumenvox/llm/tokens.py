"""Encoding texts with a public tokenizer inside Spark tasks.

A column of texts is cut where no token can span and dictionary-encoded as a whole; each distinct
piece is encoded once by the tokenizers library, many of them joined to one text by a separator
whose id tells them apart, and the ids of all pieces are gathered from one flat buffer. Pieces of
Latin letters go to the tokenizer's model at once, since its rules leave them whole. Pieces stay known for the rest of the task, within a bound of ids, so a worker's memory
grows neither with the input nor from task to task.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ids that the pieces known to a task have at most before they are forgotten.
KNOWN_IDS = 3_000_000
#: Bytes of text whose pieces are looked up together.
STEP_BYTES = 4 << 20
_AT_ONCE, _JOINED = 5_000, 100
#: Signs that end a piece of letters; they are tokens of their own there.
_TAILS = (",", ".")
#: What a piece must not have to be joined with others: white space and the separators themselves.
_ODD = re.compile(r"\S*[\s|\x1c-\x1f\x85]|$")
_CUT = re.compile(r"(?<=\S) ")
#: Letters that normalization at most makes small, one by one: Latin ones without the dotted capital I.
_LATIN = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"
#: Such a word with a final sign or none, or two of them with a line feed between; the tokenizer's pattern cuts there.
_WORDS = re.compile(rf"({_LATIN})([,.]?)(?:(\n)({_LATIN})([,.]?))?")
#: How a byte-level vocabulary writes the space and the bytes of letters.
_SPACE = "Ġ"
_BYTES = {0xAD: 0x143, **{b: b + 0xA2 for b in range(0x80, 0xA1)}}
_PROBES = ("the", "Zebra", "Größe", "ñandúÀÉ", "łódźŠ", "xqzjkw")
#: A space at the start or after white space: there a cut at each space would break a run of white space.
_RUN = r"^ |[\s\x0b\x1c-\x1f\x{85}\p{Z}] "


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The worker's tokenizer of a file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceEncoder:
    """ids of texts as little-endian unsigned 32-bit integers.

    ``keeps_space``: the tokenizer's pattern gives a single space to the word after it, so texts
    are cut before a space that follows anything but white space. Otherwise the tokenizer drops
    white space, and texts are cut at every space and line feed. One encoder serves one task.
    """

    def __init__(self, path: str, keeps_space: bool) -> None:
        self.tokenizer = _tokenizer(path)
        self.keeps_space = keeps_space
        self.folds = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("A") == "a"
        self.tails = {t: self.tokenizer.encode(t, add_special_tokens=False).ids for t in _TAILS}
        self.separator = "\n" if keeps_space else " | "
        ids = self.tokenizer.encode(self.separator, add_special_tokens=False).ids
        self.separator_id = ids[0] if len(ids) == 1 else None
        self.model = self.tokenizer.model
        self.direct = all(self._of_letters(p, b) == self.tokenizer.encode(" " * b + p, add_special_tokens=False).ids for p in _PROBES for b in {keeps_space, False})
        self.lines = keeps_space and self.direct and self.separator_id is not None
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.begins: dict[str, int] = {}
        self.flat, self.ends = array("I"), array("q", [0])

    def _encoded(self, texts: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(texts), _AT_ONCE):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + _AT_ONCE], add_special_tokens=False):
                yield found.ids

    def _add(self, texts: list[str]) -> int:
        """Encode ``texts`` one by one into the flat buffer; the slot of the first."""
        first = len(self.ends) - 1
        for ids in self._encoded(texts):
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        return first

    def _of_letters(self, word: str, spaced: bool) -> list[int]:
        """ids of Latin letters, with a space before them or not, by the model alone."""
        if self.folds:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        return [t.id for t in self.model.tokenize(_SPACE + word if spaced else word)]

    def _of_words(self, pieces: list[str]) -> list[str]:
        """Remember pieces of Latin words, put together from the ids of their letters and signs; the other pieces."""
        slots, begins, flat, ends = self.slots, self.begins, self.flat, self.ends
        other: list[str] = []
        for p in pieces:
            m = _WORDS.fullmatch(p)
            if m is None or (m[3] and not self.lines):
                other.append(p)
                continue
            word, sign, line, second, last = m.groups()
            if (slot := slots.get(word)) is None:
                slot = slots[word] = len(ends) - 1
                flat.extend(self._of_letters(word, self.keeps_space))
                ends.append(len(flat))
            if len(word) == len(p):
                continue
            if line and (begin := begins.get(second)) is None:
                begin = begins[second] = len(ends) - 1
                flat.extend(self._of_letters(second, False))
                ends.append(len(flat))
            flat.extend(flat[ends[slot] : ends[slot + 1]])
            if sign:
                flat.extend(self.tails[sign])
            if line:
                flat.append(self.separator_id)
                flat.extend(flat[ends[begin] : ends[begin + 1]])
                if last:
                    flat.extend(self.tails[last])
            slots[p] = len(ends) - 1
            ends.append(len(flat))
        return other

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that a space or nothing goes before, and remember them."""
        before = " " if self.keeps_space else ""
        if self.direct:
            pieces = self._of_words(pieces)
        tailed = [p for p in pieces if p[-1:] in self.tails and p[:-1].isalpha()]
        cores = {p[:-1] for p in tailed}.union(set(pieces).difference(tailed)).difference(self.slots)
        joined: list[str] = []
        odd: list[str] = []
        for p in cores:
            (odd if self.separator_id is None or _ODD.match(p) else joined).append(p)
        groups = [joined[at : at + _JOINED] for at in range(0, len(joined), _JOINED)]
        texts = [self.separator.join([before + p for p in some]) for some in groups]
        for some, ids in zip(groups, self._encoded(texts), strict=True):
            cuts = [i for i, x in enumerate(ids) if x == self.separator_id]
            if len(cuts) != len(some) - 1:
                odd += some
                continue
            base = len(self.flat)
            self.slots.update(zip(some, range(len(self.ends) - 1, len(self.ends) - 1 + len(some)), strict=True))
            # the separators are left out, so each piece moves up by those before it
            self.flat.extend([x for x in ids if x != self.separator_id])
            self.ends.extend([base + c - i for i, c in enumerate(cuts)])
            self.ends.append(len(self.flat))
        first = self._add([before + p for p in odd])
        self.slots.update(zip(odd, range(first, first + len(odd)), strict=True))
        for p in tailed:
            slot = self.slots[p[:-1]]
            self.slots[p] = len(self.ends) - 1
            self.flat.extend(self.flat[self.ends[slot] : self.ends[slot + 1]])
            self.flat.extend(self.tails[p[-1]])
            self.ends.append(len(self.flat))

    def _slots(self, pieces: pa.Array) -> np.ndarray:
        """The slot of each piece; those seen for the first time are encoded."""
        coded = pieces.dictionary_encode()
        words = coded.dictionary
        if self.folds:  # ASCII letters count in small letters
            words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        words = _strings(words)
        found = list(map(self.slots.get, words))
        if missing := [w for w, slot in zip(words, found, strict=True) if slot is None]:
            self._learn(missing)
            found = [self.slots[w] if slot is None else slot for w, slot in zip(words, found, strict=True)]
        return np.array(found, np.int64)[coded.indices.to_numpy()]

    def _gathered(self, pieces: pa.Array, starts: np.ndarray, first: list[str] | None, end_id: int | None) -> Iterator[np.ndarray]:
        """ids of texts that own ``pieces`` from one start to the next; ``first``: each text's first piece, which no space goes before."""
        slots = self._slots(pieces)
        if first is not None:
            at = self._add(first)
            slots[starts[:-1]] = np.arange(at, at + len(first))
        if end_id is not None:
            slots = np.insert(slots, starts[1:], len(self.ends) - 1)
            starts = starts + np.arange(len(starts))
            self.flat.append(end_id)
            self.ends.append(len(self.flat))
        flat, ends = np.array(self.flat, "<u4"), np.array(self.ends)
        begin = ends[slots]
        length = ends[slots + 1] - begin
        upto = np.r_[0, np.cumsum(length)]
        ids = flat[np.repeat(begin - upto[:-1], length) + np.arange(upto[-1])]
        bounds = upto[starts]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield ids[a:b]

    def _step(self, texts: pa.Array, end_id: int | None) -> Iterator[np.ndarray]:
        if len(self.flat) > KNOWN_IDS:
            self._forget()
        if not self.keeps_space:
            parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            yield from self._gathered(parts.flatten(), _starts(parts), None, end_id)
            return
        slow = pc.match_substring_regex(texts, _RUN)
        parts = pc.split_pattern(texts.filter(pc.invert(slow)), " ")
        starts, pieces = _starts(parts), parts.flatten()
        plain = self._gathered(pieces, starts, _strings(pieces.take(pa.array(starts[:-1]))), end_id)
        split = [_CUT.split(t) for t in texts.filter(slow).to_pylist()]
        starts = np.cumsum([0, *map(len, split)])
        spaced = self._gathered(pa.array([p for parts in split for p in parts], pa.string()), starts, [parts[0] for parts in split], end_id)
        for is_slow in slow.to_pylist():
            yield next(spaced if is_slow else plain)

    def encode(self, texts: pa.Array, end_id: int | None = None) -> Iterator[np.ndarray]:
        """ids of each text of a column, null as the empty text, with ``end_id`` after them if it is given."""
        texts = pc.fill_null(texts, "")
        upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP_BYTES, "right")))
            yield from self._step(texts.slice(at, stop - at), end_id)
            at = stop


def _starts(parts: pa.ListArray) -> np.ndarray:
    """Where each list begins and the last one ends in the flattened values."""
    return np.r_[0, np.cumsum(parts.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]


def _strings(column: pa.Array) -> list[str]:
    """The values as a list, without a scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
