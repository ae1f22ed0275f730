"""Words and their 64-bit hashes, a block of texts at a time, in numpy.

A word is a run of characters other than the six ASCII blanks (space and
U+0009 to U+000D).  Hashes are made of eight-byte pieces of the words, so a
block of texts needs a few vector operations and no loop over words.  Blocks
hold about ``BLOCK`` bytes; a longer text makes a block of its own and is
hashed piece by piece, so that memory follows the longest text only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
LONG = 256

_U = np.uint64
_WORDS = np.ones(256, dtype=np.int8)
_WORDS[[0x20, *range(0x09, 0x0E)]] = 0
# Runs of ASCII punctuation as words of their own.
MARKS_APART = np.array([2 if c < 128 and not chr(c).isalnum() and _WORDS[c] else _WORDS[c] for c in range(256)], np.int8)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=_U)
# Byte tables for texts: A-Z to lower case; the same with ASCII punctuation as blanks.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PLAIN = bytes(32 if c < 128 and not chr(c).isalnum() else LOWER[c] for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def spans(data: np.ndarray, classes: np.ndarray = _WORDS) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of each word of a byte array.

    A word is a run of bytes of one class; class 0 is between words.
    """
    kind = np.zeros(len(data) + 2, dtype=np.int8)
    kind[1:-1] = classes[data]
    edge = kind[1:] != kind[:-1]
    return np.flatnonzero(edge & (kind[1:] > 0)), np.flatnonzero(edge & (kind[:-1] > 0))


def hash_spans(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    padded = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    eight = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    out = mix(lengths.astype(_U) + _U(seed))
    at, left, todo = starts.copy(), lengths.copy(), np.arange(len(starts))
    for i in np.flatnonzero(lengths > LONG):
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    keep = lengths <= LONG
    at, left, todo = at[keep], left[keep], todo[keep]
    while len(todo):
        piece = eight[at] & _MASKS[np.minimum(left, 8)]
        out[todo] = mix(out[todo] * _U(0x9E3779B97F4A7C15) + piece)
        more = left > 8
        at, left, todo = at[more] + 8, left[more] - 8, todo[more]
    return out


class Block:
    """Texts of some rows with their words.

    ``rows`` numbers the rows in the batch, ``first`` has each row's first
    word and, at its end, the number of words; ``hashes`` is one per word.
    """

    def __init__(self, rows: range, texts: list[str | None], table: bytes | None = None, seed: int = 0, classes: np.ndarray = _WORDS):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        data = b"\n".join(parts)
        if table:
            data = data.translate(table)
        self.rows, self.data = rows, data
        ends_of_rows = np.cumsum(np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts)))
        starts, ends, hashes = [], [], []
        for low, high in _pieces(data):
            s, e = spans(np.frombuffer(data, dtype=np.uint8, count=high - low, offset=low), classes)
            hashes.append(hash_spans(data[low:high], s, e, seed))
            starts.append(s + low)
            ends.append(e + low)
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, _U)
        self.first = np.concatenate([[0], np.searchsorted(self.starts, ends_of_rows)]).astype(np.int64)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows)), self.counts)


def _pieces(data: bytes) -> Iterator[tuple[int, int]]:
    """Cuts of at least BLOCK bytes between words."""
    low = 0
    while low < len(data):
        high = low + 2 * BLOCK
        if high >= len(data):
            high = len(data)
        else:
            while high < len(data) and _WORDS[data[high]]:
                high += 1
        yield low, high
        low = high


def blocks(
    texts: pa.Array, table: bytes | None = None, seed: int = 0, classes: np.ndarray = _WORDS, size: int = BLOCK
) -> Iterator[Block]:
    """The texts of a batch in blocks of about ``size`` bytes; a null is an empty text."""
    held: list[str | None] = []
    begin = total = 0
    for i in range(len(texts)):
        text = texts[i].as_py()
        held.append(text)
        total += len(text or "") + 1
        if total >= size:
            yield Block(range(begin, i + 1), held, table, seed, classes)
            begin, total, held = i + 1, 0, []
    if held:
        yield Block(range(begin, len(texts)), held, table, seed, classes)


def windows(hashes: np.ndarray, first: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every run of ``width`` words inside one row.

    Each word's hash goes through the mixer with the place it has in the run.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    total = np.full(n - width + 1, ((seed * 2 + 1) * 0x9E3779B97F4A7C15) % (1 << 64), dtype=_U)
    for k in range(width):
        total = (total ^ hashes[k : n - width + 1 + k]) * _U(0xD6E8FEB86659FD93)
        total ^= total >> _U(32)
    last = np.repeat(first[1:], np.diff(first))[: n - width + 1]
    starts = np.flatnonzero(np.arange(n - width + 1) + width <= last)
    return starts, mix(total[starts])
