"""Sorted hash arrays in a shared folder, memory-mapped by tasks.

A shard is one file per hash range: its number of entries, the sorted hashes,
then value columns of the same length, with half a byte or a byte for each
value, whichever makes the column smaller; values from 15 or 255 on, or below 0,
are listed before the bytes with their places.  Tasks write shards under a name
of their own, so a repeated or lost task does no harm: only the names that Spark
returns are used.  A local (mounted) folder is mapped in place; any other
store's file is first copied to the task's temporary folder, mapped, and
unlinked at once.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs

from .packed import parts_of

SPAN = 32  # entries that share the first place of their members


def _local(path: str) -> str | None:
    parsed = urlparse(path)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def _column(values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """(number of values listed apart, bits of the others), their places and values, and the bytes."""

    def apart(large: int) -> np.ndarray:
        return np.flatnonzero((values < 0) | (values >= large))

    four, eight = apart(15), apart(255)
    bits = 4 if 16 * len(four) < 16 * len(eight) + len(values) // 2 else 8
    listed = four if bits == 4 else eight
    small = values.astype(np.uint8)
    small[listed] = (1 << bits) - 1
    if bits == 4:
        small = np.concatenate([small, np.zeros(len(small) % 2, np.uint8)])
        small = small[::2] | small[1::2] << 4
    return [len(listed), bits], [listed.astype("<i8"), values[listed].astype("<i8"), small]


class _Column:
    """A stored column, read at some places."""

    def __init__(self, raw: np.ndarray, n: int, listed: int, bits: int):
        self.bits, at = bits, 8 * listed
        self.places, self.large, self.small = raw[:at].view("<i8"), raw[at : 2 * at].view("<i8"), raw[2 * at : 2 * at + -(-n * bits // 8)]
        self.size = 2 * at + len(self.small)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        if self.bits == 4:
            found = (self.small[at >> 1] >> ((at & 1) << 2).astype(np.uint8) & np.uint8(15)).astype(np.int64)
        else:
            found = self.small[at].astype(np.int64)
        apart = np.flatnonzero(found == (1 << self.bits) - 1)
        if len(apart):
            found[apart] = self.large[np.searchsorted(self.places, at[apart])]
        return found


def write_shard(folder: str, name: str, hashes: np.ndarray, columns: list[np.ndarray]) -> str:
    """The written file's name in ``folder``; columns are whole numbers."""
    told, data = zip(*map(_column, columns)) if columns else ((), ())
    head = np.array([len(hashes), *(x for t in told for x in t)], "<u8")
    return _write(folder, name, [head, hashes.astype("<u8", copy=False), *(x for d in data for x in d)])


def write_members(folder: str, name: str, first: np.ndarray, members: np.ndarray, values: np.ndarray) -> tuple[str, np.ndarray]:
    """The file of the ``members``, ascending in each entry's group, with a value each; and each group's offset.

    ``first`` has each group's first place, which is its offset from that of the first of ``SPAN`` entries.
    """
    spans = first[::SPAN]
    told, data = _column(values)
    kind = np.dtype("<u4") if not len(members) or int(members.max()) < 1 << 32 else np.dtype("<u8")
    head = np.array([len(spans), len(members), kind.itemsize, *told], "<u8")
    name = _write(folder, name, [head, spans.astype("<u8"), members.astype(kind), *data])
    return name, first - np.repeat(spans, SPAN)[: len(first)]


def _write(folder: str, name: str, data: list[np.ndarray]) -> str:
    name = f"{name}-{uuid.uuid4().hex}"
    local = _local(folder)
    if local is not None:
        os.makedirs(local, exist_ok=True)
        with open(f"{local}/{name}", "wb") as out:
            for part in data:
                out.write(memoryview(np.ascontiguousarray(part)).cast("B"))
        return name
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        for part in data:
            out.write(np.ascontiguousarray(part).tobytes())
    return name


def _mapped(folder: str, name: str) -> np.ndarray:
    local = _local(folder)
    if local is not None:
        return np.memmap(f"{local}/{name}", mode="r", dtype=np.uint8)
    store, path = fs.FileSystem.from_uri(folder)
    with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(f"{path}/{name}") as source:
        shutil.copyfileobj(source, copy)
        copy.flush()
        return np.memmap(copy.name, mode="r", dtype=np.uint8)


class Table:
    """Shards of one table; ``names[part]`` is the file of a hash range, or missing."""

    def __init__(self, folder: str, names: dict[int, str], parts: int, dtypes: list[str]):
        self.folder, self.names, self.parts, self.dtypes = folder, names, parts, dtypes
        self._open: dict[int, tuple] = {}

    def _shard(self, part: int):
        if part not in self._open:
            raw = _mapped(self.folder, self.names[part])
            n, *told = raw[: 8 * (1 + 2 * len(self.dtypes))].view("<u8").tolist()
            at = 8 * (1 + len(told))
            hashes, columns = raw[at : at + 8 * n].view("<u8"), []
            at += 8 * n
            for listed, bits in zip(told[::2], told[1::2]):
                columns.append(_Column(raw[at:], n, listed, bits))
                at += columns[-1].size
            self._open[part] = hashes, columns
        return self._open[part]

    def hashes(self, part: int) -> np.ndarray:
        return self._shard(part)[0]

    def look_up(self, keys: np.ndarray, dealt_by: np.ndarray | None = None, places: np.ndarray | None = None) -> list[np.ndarray]:
        """Value columns for sorted keys; 0 where a key is missing.

        A key is in the range of its own hash, or of ``dealt_by``.  ``places``
        gets each found key's place in its shard.
        """
        out = [np.zeros(len(keys), kind) for kind in self.dtypes]
        part = parts_of(keys if dealt_by is None else dealt_by, self.parts)
        for p, here in by_part(part, self.parts):
            if p not in self.names:
                continue
            hashes, columns = self._shard(p)
            some = keys[here]
            at = np.minimum(np.searchsorted(hashes, some), len(hashes) - 1)
            hit = hashes[at] == some
            here, at = here[hit], at[hit]
            if places is not None:
                places[here] = at
            for values, column in zip(out, columns):
                values[here] = column[at]
        return out


def by_part(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its rows) of every part that has rows."""
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])
    for p in np.flatnonzero(np.diff(bounds)):
        yield int(p), order[bounds[p] : bounds[p + 1]]


class Members:
    """The members of the entries of a ``Table`` with the same parts (see ``write_members``)."""

    def __init__(self, folder: str, names: dict[int, str], parts: int):
        self.folder, self.names, self.parts = folder, names, parts
        self._open: dict[int, tuple] = {}

    def _shard(self, part: int):
        if part not in self._open:
            raw = _mapped(self.folder, self.names[part])
            n, m, size, listed, bits = raw[:40].view("<u8").tolist()
            at = 40 + 8 * n
            self._open[part] = raw[40:at].view("<i8"), raw[at : at + size * m].view(f"<u{size}"), _Column(raw[at + size * m :], m, listed, bits)
        return self._open[part]

    def look_up(self, part: np.ndarray, place: np.ndarray, offset: np.ndarray, size: np.ndarray, member: np.ndarray) -> np.ndarray:
        """The value of each ``member`` of the entry at ``place`` whose group has ``size`` members; 0 if it is none."""
        out = np.zeros(len(member), np.int64)
        some = np.flatnonzero(size)
        for p, here in by_part(part[some], self.parts):
            here = some[here]
            spans, members, values = self._shard(p)
            low = spans[place[here] // SPAN] + offset[here]
            high, last, want = low + size[here], low + size[here] - 1, member[here]
            left = np.arange(len(here))
            while len(left):
                middle = (low[left] + high[left]) >> 1
                below = members[middle] < want[left]
                low[left[below]], high[left[~below]] = middle[below] + 1, middle[~below]
                left = left[low[left] < high[left]]
            hit = np.flatnonzero(low <= last)
            hit = hit[members[low[hit]] == want[hit]]
            out[here[hit]] = values[low[hit]]
        return out
