"""Substring dedup with difference-cover anchors.

A window is ``WINDOW`` words on end.  Of each document, the later copy of any
window that also starts in a document with a smaller id is removed, word by
word.

Anchors are runs of ``ANCHOR`` words, hashed only at positions whose remainder
modulo ``PERIOD`` is in ``COVER``.  The cover holds every difference modulo
the period, so for any two positions i and j some shift below the period takes
both into the cover: two equal windows share an aligned anchor, as PERIOD - 1 +
ANCHOR words fit into a window.  Anchors found in one document only are left
out.  The others are extended to all windows that hold them, and those are
compared as a whole by a 128-bit hash; each is judged against the smallest id
that has it, so no pairs are made.

Shuffles carry packed entries (see ``packed``).  What a task can settle among
its own documents it settles, and sends a frequent anchor or window on once.

Nulls and edges: a null text has no words; rows with a null id are compared
with nothing and keep all; identical rows are one document that is repeated;
rows with equal ids but other texts do not remove each other's words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import Staging
from . import words as W
from .packed import deal, gather, group_starts, part_count, parts_of, split_rows
from .rows import keyed

WINDOW = 13
# A perfect difference cover.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
CHUNK_WORDS = 3_000_000

PACKED = "part long, known boolean, hashes binary, hashes2 binary, docs binary, versions binary, places binary"
FOUND = "part long, docs binary, versions binary, places binary"
HITS = "doc_id long, version long, places binary"


class _Chunk:
    """Entries of some documents until they are sent."""

    def __init__(self):
        self.doc, self.version, self.place, self.h1, self.h2 = [], [], [], [], []
        self.words = 0

    def add(self, doc, version, place, h1, h2):
        for held, new in zip((self.doc, self.version, self.place, self.h1, self.h2), (doc, version, place, h1, h2)):
            held.append(new)

    def take(self):
        out = [np.concatenate(x) for x in (self.doc, self.version, self.place, self.h1, self.h2)]
        self.__init__()
        return out


def _doc_parts(doc: np.ndarray, version: np.ndarray, parts: int) -> np.ndarray:
    return parts_of(W.mix(W.mix(doc.astype(np.uint64)) ^ version.astype(np.uint64)), parts)


def _packed_by_doc(doc, version, place, parts: int) -> Iterator[tuple[int, list[bytes]]]:
    """One row per part of documents; entries of a document are together."""
    order = np.lexsort((place, version, doc))
    doc, version, place = doc[order], version[order], place[order]
    return split_rows(_doc_parts(doc, version, parts), [doc, version, place.astype("<i4")])


def _same(h1: np.ndarray, h2: np.ndarray):
    """Order by (h1, h2, place in the chunk) and the group number of each entry."""
    order = np.lexsort((h2, h1)) if len(h2) else np.argsort(h1, kind="stable")
    a = h1[order]
    new = a[1:] != a[:-1]
    if len(h2):
        b = h2[order]
        new |= b[1:] != b[:-1]
    return order, np.concatenate([[0], np.cumsum(new)]) if len(a) else np.zeros(0, np.int64)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(schema), schema.types)], schema=schema)


_PACKED = pa.schema([("part", pa.int64()), ("known", pa.bool_()), *[(n, pa.binary()) for n in ("hashes", "hashes2", "docs", "versions", "places")]])
_ENTRY = (("docs", "<i8"), ("versions", "<i8"), ("places", "<i4"))
_FOUND = pa.schema([("part", pa.int64()), *[(n, pa.binary()) for n, _ in _ENTRY]])
_HITS = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("places", pa.binary())])


def _send(chunk: _Chunk, parts: int, first_only: bool) -> Iterator[pa.RecordBatch]:
    """Settles a chunk's own matches; sends those as known, and the rest by hash.

    ``first_only`` (windows): entries after the chunk's smallest id of a window
    are settled, the smallest id's go on.  Else (anchors): all entries of an
    anchor in several documents are settled, and a marker with place -1 goes on.
    """
    doc, version, place, h1, h2 = chunk.take()
    if not len(doc):
        return
    order, group = _same(h1, h2)
    heads = group_starts(group)
    low = np.minimum.reduceat(doc[order], heads)[group]
    if first_only:
        settled_sorted = doc[order] > low
    else:
        high = np.maximum.reduceat(doc[order], heads)[group]
        settled_sorted = high > low
    settled = np.zeros(len(doc), bool)
    settled[order] = settled_sorted
    go = ~settled
    if not first_only:
        marker = order[heads[settled_sorted[heads]]]
        go[marker] = True
    place = place.copy()
    rows = []
    for part, cells in _packed_by_doc(doc[settled], version[settled], place[settled], parts):
        rows.append((part, True, None, None, *cells))
    if not first_only:
        place[marker] = -1
    second = [h2[go]] if len(h2) else []
    columns = [h1[go], *second, doc[go], version[go], place[go].astype("<i4")]
    for part, cells in split_rows(parts_of(h1[go], parts), columns):
        rows.append((part, False, cells[0], cells[1] if second else None, *cells[-3:]))
    for i in range(0, len(rows), 2000):
        yield _batch(rows[i : i + 2000], _PACKED)


def _receiver(parts: int, first_only: bool) -> Callable:
    """Matches of all tasks, and the settled ones, packed by document."""

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        known = [b.filter(b.column("known")) for b in held]
        held = [b.filter(pc.invert(b.column("known"))) for b in held]
        column = lambda name, kind, rows: gather([b.column(name) for b in rows], kind)
        done = [column(name, kind, known) for name, kind in _ENTRY]
        h1, h2 = column("hashes", "<u8", held), column("hashes2", "<u8", held)
        doc, version, place = (column(name, kind, held) for name, kind in _ENTRY)
        del held, known
        if len(h1):
            order, group = _same(h1, h2)
            heads = group_starts(group)
            low = np.minimum.reduceat(doc[order], heads)[group]
            if first_only:
                hit = doc[order] > low
            else:
                high = np.maximum.reduceat(doc[order], heads)[group]
                marked = np.minimum.reduceat(place[order], heads)[group] < 0
                hit = ((high > low) | marked) & (place[order] >= 0)
            at = order[hit]
            done = [np.concatenate(x) for x in zip(done, (doc[at], version[at], place[at]))]
        rows = [(part, *cells) for part, cells in _packed_by_doc(*done, parts)]
        for i in range(0, len(rows), 1000):
            yield _batch(rows[i : i + 1000], _FOUND)

    return receive


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, version, places), one row per document: all its entries are in one part."""
    held = list(batches)
    doc, version, place = (gather([b.column(name) for b in held], kind) for name, kind in _ENTRY)
    del held
    order = np.lexsort((place, version, doc))
    doc, version, place = doc[order], version[order], place[order]
    new = np.flatnonzero((doc[1:] != doc[:-1]) | (version[1:] != version[:-1])) + 1
    bounds = np.concatenate([[0], new, [len(doc)]]).tolist()
    rows = [
        (int(doc[low]), int(version[low]), place[low:high].tobytes()) for low, high in zip(bounds[:-1], bounds[1:]) if high > low
    ]
    for i in range(0, len(rows), 5000):
        yield _batch(rows[i : i + 5000], _HITS)


def _anchors(parts: int) -> Callable:
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            ids, versions = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version"))
            for block in W.blocks(batch.column("text")):
                starts, hashes = W.windows(block.hashes, block.first, ANCHOR, seed=1)
                row = block.row_of_word[starts]
                place = starts - block.first[row]
                use = cover[place % PERIOD]
                row, place, hashes = row[use] + block.rows.start, place[use], hashes[use]
                chunk.add(ids[row], versions[row], place, hashes, np.zeros(0, np.uint64))
                chunk.words += len(block.hashes)
                if chunk.words >= CHUNK_WORDS:
                    yield from _send(chunk, parts, first_only=False)
        if chunk.doc:
            yield from _send(chunk, parts, first_only=False)

    return send


def _places(cell: pa.Scalar) -> np.ndarray:
    if not cell.is_valid:
        return np.zeros(0, np.int64)
    return np.frombuffer(cell.as_buffer(), "<i4").astype(np.int64)


def _windows(parts: int) -> Callable:
    """The windows around shared anchors."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            ids, versions = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "version"))
            found = batch.column("found")
            for block in W.blocks(batch.column("text")):
                second = W.mix(block.hashes ^ np.uint64(0x5851F42D4C957F2D))
                starts, h1 = W.windows(block.hashes, block.first, WINDOW, seed=2)
                _, h2 = W.windows(second, block.first, WINDOW, seed=3)
                wanted = np.zeros(len(block.hashes) + 1, np.int32)
                for k, i in enumerate(block.rows):
                    anchors = _places(found[i])
                    first = np.maximum(anchors - (WINDOW - ANCHOR), 0) + block.first[k]
                    np.add.at(wanted, first, 1)
                    np.add.at(wanted, anchors + 1 + block.first[k], -1)
                use = np.cumsum(wanted)[starts] > 0
                starts, h1, h2 = starts[use], h1[use], h2[use]
                row = block.row_of_word[starts]
                place = starts - block.first[row]
                row = row + block.rows.start
                chunk.add(ids[row], versions[row], place, h1, h2)
                chunk.words += len(block.hashes)
                if chunk.words >= CHUNK_WORDS:
                    yield from _send(chunk, parts, first_only=True)
        if chunk.doc:
            yield from _send(chunk, parts, first_only=True)

    return send


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
    for batch in batches:
        rows = []
        ids, versions = batch.column("doc_id").to_pylist(), batch.column("version").to_pylist()
        for i, (text, found) in enumerate(zip(batch.column("text"), batch.column("found"))):
            parts = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
            n, removed = len(parts), 0
            places = _places(found)
            if len(places):
                gone = np.zeros(n + WINDOW + 1, np.int32)
                places = np.unique(places)
                gone[places] += 1
                gone[places + WINDOW] -= 1
                gone = np.cumsum(gone)[:n] > 0
                removed = int(gone.sum())
                parts = [p for p, g in zip(parts, gone.tolist()) if not g]
            rows.append((ids[i], versions[i], n, removed, b" ".join(parts).decode("utf-8", "surrogatepass")))
        yield _batch(rows, schema)


def substring_dedup(docs: DataFrame, staging: Staging | None = None) -> DataFrame:
    """(doc_id, text, n_words, n_removed): each document's words that stay, one space between."""
    spark = docs.sparkSession
    staging = staging or Staging(spark, "substrings")
    parts = part_count(spark)
    rows = keyed(docs)
    numbered = rows.where(F.col("doc_id").isNotNull())

    def match(packed: DataFrame, first_only: bool, name: str) -> DataFrame:
        found = deal(packed, parts).mapInArrow(_receiver(parts, first_only), FOUND)
        return staging.keep(deal(found, parts).mapInArrow(_by_document, HITS), name)

    def with_hits(base: DataFrame, hits: DataFrame, how: str) -> DataFrame:
        found = hits.withColumnRenamed("places", "found").hint("shuffle_hash")
        return base.join(found, ["doc_id", "version"], how)

    anchors = match(numbered.mapInArrow(_anchors(parts), PACKED), False, "anchors")
    repeats = match(with_hits(numbered, anchors, "inner").mapInArrow(_windows(parts), PACKED), True, "repeats")
    schema = "doc_id long, version long, n_words long, n_removed long, text string"
    return (
        with_hits(rows, repeats, "left").mapInArrow(_cut, schema)
        .select("doc_id", "text", "n_words", "n_removed")
    )
