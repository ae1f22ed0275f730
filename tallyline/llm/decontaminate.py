"""Benchmark passages in documents, by pigeonhole pieces and Myers' algorithm.

Texts are compared as words (lower-cased A-Z, ASCII punctuation as blanks).  An
item of m words may differ from the document's words by floor(m * ERROR_RATE)
inserted, deleted or replaced words.  It is cut into one piece more than that;
if it occurs within its budget, at least one piece occurs unchanged.

1. The first ``ANCHOR`` words of every piece (fewer, if it has fewer) are
   hashed.  A bitmap of those hashes, of fixed size whatever the benchmark, goes
   to the tasks.
2. A task hashes the document's runs of those lengths and keeps the documents
   where the bitmap allows a hit, as word hashes, with the hits' positions.
3. Hits are joined with the pieces on the 64-bit hash, and grouped by document
   and item.
4. Myers' bit-parallel algorithm, with the item's words as the pattern, finds
   the smallest number of edits against the words around each hit.

A larger benchmark makes the bitmap denser and step 3 larger; no result
depends on it.

Nulls and edges: items without words match nothing; null texts are empty;
repeated items are reported under each item's id (null too); a document's
identical rows are reported once, and rows with equal ids but other texts by
the closest match.  Documents without a match have no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import Staging
from . import words as W
from .bitmaps import bitmap_of, maybe_in
from .rows import join_null_safe, keyed

ERROR_RATE = 0.1
ANCHOR = 5

_PIECES = pa.schema([
    ("item_id", pa.int64()), ("item", pa.binary()), ("budget", pa.int32()),
    ("hash", pa.int64()), ("length", pa.int32()), ("offset", pa.int32()),
])
_FOUND = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("words", pa.binary()), ("hashes", pa.list_(pa.int64())), ("places", pa.list_(pa.int32()))])


def piece_starts(m: int, pieces: int) -> list[int]:
    return [i * m // pieces for i in range(pieces)]


def _cut_items(rate: float) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("item_id").to_pylist(), []
            for block in W.blocks(batch.column("text"), W.PLAIN):
                for k, i in enumerate(block.rows):
                    words = block.hashes[block.first[k] : block.first[k + 1]]
                    m = len(words)
                    if not m:
                        continue
                    budget = int(m * rate)
                    starts = piece_starts(m, budget + 1)
                    for low, high in zip(starts, [*starts[1:], m]):
                        n = min(ANCHOR, high - low)
                        _, h = W.windows(words[low : low + n], np.array([0, n]), n, seed=30 + n)
                        rows.append((ids[i], words.tobytes(), budget, int(h.astype(np.int64)[0]), n, low))
            columns = zip(*rows) if rows else [[]] * len(_PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECES.types)], schema=_PIECES)

    return cut


def _hits(bitmap, lengths: list[int]) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            ids, versions = (batch.column(c).to_pylist() for c in ("doc_id", "version"))
            for block in W.blocks(batch.column("text"), W.PLAIN):
                places, hashes = [], []
                for n in lengths:
                    starts, h = W.windows(block.hashes, block.first, n, seed=30 + n)
                    hit = maybe_in(bits, h)
                    places.append(starts[hit])
                    hashes.append(h[hit].astype(np.int64))
                place, h = np.concatenate(places), np.concatenate(hashes)
                order = np.argsort(place, kind="stable")
                place, h = place[order], h[order]
                bounds = np.searchsorted(place, block.first)
                rows = [
                    (ids[i], versions[i], block.hashes[block.first[k] : block.first[k + 1]].tobytes(),
                     h[bounds[k] : bounds[k + 1]], (place[bounds[k] : bounds[k + 1]] - block.first[k]).astype(np.int32))
                    for k, i in enumerate(block.rows) if bounds[k + 1] > bounds[k]
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FOUND.types)], schema=_FOUND)

    return find


def myers(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest edits between the pattern and any run of the text, and the word after that run.

    Myers' vectors as whole integers, so the pattern may have any length; the
    match may begin anywhere.
    """
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text.tolist()):
        same = masks.get(w, 0)
        vertical = same | minus
        diagonal = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


_LEAKS = pa.schema([(n, pa.int64()) for n in ("doc_id", "version", "item_id", "item_words", "budget", "edits", "last_word")])
LEAKS = ", ".join(f"{n} long" for n in _LEAKS.names)


def _regions(starts: list[int], m: int, budget: int, n: int) -> list[list[int]]:
    """Word ranges that hold every match near the given starts; ranges that touch are one."""
    out: list[list[int]] = []
    for at in sorted(starts):
        low, high = max(at - budget, 0), min(at + m + budget, n)
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        plain = {c: batch.column(c).to_pylist() for c in ("doc_id", "version", "item_id", "budget", "starts")}
        for r in range(batch.num_rows):
            pattern, text = (np.frombuffer(batch.column(c)[r].as_buffer(), "<u8") for c in ("item", "words"))
            budget, m = plain["budget"][r], len(pattern)
            best, last = budget + 1, 0
            for low, high in _regions(plain["starts"][r], m, budget, len(text)):
                edits, end = myers(pattern, text[low:high])
                if edits < best:
                    best, last = edits, low + end
            if best <= budget:
                rows.append((plain["doc_id"][r], plain["version"][r], plain["item_id"][r], m, budget, best, last))
        columns = zip(*rows) if rows else [[]] * len(_LEAKS)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _LEAKS.types)], schema=_LEAKS)


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, version, item_id, item_words, budget, edits, last_word): items found in documents."""
    spark = docs.sparkSession
    staging = Staging(spark, "leaks")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    schema = "item_id long, item binary, budget int, hash long, length int, offset int"
    pieces = staging.keep(items.mapInArrow(_cut_items(rate), schema).distinct(), "pieces")
    lengths = sorted(r[0] for r in pieces.select("length").distinct().collect())  # at most ANCHOR numbers
    bitmap = spark.sparkContext.broadcast(bitmap_of(pieces.select("hash")))
    schema = "doc_id long, version long, words binary, hashes array<long>, places array<int>"
    found = staging.keep(keyed(docs).mapInArrow(_hits(bitmap, lengths or [ANCHOR]), schema), "found")
    hits = found.select("doc_id", "version", F.explode(F.arrays_zip("hashes", "places")).alias("h")).select(
        "doc_id", "version", F.col("h.hashes").alias("hash"), F.col("h.places").alias("place")
    )
    key = ["doc_id", "version"]
    item_key = F.xxhash64("item_id", "item")
    named = pieces.withColumn("item_key", item_key)
    starts = (
        hits.join(named.select("hash", "item_key", "offset"), "hash")
        .groupBy(*key, "item_key").agg(F.collect_set(F.col("place") - F.col("offset")).alias("starts"))
    )
    whole = found.select(*key, "words").dropDuplicates(key)
    item = named.select("item_key", "item_id", "item", "budget").dropDuplicates(["item_key"])
    rows = join_null_safe(starts, whole, key).join(item, "item_key").drop("item_key")
    return rows.mapInArrow(_verify, LEAKS)


def leak_table(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, item_words, budget, edits, last_word), the closest match of each pair."""
    closest = F.min(F.struct("edits", "last_word")).alias("_best")
    return (
        leaks(docs, benchmark, rate).groupBy("doc_id", "item_id", "item_words", "budget").agg(closest)
        .select("doc_id", "item_id", "item_words", "budget", "_best.edits", "_best.last_word")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The documents that hold no item, all columns kept."""
    found = leaks(docs, benchmark, rate).select(F.col("doc_id").alias("_d"), F.col("version").alias("_v")).distinct()
    found = Staging(docs.sparkSession, "leaks").keep(found, "documents")
    version = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_d"]) & (version == found["_v"]), "left_anti")
