"""Interpolated modified Kneser-Ney scores.

The model has any order n from 2 on.  Words are lower-cased (A-Z); each
document ends with an end token, which is counted as a token, and begins after
n - 1 start marks, which are not.

Words.  A first pass over the training texts collects the distinct words; their
number is their place in the order of their hashes, so that n-grams of numbers
pack well.

Counting.  Tasks count the distinct n-grams of what they read and send them
packed, by ranges of the 64-bit hash of their context; receivers merge them.
Every distinct n-gram then counts once for its last n - 1 words, again packed
and by ranges, and so on down to words.  On the way come, per context, the sum
and the number of n-grams seen once, twice, more often; per word, its count
too.  Contexts are whole in their range, those of one word aside, which are
added up with the words.

Storing.  The contexts of each order, the bigrams and the words are sorted hash
arrays in the shared folder (see ``shards``); an n-gram of three words or more
is its last word's number in the group of its context.  Workers map the arrays
into memory and look sorted batches up.  The arrays and every shuffle grow with
the training texts; the driver sees file names and a few totals.

Scoring.  With discounts D from the counts of counts of each order (Chen and
Goodman, 1998), h a context of k - 1 words and h' without its first word:

    p(w)     = max(a(w) - D1(a), 0) / A + g0 / (V + 1)
    p(w | h) = max(c(hw) - Dk(c), 0) / S(h) + g(h) p(w | h')

a(w): different words before w; A: their sum; V: distinct training tokens; one
more stands for every unknown word; c: the count of an n-gram of the highest
order, the number of different words before it in lower ones; S(h), g(h): sum
and freed mass of context h.  An unknown context leaves p(w | h').
Probabilities of a context sum to 1.

Nulls and edges: a null or empty text is the end token only; without training
texts every count is 0 and p is 1; identical rows are scored alike and count
as often as they occur.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import Staging
from . import words as W
from .packed import ascending, deal, distinct, group_starts, part_count, parts_of
from .shards import Members, Table, by_part, write_members, write_shard

START, END = np.uint64(0x5EED0000000000A1), np.uint64(0x5EED0000000000B2)
CHUNK_TOKENS = 4_000_000
HASHED = 1 << 18  # n-grams hashed at a time

GRAMS = "part long, cells array<binary>"
_GRAMS = pa.schema([("part", pa.int64()), ("cells", pa.list_(pa.binary()))])
_FIELDS = ("count", "before", "total", "ones", "twos", "more")
ROWS = "kind string, part long, file string, cells array<binary>, c1 long, c2 long, c3 long, c4 long"
_ROWS = pa.schema([
    ("kind", pa.string()), ("part", pa.int64()), ("file", pa.string()), ("cells", pa.list_(pa.binary())),
    *[(f"c{i}", pa.int64()) for i in (1, 2, 3, 4)],
])
_OF_CONTEXT = ["<i8"] * 5  # sum, n-grams seen once, twice, more often, offset of the group
VOCABULARY = "part long, file string, words long"
_VOCABULARY = pa.schema([("part", pa.int64()), ("file", pa.string()), ("words", pa.int64())])
_TOTALS = pa.schema([
    ("part", pa.int64()), ("file", pa.string()), ("tokens", pa.int64()), ("types", pa.int64()),
    ("before", pa.int64()), *[(f"c{i}", pa.int64()) for i in (1, 2, 3, 4)],
])
TOTALS = "part long, file string, tokens long, types long, before long, c1 long, c2 long, c3 long, c4 long"


def marked(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first token of each row), ends included."""
    first = np.concatenate([[0], np.cumsum(block.counts + 1)])
    token = np.empty(first[-1], np.uint64)
    ends = first[1:] - 1
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner], token[ends] = block.hashes, END
    return token, first


def grams(token: np.ndarray, begins: np.ndarray, order: int, start) -> list[np.ndarray]:
    """The words of the n-gram that ends at each token; before the tokens at ``begins`` come start marks."""
    columns = [token]
    for _ in range(order - 1):
        before = np.empty_like(token)
        before[1:] = columns[0][:-1]
        before[begins] = start
        columns.insert(0, before)
    return columns


class Vocabulary:
    """The numbers of the training texts' words: their places in the order of their hashes, from 0 on."""

    def __init__(self, table: Table, sizes: dict[int, int]):
        self.table = table
        self.bounds = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(table.parts)])]).astype(np.int64)

    def numbers(self, hashes: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """Of sorted hashes; unknown words have the number after the last."""
        if places is None:
            places = np.full(len(hashes), -1)
            self.table.look_up(hashes, places=places)
        return np.where(places < 0, self.bounds[-1], self.bounds[parts_of(hashes, self.table.parts)] + places).astype(np.uint64)

    def part_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, numbers.astype(np.int64), "right") - 1


def pair_hash(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return W.mix((before * np.uint64(0x9E3779B97F4A7C15)) ^ W.mix(token))


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    return reduce(pair_hash, words)


def _merge(words: list[np.ndarray], counts: np.ndarray):
    """Distinct n-grams by ascending hash: (hash, words, summed counts)."""
    key = gram_hash(words)
    order = ascending(key)
    heads = group_starts(key[order])
    at = order[heads]
    total = np.add.reduceat(counts[order], heads) if len(heads) else counts
    return key[at], [w[at] for w in words], total


def dealt_by(words: list[np.ndarray], key: np.ndarray) -> np.ndarray:
    """The hash whose range an n-gram belongs to: its context's, so that a context is whole in its range.

    A context has at most as many n-grams as there are words.  Contexts of one
    word may be in half of the text; bigrams are dealt by themselves.
    """
    return key if len(words) == 2 else gram_hash(words[:-1])


def _packed_grams(key: np.ndarray, words: list[np.ndarray], counts: np.ndarray, parts: int) -> Iterator[tuple[int, list[bytes]]]:
    """(part, cells) of the n-grams."""
    for p, here in by_part(parts_of(dealt_by(words, key), parts), parts):
        yield p, _packed_part([w[here] for w in words], counts[here])


def _packed_part(words: list[np.ndarray], counts: np.ndarray | None = None) -> list[bytes]:
    """The distinct words of the n-grams, each word as its place among them, the counts; compressed.

    Equal n-grams are merged.  They are in the order of their words: runs of one first word pack well.
    """
    known, at = distinct(np.concatenate(words))
    places = at.reshape(len(words), -1).astype(np.uint64)
    key, size = places[0], len(known)
    for place in places[1:]:
        if size * len(known) >= 1 << 64:
            values, key = distinct(key)
            key, size = key.astype(np.uint64), len(values)
        key, size = key * np.uint64(len(known)) + place, size * len(known)
    order = ascending(key)
    heads = group_starts(key[order])
    total = np.diff(heads, append=len(order)) if counts is None else np.add.reduceat(counts[order], heads)
    at = order[heads]
    places = [p[at].astype(np.min_scalar_type(len(known))) for p in places]
    # both ascend: differences are small
    known, first = (np.diff(c, prepend=c.dtype.type(0)) for c in (known, places[0]))
    return [_cell(c) for c in (known, first, *places[1:], total.astype("<u4"))]


def _cell(values: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second bytes and so on, compressed; size of a number and length come before."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return bytes([values.itemsize]) + len(planes).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _opened(cell: pa.Scalar) -> np.ndarray:
    data = cell.as_buffer().to_pybytes()
    planes = pa.decompress(data[5:], decompressed_size=int.from_bytes(data[1:5], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(data[0], -1).T).view(f"<u{data[0]}").ravel()


def _unpacked_grams(held: list[pa.RecordBatch], width: int) -> list[np.ndarray]:
    """The words and counts of the packed n-grams in the rows of ``held``."""
    columns: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in range(width)] + [[np.zeros(0, np.uint32)]]
    for batch in held:
        cells = batch.column("cells").flatten()
        for i in range(0, len(cells), width + 2):
            known, *places, counts = (_opened(cells[j]) for j in range(i, i + width + 2))
            known, places[0] = (np.cumsum(c, dtype=c.dtype) for c in (known, places[0]))
            for column, place in zip(columns, places):
                column.append(known[place])
            columns[-1].append(counts)
    return [np.concatenate(c) for c in columns]


def _batches(rows: list, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 500):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 500]), schema.types)], schema=schema)


def _entries(held: list[pa.RecordBatch], columns: int) -> list[np.ndarray]:
    """The entries of each of the packed cells in the rows of ``held``; the first ones ascend in a cell."""
    flat = [b.column("cells").flatten() for b in held]
    found = [[np.zeros(0, np.uint64), *(_opened(cells[i]) for cells in flat for i in range(at, len(cells), columns))] for at in range(columns)]
    found[0] = [np.cumsum(c, dtype=np.uint64) for c in found[0]]
    return [np.concatenate(c) for c in found]


def _packed_entries(part: np.ndarray, parts: int, keys: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """(part, cells) of ascending keys and their columns."""
    for p, here in by_part(part, parts):
        yield p, [_cell(np.diff(keys[here], prepend=np.uint64(0))), *(_cell(c[here].astype("<u8")) for c in columns)]


def _packed_chunk(words: list[np.ndarray], parts: int) -> Iterator[tuple[int, list[bytes]]]:
    """(part, cells) of the distinct n-grams among ``words``, merged a part at a time: all n-grams of one lie in its part."""
    part = np.empty(len(words[0]), np.min_scalar_type(parts))
    for at in range(0, len(part), HASHED):
        some = [w[at : at + HASHED] for w in words]
        part[at : at + HASHED] = parts_of(dealt_by(some, gram_hash(some)), parts)
    for p, here in by_part(part, parts):
        yield p, _packed_part([w[here] for w in words])


def _send_words(parts: int) -> Callable:
    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        word = np.sort(np.concatenate([*held, np.array([START, END])]))
        word = word[group_starts(word)]
        yield from _batches(list(_packed_entries(parts_of(word, parts), parts, word, [])), _GRAMS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for block in W.blocks(batch.column("text"), W.LOWER):
                held.append(block.hashes)
                n += len(block.hashes) + len(block.rows)
                if n >= CHUNK_TOKENS:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return send


def _store_vocabulary(folder: str, parts: int) -> Callable:
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = np.sort(_entries(list(batches), 1)[0])
        word = word[group_starts(word)]
        part = parts_of(word, parts)
        rows = [(p, write_shard(folder, f"vocabulary-{p}", word[here], []), len(here)) for p, here in by_part(part, parts)]
        yield from _batches(rows, _VOCABULARY)

    return store


def _send_grams(parts: int, order: int, vocabulary: Vocabulary | None = None) -> Callable:
    """Sends the n-grams of the texts, of the words' numbers or, without a vocabulary, of their hashes."""

    def flush(held: list[np.ndarray], sizes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, start = np.concatenate(held), START
        held.clear()
        if vocabulary is not None:
            word, at = distinct(token)
            number = vocabulary.numbers(np.append(word, START))
            token, start = number[at], number[-1]
            del at
        begins = np.cumsum(np.concatenate([[0], *sizes]))[:-1]
        yield from _batches(list(_packed_chunk(grams(token, begins, order, start), parts)), _GRAMS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sizes, n = [], [], 0
        for batch in batches:
            for block in W.blocks(batch.column("text"), W.LOWER):
                token, first = marked(block)
                held.append(token)
                sizes.append(np.diff(first))
                n += len(token)
                if n >= CHUNK_TOKENS:
                    yield from flush(held, sizes)
                    sizes, n = [], 0
        if n:
            yield from flush(held, sizes)

    return send


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


def _store_grams(folder: str, parts: int, width: int, highest: bool, vocabulary: Vocabulary) -> Callable:
    """Writes the shards of a task's n-grams of ``width`` words; sends on what they add up to."""

    def sent(kind: str, packed: Iterator) -> Iterator[pa.RecordBatch]:
        yield from _batches([(kind, p, None, cells, None, None, None, None) for p, cells in packed], _ROWS)

    def sent_words(word: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        word, columns = _sum_words(word, columns)
        yield from sent("words", _packed_entries(vocabulary.part_of(word), parts, word, columns))

    def of_contexts(counts: np.ndarray) -> list[np.ndarray]:
        return [counts, *(x.astype(np.int64) for x in (counts == 1, counts == 2, counts > 2))]

    def bigrams(words: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, words, counts = _merge(words, counts)
        rows = []
        for p, here in by_part(parts_of(key, parts), parts):  # keys ascend
            name = write_shard(folder, f"grams{width}-{p}", key[here], [counts[here]])
            rows.append(("shard", p, name, None, *_counts_of_counts(counts[here])))
        yield from _batches(rows, _ROWS)
        zero = np.zeros(len(counts), np.int64)
        columns = [(zero, counts if highest else zero), (zero, zero + 1), *((c, zero) for c in of_contexts(counts))]
        yield from sent_words(np.concatenate(words), [np.concatenate(x) for x in columns])

    def grouped(words: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        context = gram_hash(words[:-1])
        order = ascending(words[-1])
        order = order[ascending(context[order])]
        context, word = context[order], words[-1][order]
        heads = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
        counts, words, context = np.add.reduceat(counts[order], heads), [w[order[heads]] for w in words], context[heads]
        first = group_starts(context)
        columns = [np.add.reduceat(c, first) for c in of_contexts(counts)]
        of_group = parts_of(context[first], parts)
        rows = []
        for p, here in by_part(of_group, parts):  # contexts ascend
            low, high = first[here[0]], first[here[-1] + 1] if here[-1] + 1 < len(first) else len(context)
            name, offset = write_members(folder, f"grams{width}-{p}", first[here] - low, words[-1][low:high], counts[low:high])
            rows.append(("shard", p, name, None, *_counts_of_counts(counts[low:high])))
            name = write_shard(folder, f"contexts{width}-{p}", context[first[here]], [*(c[here] for c in columns), offset])
            rows.append(("context", p, name, *[None] * 5))
        yield from _batches(rows, _ROWS)
        del order, heads, context
        if highest:
            zero = np.zeros(len(counts), np.int64)
            yield from sent_words(words[-1], [counts, *[zero] * 5])
        yield from sent("grams", _packed_chunk(words[1:], parts))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *words, counts = _unpacked_grams(list(batches), width)
        if len(counts):
            yield from (bigrams if width == 2 else grouped)(words, counts.astype(np.int64))

    return store


def _sum_words(word: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = ascending(word)
    heads = group_starts(word[order])
    return word[order][heads], [np.add.reduceat(c[order], heads) if len(heads) else c for c in columns]


def _store_words(folder: str, parts: int, vocabulary: Vocabulary) -> Callable:
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, *columns = _entries(list(batches), 1 + len(_FIELDS))
        word, columns = _sum_words(word, [c.astype(np.int64) for c in columns])
        rows = []
        for p, here in by_part(vocabulary.part_of(word), parts):
            hashes = vocabulary.table.hashes(p)
            some = [np.zeros(len(hashes), np.int64) for _ in columns]
            for values, c in zip(some, columns):
                values[word[here].astype(np.int64) - vocabulary.bounds[p]] = c[here]
            name = write_shard(folder, f"words-{p}", hashes, some)
            count, before = some[:2]
            rows.append((p, name, int(count.sum()), int((count > 0).sum()), int(before.sum()), *_counts_of_counts(before)))
        yield from _batches(rows, _TOTALS)

    return store


def discounts(n: list[int]) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and 3 or more.

    0.5, 1, 1.5 where counts of counts are missing, and in place of an estimate
    that is not above 0 (copies make such): a context that frees nothing would
    leave unseen words a probability of 0.
    """
    if min(n) <= 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
    return np.array([0.0, *[d if 0 < d < i + 1 else (i + 1) / 2 for i, d in enumerate(found)]])


class Level:
    """The n-grams of one order, their contexts (none at two words: those are in the words), and discounts."""

    def __init__(self, width: int, grams: Table | Members, contexts: Table | None, d: np.ndarray):
        self.width, self.grams, self.contexts, self.d = width, grams, contexts, d


class Model:
    """What a worker needs: where the shards are, and totals; ``levels`` from two words up."""

    def __init__(
        self, levels: list[Level], words: Table, vocabulary: Vocabulary, tokens: int, types: int, before: int, d1: np.ndarray, c1: list[int],
        more: int,
    ):
        self.levels, self.words, self.vocabulary, self.order = levels, words, vocabulary, len(levels) + 1
        self.tokens, self.types, self.before, self.d1 = tokens, types, before, d1
        freed = d1[1] * c1[0] + d1[2] * c1[1] + d1[3] * more
        self.backoff = freed / before if before else 1.0

    def score(self, token: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 p, log10 base probability, known) of every token, rows of which begin at ``begins``."""
        word, at = distinct(np.append(token, START))
        places = np.full(len(word), -1)
        count, left, *of_word = self.words.look_up(word, places=places)
        number = self.vocabulary.numbers(word, places)
        at = grams(at[:-1], begins, self.order, at[-1])
        of_token = at[-1]
        lower = np.maximum(left - self.d1[np.minimum(left, 3)], 0) / max(self.before, 1) + self.backoff / (self.types + 1)
        p = lower[of_token]
        for level in self.levels:
            words = [number[x] for x in at[-level.width :]]
            if level.contexts is None:
                (total, ones, twos, more), place = of_word, at[-2]
                key, back = distinct(gram_hash(words))
                seen = level.grams.look_up(key)[0][back]
            else:
                key, place = distinct(gram_hash(words[:-1]))
                places = np.zeros(len(key), np.int64)
                total, ones, twos, more, offset = level.contexts.look_up(key, places=places)
                of_context = [x[place] for x in (parts_of(key, level.grams.parts), places, offset, ones + twos + more)]
                seen = level.grams.look_up(*of_context, words[-1])
            context = np.maximum(total, 1)
            freed = np.where(total > 0, (level.d[1] * ones + level.d[2] * twos + level.d[3] * more) / context, 1.0)
            held = np.maximum(seen - level.d[np.minimum(seen, 3)], 0)
            p = held / context[place] + freed[place] * p
        base = (count + 1.0) / (self.tokens + self.types + 1.0)
        return np.log10(p), np.log10(base)[of_token], (count > 0)[of_token]


def train(docs: DataFrame, staging: Staging, order: int = 2) -> Model:
    """Counts the texts of ``docs`` and stores the arrays."""
    if order < 2:
        raise ValueError(f"order must be 2 or more, not {order}")
    parts = part_count(docs.sparkSession)
    folder = staging.folder("model")
    texts = docs.select("text")
    stored = staging.keep(deal(texts.mapInArrow(_send_words(parts), GRAMS), parts).mapInArrow(_store_vocabulary(folder, parts), VOCABULARY), "vocabulary")
    files = stored.collect()  # a row per range
    listed = Table(folder, {r["part"]: r["file"] for r in files}, parts, [])
    vocabulary = Vocabulary(listed, {r["part"]: r["words"] for r in files})
    sent = deal(texts.mapInArrow(_send_grams(parts, order, vocabulary), GRAMS), parts)
    levels, kept = [], [stored]
    for width in range(order, 1, -1):
        stored = staging.keep(sent.mapInArrow(_store_grams(folder, parts, width, width == order, vocabulary), ROWS), f"grams{width}")
        kept.append(stored)

        def of(kind: str, rows: DataFrame = stored) -> DataFrame:
            return rows.where(F.col("kind") == kind).select("part", "cells")

        files = stored.where("kind IN ('shard', 'context')").select("kind", "part", "file", "c1", "c2", "c3", "c4").collect()  # two rows per range
        shards = [r for r in files if r["kind"] == "shard"]
        names = {r["part"]: r["file"] for r in shards}
        of_grams, contexts = (Members(folder, names, parts) if width > 2 else Table(folder, names, parts, ["<i8"])), None
        if width > 2:
            contexts = Table(folder, {r["part"]: r["file"] for r in files if r["kind"] == "context"}, parts, _OF_CONTEXT)
        d = discounts([sum(r[f"c{i}"] for r in shards) for i in (1, 2, 3, 4)])
        levels.insert(0, Level(width, of_grams, contexts, d))
        sent = deal(of("grams"), parts)
    packed = reduce(DataFrame.unionAll, [s.where("kind = 'words'").select("part", "cells") for s in kept[1:]])
    kept.append(staging.keep(deal(packed, parts).mapInArrow(_store_words(folder, parts, vocabulary), TOTALS), "words"))
    words = kept[-1].collect()  # a row per range
    for stored in kept:
        staging.drop(stored)
    c1 = [sum(r[f"c{i}"] for r in words) for i in (1, 2, 3, 4)]
    types = sum(r["types"] for r in words)
    return Model(
        levels, Table(folder, {r["part"]: r["file"] for r in words}, parts, ["<i8"] * len(_FIELDS)), vocabulary,
        sum(r["tokens"] for r in words), types, sum(r["before"] for r in words), discounts(c1), c1, types - c1[0] - c1[1],
    )


_SCORES = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scorer(model: Model) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in W.blocks(batch.column("text"), W.LOWER, size=4 * W.BLOCK):
                token, first = marked(block)
                at = first[:-1]
                log_p, log_base, known = model.score(token, at)
                rows = ids.slice(block.rows.start, len(block.rows))
                yield pa.RecordBatch.from_arrays([
                    rows, pa.array(np.diff(first), pa.int64()),
                    pa.array(np.add.reduceat(known.astype(np.int64), at), pa.int64()),
                    pa.array(np.add.reduceat(log_base, at), pa.float64()),
                    pa.array(np.add.reduceat(log_p, at), pa.float64()),
                ], schema=_SCORES)

    return score


def score_documents(docs: DataFrame, training: Column, staging: Staging | None = None, order: int = 2) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, train_tokens, perplexity), learning from rows where ``training`` holds."""
    staging = staging or Staging(docs.sparkSession, "language-model")
    model = train(docs.where(training), staging, order)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (
        rows.mapInArrow(_scorer(model), SCORES)
        .withColumn("train_tokens", F.lit(model.tokens).cast("long"))
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    )
