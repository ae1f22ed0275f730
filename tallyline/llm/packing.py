"""Documents packed into token sequences, shortest pack first over the length histogram.

1.  Tasks encode every document, add the end id and cut it into pieces of at
    most ``width`` ids.  A task numbers its pieces of each length; running sums
    of the tasks' counts turn that into a rank among all pieces of the length.
2.  The driver gets the histogram of piece lengths (at most ``width`` rows) and
    packs it: lengths are placed longest first, each into the shortest packs
    there are.  Packs with the same filling are one pattern with a count, so the
    work depends on the number of lengths, not of pieces.
3.  Pieces find their place by length and rank.

The number of packs is fixed beforehand: as many of ``width`` as the tokens
fill, and for the rest one for each power of two in its size, which needs no
padding.  A length that the shortest pack has no room for is cut: its first ids
fill that pack, the others are a shorter length, placed later.  Each cut fills
one pack, so there are fewer cuts than sequences, and no padding at all.

Nulls and edges: a null text is empty; an empty text is its end id alone; rows
are documents of their own, repeated rows and null ids included; an empty table
gives no rows; other columns of the input take no part.  Texts are encoded
whole, as ``tokenizers`` does it: a special token's string in a text is that
token.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import Staging
from . import words as W
from .packed import distinct

WIDTH, END = 2048, 1
BLOCK_CHARS = 1 << 21  # texts encoded together
CACHED_WORDS = 400_000  # so many new ones and as many older ones at most
LAYER = 8  # equal lengths are laid in one step into at most this part of a pack's room

# How the tokenizer's file splits text into words, and the end of a word's last piece.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# Texts whose characters every edition of Unicode classes and lowers alike.
_NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]")

_PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, task long, nth long"
_PLACED = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Encoder:
    """Token ids of texts, as bytes of little-endian unsigned numbers.

    ``last`` tells for each id whether it ends a word (see ``word_ends``).  If
    it is given, each distinct word of a task's plain texts is encoded once:
    its letters, and the punctuation after them, are words of their own to the
    tokenizer.  Words are told apart by their 64-bit hashes.  When
    ``CACHED_WORDS`` are known they become the older ones, of which those that
    occur again move over: frequent words are never forgotten.
    """

    def __init__(self, path: str, last: np.ndarray | None, kind: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it has
        from tokenizers import Tokenizer, pre_tokenizers

        self.kind, self.last = kind, last
        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # words of ASCII letters are written in the vocabulary as they are, others byte by byte
        self.ascii, self.letters = Tokenizer(self.whole.model), Tokenizer(self.whole.model)
        apart = pre_tokenizers.Split(" ", "removed")
        self.ascii.pre_tokenizer = apart
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([apart, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.cache: dict[int, bytes] = {}
        self.older: dict[int, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn(self, words: list[str]) -> list[bytes]:
        ids: dict[str, bytes] = {}
        alone = [w for w in words if w.isalpha()]
        for tokenizer, plain in ((self.ascii, True), (self.letters, False)):
            letters = [w for w in alone if w.isascii() == plain]
            ids.update(zip(letters, self._learn_letters(tokenizer, letters), strict=True))
        return [ids[w] if w in ids else self._bytes(self.whole.encode(w, add_special_tokens=False).ids) for w in words]

    def _learn_letters(self, tokenizer, words: list[str]) -> list[bytes]:
        size, found = np.dtype(self.kind).itemsize, []
        for k in range(0, len(words), 20_000):
            groups = [words[i : i + 100] for i in range(k, min(k + 20_000, len(words)), 100)]
            for done in tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False):
                ids = np.array(done.ids, self.kind)
                ends = ((np.flatnonzero(self.last[ids]) + 1) * size).tolist()
                data = ids.tobytes()
                found += [data[b:e] for b, e in zip([0, *ends], ends)]
        return found

    def _plain(self, text: str) -> str | None:
        """The lowered text, if its words can be encoded one by one."""
        if self.last is None or _NOT_PLAIN.search(text):
            return None
        lowered = text.lower()
        return None if any(s in lowered for s in self.special) else lowered

    def _of_words(self, hashes: list[int], word: Callable[[int], str]) -> list[bytes]:
        """The ids of distinct words; ``word`` tells the one at a place."""
        found = list(map(self.cache.get, hashes))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        if len(self.cache) + len(fresh) > CACHED_WORDS:
            self.cache, self.older = {}, self.cache
            fresh = range(len(hashes))
        new = []
        for i in fresh:
            if (ids := self.older.get(hashes[i])) is None:
                new.append(i)
            else:
                found[i] = self.cache[hashes[i]] = ids
        for i, ids in zip(new, self._learn([word(i) for i in new]), strict=True):
            found[i] = self.cache[hashes[i]] = ids
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self._plain(t) for t in texts]
        some = [p for p in plain if p is not None]
        text, starts, ends, hashes, first = _apart(W.Block(range(len(some)), some, classes=W.MARKS_APART))
        known, at = distinct(hashes)
        one = np.empty(len(known), np.int64)
        one[at] = np.arange(len(at))
        starts, ends = starts[one].tolist(), ends[one].tolist()
        ids = self._of_words(known.tolist(), lambda i: text[starts[i] : ends[i]].decode())
        size = np.dtype(self.kind).itemsize
        flat = np.frombuffer(b"".join(ids), self.kind) if ids else np.array([], self.kind)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // size
        begin = np.cumsum(length) - length
        counts = length[at]
        stop = np.concatenate([[0], np.cumsum(counts)])
        data = flat[np.repeat(begin[at] - stop[:-1], counts) + np.arange(stop[-1])].tobytes()
        cuts = (stop[first] * size).tolist()
        done = iter([data[b:e] for b, e in zip(cuts[:-1], cuts[1:])])
        return [
            self._bytes(self.whole.encode(t, add_special_tokens=False).ids) if p is None else next(done)
            for t, p in zip(texts, plain)
        ]


def _apart(block: W.Block) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, starts, ends, hashes, first of each row) of the block's words.

    Marks that follow a word's only other characters are a word of their own;
    any other word with marks in it is whole.
    """
    starts, ends, hashes = block.starts, block.ends, block.hashes
    head = np.ones(len(starts), bool)
    head[1:] = starts[1:] != ends[:-1]
    at = np.flatnonzero(head)
    size = np.diff(at, append=len(starts))
    marks = W.MARKS_APART[np.frombuffer(block.data, np.uint8)[starts[at]]] == 2 if len(at) else np.zeros(0, bool)
    whole = (size > 2) | (size == 2) & marks
    mixed = at[whole]
    ends[mixed] = ends[mixed + size[whole] - 1]
    hashes[mixed] = W.hash_spans(block.data, starts[mixed], ends[mixed], 0)
    keep = head | ~np.repeat(whole, size)
    first = np.concatenate([[0], np.cumsum(keep)])[block.first]
    return block.data, starts[keep], ends[keep], hashes[keep], first


def word_ends(path: str) -> np.ndarray | None:
    """For each id whether it ends a word, if a tokenizer's file encodes words between blanks independently."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    normal = told.get("normalizer") or {}
    kinds = [n.get("type") for n in normal.get("normalizers", [])]
    steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = steps[0] if steps else {}
    apart = (
        kinds == ["NFC", "Replace", "Lowercase"]
        and normal["normalizers"][1].get("pattern") == {"Regex": r"\s+"}
        and split.get("pattern") == {"Regex": SPLIT} and split.get("behavior") == "Removed" and split.get("invert") is True
        and [s.get("type") for s in steps[1:]] == ["ByteLevel"] and steps[1].get("use_regex") is False
        and told["model"].get("end_of_word_suffix") == WORD_END and not told["model"].get("dropout")
        and not any(re.search(r"[\sA-Z]", t["content"]) or t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"])
    )
    if not apart:
        return None
    vocabulary = Tokenizer.from_file(path).get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    last[[i for word, i in vocabulary.items() if word.endswith(WORD_END)]] = True
    return last


def id_kind(path: str, end: int) -> str:
    """The narrowest unsigned numbers that hold every id."""
    from tokenizers import Tokenizer

    return "<u2" if max(end, *Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else "<u4"


def _cut_texts(path: str, kind: str, last_of_word: np.ndarray | None, width: int, end: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, last_of_word, kind)
        seen = np.zeros(width + 1, np.int64)
        task = TaskContext.get().partitionId()
        last = np.array([end], encoder.kind).tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begin = 0
            while begin < len(texts):
                held, chars = [], 0
                while begin + len(held) < len(texts) and chars < BLOCK_CHARS:
                    held.append(texts[begin + len(held)].as_py() or "")
                    chars += len(held[-1]) + 1
                data = [e + last for e in encoder.encode(held)]
                size = np.dtype(encoder.kind).itemsize
                tokens = np.array([len(d) // size for d in data], np.int64)
                pieces = -(-tokens // width)
                row = np.repeat(np.arange(len(held)), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * width
                length = np.minimum(tokens[row] - start, width)
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                first = np.searchsorted(ordered, ordered)
                nth = np.empty(len(row), np.int64)
                nth[order] = np.arange(len(row)) - first
                nth += seen[length]
                seen += np.bincount(length, minlength=width + 1)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(begin, len(held)).take(pa.array(row)), pa.array(start), pa.array(length.astype(np.int32)),
                    pa.array(tokens[row]), pa.array([data[r][size * s : size * (s + n)] for r, s, n in zip(row, start, length)], pa.binary()),
                    pa.array(np.full(len(row), task)), pa.array(nth),
                ], names=["doc_id", "start", "length", "doc_tokens", "ids", "task", "nth"])
                begin += len(held)

    return cut


class Plan:
    """Where the pieces of each length go.

    A step puts ``count`` ranks of a length, from ``rank`` on, in ``packs``
    sequences from ``sequence`` on, a layer after the other, from ``offset`` on.
    Of a cut piece, a step places ``size`` ids from ``start`` on.
    """

    FIELDS = ("length", "start", "rank", "count", "size", "sequence", "packs", "offset")

    def __init__(self, histogram: dict[int, int], width: int = WIDTH):
        self.width = width
        total = sum(length * n for length, n in histogram.items())
        self.sequences = total // width
        rooms: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room: (first sequence, number, tokens in each)
        if self.sequences:
            rooms[width].append((0, self.sequences, 0))
        for bit in range(width.bit_length()):
            if total % width >> bit & 1:
                rooms[1 << bit].append((self.sequences, 1, 0))
                self.sequences += 1
        self._steps: list[tuple[int, ...]] = []
        self._pack(histogram, rooms)
        steps = np.array(self._steps, np.int64).reshape(-1, len(self.FIELDS))
        steps = steps[np.lexsort((steps[:, 2], steps[:, 1], steps[:, 0]))]
        self.steps = dict(zip(self.FIELDS, steps.T))

    def _pack(self, histogram, rooms) -> None:
        heap = [-room for room in rooms]
        heapq.heapify(heap)

        def put(room: int, some: tuple[int, int, int]) -> None:
            if room not in rooms:
                heapq.heappush(heap, -room)
            rooms[room].append(some)

        runs = defaultdict(list, {length: [(length, 0, n, 0)] for length, n in histogram.items() if n})
        for length in range(self.width, 0, -1):
            for origin, rank, left, start in runs.pop(length, ()):
                while left:
                    room = -heap[0]
                    sequence, packs, filled = rooms[room].pop()
                    if not rooms[room]:
                        del rooms[room]
                        heapq.heappop(heap)
                    if packs > left:
                        put(room, (sequence + left, packs - left, filled))
                        packs = left
                    size = min(length, room)
                    layers = max(1, min(left // packs, room // (LAYER * size)))
                    self._steps.append((origin, start, rank, packs * layers, size, sequence, packs, filled))
                    if room > size * layers:
                        put(room - size * layers, (sequence, packs, filled + size * layers))
                    elif length > size:
                        runs[length - size].append((origin, rank, packs, start + size))
                    rank, left = rank + packs * layers, left - packs * layers

    def place(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(piece, start, size, sequence, offset) arrays, one slice of each piece a round, till all are placed."""
        s = self.steps
        codes = s["length"] * (self.width + 1) + s["start"]
        groups, group = np.unique(codes, return_inverse=True)
        keys = (group.astype(np.int64) << 40) + s["rank"]
        piece, at = np.arange(len(length)), np.zeros(len(length), np.int64)
        while len(piece):
            which = np.searchsorted(groups, length[piece] * (self.width + 1) + at)
            step = np.searchsorted(keys, (which << 40) + rank[piece], "right") - 1
            nth = rank[piece] - s["rank"][step]
            layer, column = np.divmod(nth, s["packs"][step])
            size = s["size"][step]
            yield piece, at, size, s["sequence"][step] + column, s["offset"][step] + layer * size
            more = at + size < length[piece]
            piece, at = piece[more], (at + size)[more]


def _place_pieces(plan: Plan, kind: str):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = {name: batch.column(name) for name in batch.schema.names}
            length = get["length"].to_numpy().astype(np.int64)
            rank = get["rank"].to_numpy()
            start = get["start"].to_numpy()
            ids = [np.frombuffer(cell.as_buffer(), kind).astype("<u4") for cell in get["ids"]]
            for piece, at, size, sequence, offset in plan.place(length, rank):
                some = pa.array(piece)
                yield pa.RecordBatch.from_arrays([
                    get["doc_id"].take(some), pa.array(start[piece] + at), pa.array(size), get["doc_tokens"].take(some),
                    pa.array(sequence), pa.array(offset),
                    pa.array([ids[p][a : a + n].tobytes() for p, a, n in zip(piece, at, size)], pa.binary()),
                ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return place


def pack_documents(
    docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): a row per piece of a document.

    ``ids`` are little-endian unsigned 32-bit numbers.  ``tokenizer`` is the
    path of a file of the ``tokenizers`` library that every executor can open.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "packing")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = id_kind(tokenizer, end)
    pieces = staging.keep(texts.mapInArrow(_cut_texts(tokenizer, kind, word_ends(tokenizer), width, end), _PIECES), "pieces")
    counts = staging.keep(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    # no more rows than lengths reach the driver
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "task"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids", (F.col("before") + F.col("nth")).alias("rank")
    )
    return ranked.mapInArrow(_place_pieces(Plan(histogram, width), kind), _PLACED)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, n_pieces, ids): a sequence holds at most ``width`` pieces, so a group is bounded."""
    piece = F.struct("offset", "length", "ids")
    whole = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), F.sort_array(F.collect_list(piece)).alias("_pieces")
    )
    ids = F.aggregate("_pieces", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return whole.select("sequence_id", "n_tokens", "n_pieces", ids.alias("ids"))
