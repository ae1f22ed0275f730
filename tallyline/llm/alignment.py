"""Tokens of two tokenizers over the same bytes, aligned in lockstep.

Each text is encoded by a byte-level tokenizer A (with a space put before it)
and by a piece tokenizer B (which adds one).  Both give tokens of at least one
byte, so the ends of the tokens rise, and a group ends wherever a token of each
ends at the same byte.  The two last tokens of a group are linked.

Merging is done for many documents at once: a state vector holds one pointer
into A and one into B per document.  Every step compares the ends under all
pointers, emits a link and a cut where they are equal, advances the pointers
that are not ahead of the other, and drops the documents that are finished.
Long documents are entered at several ends that both sides share, each with
pointers of its own, so that they need no more steps than short ones.

An id pair's count is the number of its links in the whole corpus.  Tasks count
the pairs of many documents before anything is shuffled; Spark sums the counts
and marks the pairs with their B id's highest one; they are stored as sorted
hash arrays that the last pass maps and looks up.  Links wait in the staged
rows, so no text is encoded twice.

Nulls and edges: a text that is null or empty, or whose tokens of A or B do not
spell space+text (for example with U+2581 in it, or with a lone surrogate), has
no tokens: all numbers are 0 and ``groups_sha256`` is ''.  Strings of special
tokens are plain text.  Rows are documents of their own, repeated rows and null
ids included; other columns of the input take no part.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import Staging
from .packed import deal, part_count, parts_of
from .shards import Table, write_shard
from .words import mix

BLOCK_CHARS = 1 << 20  # texts that advance together
SPAN, TRIES = 1024, 64
LINKS_AT_ONCE = 1 << 19  # looked up together
PAIRS_HELD = 1 << 21  # distinct pairs that a task counts before it sends them

# B's space and its byte pieces.
B_SPACE = "▁"
# How byte-level tokenizers split a text, with the letters and digits of plain texts written out.
A_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?[0-9]+| ?[^\\s{inside}0-9]+|\\s+(?!\\S)|\\s+"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_A_PLAIN = re.compile(A_SPLIT.format(letter=f"[{_LETTERS}]", inside=_LETTERS))
_NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7eÀ-ÿ]")
CACHED_PIECES = 200_000
_BYTE_PIECE = re.compile("<0x([0-9A-Fa-f]{2})>")

_DOCS = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pair long, n long"
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_level_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies: a printable Latin-1 byte is itself, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class _ByPiece:
    """Encodes each distinct piece of plain texts once, where the tokenizer's file splits texts by ``A_SPLIT``.

    Plain texts have characters that every edition of Unicode classes alike.
    """

    def __init__(self, tokenizer, path: str):
        self.tokenizer, self.cache = tokenizer, {}
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        split = told.get("pre_tokenizer") or {}
        self.able = (
            not told.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex") is True
            and split.get("add_prefix_space") is False and not told["model"].get("dropout")
        )
        vocabulary = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        space = next(c for c, b in byte_level_alphabet().items() if b == 0x20)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(space)]] = True

    def _learn(self, pieces: set[str]) -> None:
        worded = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        groups = [worded[k : k + 100] for k in range(0, len(worded), 100)]
        for group, done in zip(groups, self.tokenizer.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(done.ids, "<u4")
            bounds = [*(4 * np.flatnonzero(self.opens[ids])).tolist(), 4 * len(ids)]
            data = ids.tobytes()
            for piece, begin, end in zip(group, bounds[:-1], bounds[1:], strict=True):
                self.cache[piece] = data[begin:end]
        other = list(pieces.difference(worded))
        for piece, done in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self.cache[piece] = np.array(done.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [_A_PLAIN.findall(t) if self.able and not _NOT_PLAIN.search(t) else None for t in texts]
        pieces = set().union(*(s for s in split if s))
        if len(self.cache) + len(pieces) > CACHED_PIECES:
            self.cache.clear()
        self._learn(pieces - self.cache.keys())
        known = self.cache.__getitem__
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.int64) if s is None
            else np.frombuffer(b"".join(map(known, s)), "<u4").astype(np.int64)
            for t, s in zip(texts, split)
        ]


class Tokens:
    """Both tokenizers with their tokens' bytes."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it has
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a_pieces = _ByPiece(self.a, a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_level_alphabet()
        entries = sorted((i, token) for token, i in self.a.get_vocab().items())
        a_bytes = [b""] * (entries[-1][0] + 1)
        for i, token in entries:
            a_bytes[i] = bytes(map(alphabet.get, token)) if all(c in alphabet for c in token) else token.encode()
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(B_SPACE, " ").encode())
        self.bytes = a_bytes, b_bytes
        self.sizes = tuple(np.array([len(x) for x in some], np.int64) for some in self.bytes)
        self.digits = tuple(_digits(len(some)) for some in self.bytes)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        return self.a_pieces.encode([" " + t for t in texts]), self.b.encode(texts, num_threads=1)

    def spells(self, side: int, ids, data: bytes) -> bool:
        return b"".join(map(self.bytes[side].__getitem__, ids)) == data


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..n-1, one row of bytes with a free last byte each, and their number."""
    width = len(str(max(n - 1, 1)))
    text = np.array([str(i) for i in range(n)], f"S{width + 1}")
    rows = text.view(np.uint8).reshape(n, width + 1)
    return rows, (rows > 0).sum(axis=1)


def spans(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents' bounds with more of them inside long documents, at ends that both sides share.

    Near every SPAN-th end of A the first of the next few that B has too is
    taken, so that a long document advances at many places at once.
    """
    from_here = np.arange(SPAN - 1, len(a_ends), SPAN)
    tried = np.minimum(from_here[:, None] + np.arange(TRIES), len(a_ends) - 1)
    at_b = np.minimum(np.searchsorted(b_ends, a_ends[tried]), len(b_ends) - 1)
    shared = b_ends[at_b] == a_ends[tried]
    some = shared.any(axis=1)
    pick = shared.argmax(axis=1)[some]
    rows = np.flatnonzero(some)
    a_bounds = np.union1d(a_first, tried[rows, pick] + 1)
    return a_bounds, np.union1d(b_first, at_b[rows, pick] + 1)


def merge(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in A and in B of all linked tokens, in order.

    Ends rise over all documents.  Those of document i are
    ``a_ends[a_first[i]:a_first[i + 1]]``, and so for B.
    """
    a, b = a_first[:-1].copy(), b_first[:-1].copy()
    a_stop, b_stop = a_first[1:], b_first[1:]
    linked_a, linked_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(a):
        alive = (a < a_stop) & (b < b_stop)
        if not alive.all():
            a, b, a_stop, b_stop = a[alive], b[alive], a_stop[alive], b_stop[alive]
        at_a, at_b = a_ends[a], b_ends[b]
        even = at_a == at_b
        linked_a.append(a[even])
        linked_b.append(b[even])
        a = a + (at_a <= at_b)
        b = b + (at_b <= at_a)
    # links cross nowhere, so both sides have the same order
    return np.sort(np.concatenate(linked_a)), np.sort(np.concatenate(linked_b))


def _written(tokens: Tokens, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups in decimal, each group followed by ';', and the end of each group's text.

    A token of A comes after the B tokens of earlier groups, one of B after the
    A tokens of its own group too.
    """
    group_a = np.searchsorted(cut_a, np.arange(len(a)))
    group_b = np.searchsorted(cut_b, np.arange(len(b)))
    place_a = np.arange(len(a)) + np.concatenate([[0], cut_b + 1])[group_a]
    place_b = np.arange(len(b)) + (cut_a + 1)[group_b]
    n = len(a) + len(b)
    width = max(d.shape[1] for d, _ in tokens.digits)
    cells = np.zeros((n, width), np.uint8)
    after = np.full(n, ord(","), np.uint8)
    lengths = np.empty(n, np.int64)
    for ids, place, (digits, sizes) in ((a, place_a, tokens.digits[0]), (b, place_b, tokens.digits[1])):
        cells[place, : digits.shape[1]] = digits[ids]
        lengths[place] = sizes[ids]
    after[place_a[cut_a]] = ord("|")
    after[place_b[cut_b]] = ord(";")
    cells[np.arange(n), lengths] = after
    ends = np.cumsum(lengths + 1)
    return cells[cells > 0].tobytes(), ends[place_b[cut_b]]


class Block:
    """Aligned documents of a block: counts, digests and link codes of each."""

    def __init__(self, tokens: Tokens, texts: list[str | None]):
        self.count = len(texts)
        some = [i for i, t in enumerate(texts) if t]
        datas = {i: _bytes(texts[i]) for i in some}
        some = [i for i in some if datas[i] is not None]
        a_ids, b_ids = tokens.encode([texts[i] for i in some])
        good = [
            k for k, i in enumerate(some)
            if tokens.spells(0, a_ids[k], b" " + datas[i]) and tokens.spells(1, b_ids[k], b" " + datas[i])
        ]
        self.rows = np.array([some[k] for k in good], np.int64)
        n_a = np.array([len(a_ids[k]) for k in good], np.int64)
        n_b = np.array([len(b_ids[k]) for k in good], np.int64)
        none = [np.zeros(0, np.int64)]
        a = np.concatenate(none + [a_ids[k] for k in good])
        b = np.concatenate(none + [np.array(b_ids[k], np.int64) for k in good])
        self.a, self.b = a, b
        self.a_first, self.b_first = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        # tokens of both sides spell the same bytes, so the running sums meet at each document's end
        ends = np.cumsum(tokens.sizes[0][a]), np.cumsum(tokens.sizes[1][b])
        bounds = spans(*ends, self.a_first, self.b_first) if len(a) else (self.a_first, self.b_first)
        self.link_a, self.link_b = merge(*ends, *bounds)
        self.first = np.searchsorted(self.link_a, self.a_first)  # of each document's links
        self.digests = [""] * len(self.rows)
        if len(self.rows):
            written, group_ends = _written(tokens, a, b, self.link_a, self.link_b)
            view, begin = memoryview(written), 0
            for k, last in enumerate(self.first[1:]):
                end = int(group_ends[last - 1])
                self.digests[k] = hashlib.sha256(view[begin : end - 1]).hexdigest()
                begin = end

    def codes(self) -> np.ndarray:
        """A number for the id pair of each link; B ids have 32 bits."""
        return self.a[self.link_a] << 32 | self.b[self.link_b]


def _bytes(text: str) -> bytes | None:
    try:
        return text.encode()
    except UnicodeEncodeError:
        return None


def _packed(codes: np.ndarray) -> bytes:
    """Link codes in order: one byte for the width of an id, all A ids, all B ids."""
    codes = np.sort(codes)
    a, b = codes >> 32, codes & 0xFFFFFFFF
    width = 2 if not len(codes) or max(a[-1], b.max()) < 1 << 16 else 4
    return bytes([width]) + a.astype(f"<u{width}").tobytes() + b.astype(f"<u{width}").tobytes()


def _unpacked(cell: pa.Scalar) -> np.ndarray:
    data = np.frombuffer(cell.as_buffer(), np.uint8)
    a, b = data[1:].view(f"<u{data[0]}").reshape(2, -1).astype(np.int64)
    return a << 32 | b


class _Counter:
    """Counts of pairs, merged until there are PAIRS_HELD different ones."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray) -> None:
        some = np.unique(codes, return_counts=True)
        self.held.append(some)
        self.size += len(some[0])

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        pairs, inverse = np.unique(np.concatenate([p for p, _ in self.held] or [np.zeros(0, np.int64)]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n for _, n in self.held] or [np.zeros(0)]), len(pairs)).astype(np.int64)
        self.held, self.size = [(pairs, n)], len(pairs)
        return pairs, n

    def full(self) -> bool:
        if self.size > PAIRS_HELD:
            self.merged()
        return self.size > PAIRS_HELD // 2

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = self.merged()
        self.held, self.size = [], 0
        return out


def _rows(doc_ids, columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "groups_sha256": pa.string(), "links": pa.binary(), "pair": pa.int64(), "n": pa.int64()}
    filled = columns | ({} if doc_ids is None else {"doc_id": doc_ids})
    return pa.RecordBatch.from_arrays([filled.get(c, pa.nulls(n, k)) for c, k in kinds.items()], names=list(kinds))


def _align(a_path: str, b_path: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counter = Tokens(a_path, b_path), _Counter()

        def pairs():
            codes, n = counter.take()
            for k in range(0, len(codes), 1 << 18):
                some = slice(k, k + (1 << 18))
                yield _rows(None, {"pair": pa.array(codes[some]), "n": pa.array(n[some])}, len(codes[some]))

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begin = 0
            while begin < len(texts):
                held, chars = [], 0
                while begin + len(held) < len(texts) and chars < BLOCK_CHARS:
                    held.append(texts[begin + len(held)].as_py())
                    chars += len(held[-1] or "") + 1
                block = Block(tokens, held)
                codes = block.codes()
                counter.add(codes)
                numbers = np.zeros((3, len(held)), np.int64)
                numbers[:, block.rows] = np.diff(block.a_first), np.diff(block.b_first), np.diff(block.first)
                digests, links = [""] * len(held), [_packed(codes[:0])] * len(held)
                for k, i in enumerate(block.rows):
                    digests[i] = block.digests[k]
                    links[i] = _packed(codes[block.first[k] : block.first[k + 1]])
                yield _rows(ids.slice(begin, len(held)), {
                    "n_a": pa.array(numbers[0]), "n_b": pa.array(numbers[1]), "n_groups": pa.array(numbers[2]),
                    "groups_sha256": pa.array(digests), "links": pa.array(links, pa.binary()),
                }, len(held))
                begin += len(held)
                if counter.full():
                    yield from pairs()
        yield from pairs()

    return align


def _with_part(parts: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = parts_of(mix(batch.column("pair").to_numpy().astype(np.uint64)), parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *batch.columns], names=["part", *batch.schema.names])

    return add


def _write_pairs(folder: str, parts: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if batch.num_rows]
        if columns:
            pairs, n, best = (np.concatenate(c) for c in zip(*columns))
            hashes = mix(pairs.astype(np.uint64))
            order = np.argsort(hashes)
            hashes, n, best = hashes[order], n[order], best[order]
            part = parts_of(hashes, parts)
            for p in np.unique(part):
                some = slice(np.searchsorted(part, p), np.searchsorted(part, p, "right"))
                name = write_shard(folder, f"pairs-{p}", hashes[some], [n[some].astype("<i8"), best[some].astype("u1")])
                yield pa.RecordBatch.from_arrays([pa.array([int(p)], pa.int64()), pa.array([name])], names=["part", "name"])

    return write


def _look_up(folder: str, names: dict[int, str], parts: int):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(folder, names, parts, ["<i8", "u1"])
        for batch in batches:
            sizes = np.array([(len(cell.as_buffer()) - 1) // (2 * cell.as_buffer()[0]) for cell in batch.column("links")], np.int64)
            begin = 0
            while begin < batch.num_rows:
                # some documents with about LINKS_AT_ONCE links, or one with more
                held = np.searchsorted(np.cumsum(sizes[begin:]), LINKS_AT_ONCE, "right")
                some = batch.slice(begin, max(1, int(held)))
                begin += some.num_rows
                yield counted(table, some)

    def counted(table: Table, batch: pa.RecordBatch) -> pa.RecordBatch:
        links = [_unpacked(cell) for cell in batch.column("links")]
        sizes = np.array([len(x) for x in links], np.int64)
        pairs, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *links]), return_inverse=True)
        hashes = mix(pairs.astype(np.uint64))
        order = np.argsort(hashes)
        counts, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        counts[order], best[order] = table.look_up(hashes[order])
        sums = [np.concatenate([[0], np.cumsum(x[inverse])]) for x in (best, counts)]
        stop = np.cumsum(sizes)
        own = [pa.array(s[stop] - s[stop - sizes]) for s in sums]
        get = batch.column
        return pa.RecordBatch.from_arrays(
            [get("doc_id"), get("n_a"), get("n_b"), get("n_groups"), pa.array(sizes), *own, get("groups_sha256")],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
        )

    return look_up


class Alignment:
    """The aligned corpus: ``documents()`` with their figures, ``pairs`` with the counts of all id pairs.

    The tokenizers' paths must be open to every executor.
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        self.staging = Staging(self.spark, "alignment")
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.aligned = self.staging.keep(texts.mapInArrow(_align(a_path, b_path), _DOCS), "aligned")
        totals = self.aligned.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n"))
        ids = totals.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n")
        # a B id has at most as many rows as A's vocabulary has ids
        best = F.col("n") == F.max("n").over(Window.partitionBy("b"))
        self.pairs = self.staging.keep(ids.select("pair", "a", "b", "n", best.alias("best")), "pairs")

    def documents(self) -> DataFrame:
        parts = part_count(self.spark)
        folder = self.staging.folder("arrays")
        keyed = self.pairs.select("pair", "n", "best").mapInArrow(_with_part(parts), "part int, pair long, n long, best boolean")
        dealt = deal(keyed, parts).select("pair", "n", "best")
        written = dealt.mapInArrow(_write_pairs(folder, parts), "part long, name string").collect()
        names = {r["part"]: r["name"] for r in written}
        docs = self.aligned.where("pair IS NULL").select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
        return docs.mapInArrow(_look_up(folder, names, parts), _OUT)
