"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct five-word shingles (lower-cased A-Z).
Documents are linked if the sets' Jaccard similarity is at least 0.75, decided
on the full sets; a component of linked documents keeps its smallest id.

Candidates: every set has ``COORDINATES`` minwise values.  A tree branches the
sets by the values at two coordinates chosen per level; sets that share the
value share a node.  A pair of similarity s stays together in each branch with
probability s.  ``TREES`` independent trees have twice as many branches at the
root, so a pair at the threshold is missed with probability 0.25^(2 TREES),
6e-8, where nodes are small at once, and about 0.11^TREES, 2e-6, however deep
the trees go.

* Equal sets are one class from the start, whatever their number.
* Every member of a node is first compared with one member, the node's hub.
  Confirmed links make components, and a node within one component is done:
  a large group of near copies costs one comparison a member.
* Nodes of up to ``SMALL`` members that still touch several components are
  compared exhaustively, between members of different components, inside a
  task: it makes links and no rows of pairs.  The likeliest pairs come first,
  and a pair that earlier links have connected is left out.  A pair that
  shares several roots is compared in the first.
* Larger ones branch again.  At ``DEPTH`` levels the rest is compared
  exhaustively too, in blocks.  Nothing is capped.

A sketch (one byte of each minwise value) discards pairs that agree in fewer
than ``AGREE`` of ``COORDINATES`` places before their sets are fetched; a pair
at the threshold does so with a probability below 1e-6.  Sets are made again
from the texts of the documents that need them; a bitmap of fixed size spares
the others.

Nulls and edges: documents without words have an empty set, are linked with
nothing and kept; with one to four words the whole sequence is one shingle.
Identical rows are copies of one document with one id.  Rows with a null id
take part; a component's id is its smallest id that is not null.
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
from .components import star_forest
from .packed import group_starts
from .rows import free_name, keyed

SHINGLE = 5
THRESHOLD = 75
TREES = 6
COORDINATES = 64
AGREE = 30
SMALL = 4096
MEAN_SHINGLES = 1024  # so a small node has at most SMALL times so many
DEPTH = 6
BLOCK_ROWS = 1024

_SEEDS = W.mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(block: W.Block) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    starts, hashes = W.windows(block.hashes, block.first, SHINGLE, seed=5)
    bounds = np.searchsorted(starts, block.first)
    out = []
    for i, n in enumerate(block.counts):
        if n >= SHINGLE:
            out.append(np.unique(hashes[bounds[i] : bounds[i + 1]]))
        elif n:
            whole = block.hashes[block.first[i] : block.first[i + 1]]
            out.append(W.windows(whole, np.array([0, n]), int(n), seed=100 + int(n))[1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _identity(values: np.ndarray) -> bytes:
    """128 bits that depend on the set only."""
    low = W.mix(values).sum(dtype=np.uint64)
    high = W.mix(values ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return low.tobytes() + high.tobytes() + len(values).to_bytes(4, "little")


_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()),
    ("cls", pa.binary()), ("sketch", pa.binary()), ("roots", pa.binary()), ("minima", pa.list_(pa.int32())),
])
SIGNED = "doc_id long, version long, n long, cls binary, sketch binary, roots binary, minima array<int>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, versions = batch.column("doc_id").to_pylist(), batch.column("version").to_pylist()
        for block in W.blocks(batch.column("text"), W.LOWER):
            sets = shingle_sets(block)
            sizes = np.array([len(s) for s in sets])
            filled = np.flatnonzero(sizes)
            minima = np.zeros((len(sets), COORDINATES), np.uint64)
            if len(filled):
                flat = np.concatenate([sets[i] for i in filled])
                heads = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
                for k, seed in enumerate(_SEEDS):
                    minima[filled, k] = np.minimum.reduceat(W.mix(flat ^ seed), heads)
            sketches = (minima & np.uint64(255)).astype(np.uint8)
            signed = minima.astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[i] for i in block.rows], pa.int64()),
                pa.array([versions[i] for i in block.rows], pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array([_identity(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([x.tobytes() for x in sketches], pa.binary()),
                pa.array([x.tobytes() for x in np.ascontiguousarray(signed[:, : 2 * TREES])], pa.binary()),
                pa.array(list(signed), pa.list_(pa.int32())),
            ], schema=_SIGNED)


def _sets_of(bitmap) -> Callable:
    """(row, cls, members) of the rows that the bitmap does not rule out."""
    schema = pa.schema([("row", pa.int64()), ("cls", pa.binary()), ("members", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(maybe_in(bitmap.value, batch.column("row").to_numpy())))
            row = batch.column("row")
            for block in W.blocks(batch.column("text"), W.LOWER):
                sets = shingle_sets(block)
                yield pa.RecordBatch.from_arrays([
                    row.slice(block.rows.start, len(block.rows)), pa.array([_identity(s) for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ], schema=schema)

    return make


PAIR = "a binary, b binary"
_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and sketches allow the threshold."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
        sa, sb = (
            np.frombuffer(b"".join(x.as_py() for x in batch.column(c)), np.uint8).reshape(-1, COORDINATES)
            for c in ("sa", "sb")
        )
        fit = 100 * np.minimum(na, nb) >= THRESHOLD * np.maximum(na, nb)
        use = pa.array(fit & ((sa == sb).sum(axis=1) >= AGREE))
        yield batch.select(["a", "b"]).filter(use)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by node, a batch of whole nodes at a time."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        node = rows.column("node").to_numpy()
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0  # the last node may go on
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _nodes(rows: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end, i, j, agreement) of each node: its alike pairs in different components.

    A pair that shares an earlier root, which is not too large to be compared
    there, is left to that one.
    """
    node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
    comp = rows.column("comp").dictionary_encode().indices.to_numpy()
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES)
    root, large = rows.column("root").to_numpy(), rows.column("large").to_numpy()
    roots = np.frombuffer(b"".join(rows.column("roots").to_pylist()), "<i4").reshape(-1, 2 * TREES)
    bounds = np.concatenate([group_starts(node), [len(node)]]).tolist()
    for low, high in zip(bounds[:-1], bounds[1:]):
        found = []
        for at in range(low, high, 64):
            stop = min(at + 64, high)
            x, y = slice(at, stop), slice(at + 1, high)
            fit = (comp[x, None] != comp[None, y]) & (np.arange(at, stop)[:, None] < np.arange(at + 1, high)[None, :])
            fit &= 100 * np.minimum(n[x, None], n[None, y]) >= THRESHOLD * np.maximum(n[x, None], n[None, y])
            i, j = np.nonzero(fit)
            i, j = at + i, at + 1 + j
            for k in range(max(root[low], 0)):
                first = (roots[i, k] == roots[j, k]) & ((large[i] >> k) & 1 == 0)
                i, j = i[~first], j[~first]
            agree = np.concatenate([(sketch[i[z : z + 65536]] == sketch[j[z : z + 65536]]).sum(axis=1) for z in range(0, len(i), 65536)] or [np.zeros(0, int)])
            use = agree >= AGREE
            found.append((i[use], j[use], agree[use]))
        yield low, high, *(np.concatenate(x) for x in zip(*found))


def _in_question(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, cls) of the members that have an alike partner in another component."""
    for rows in _runs(batches):
        at = [np.unique(np.concatenate([i, j])) for _, _, i, j, _ in _nodes(rows)]
        yield rows.select(["node", "cls"]).take(pa.array(np.concatenate(at), pa.int64()))


def _common(s: np.ndarray, t: np.ndarray) -> int:
    if len(s) > len(t):
        s, t = t, s
    return int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())


def _linked(s: np.ndarray, t: np.ndarray) -> bool:
    common = _common(s, t)
    return 100 * common >= THRESHOLD * (len(s) + len(t) - common)


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what the full sets connect in each node."""
    for rows in _runs(batches):
        comp = rows.column("comp").dictionary_encode().indices.to_numpy()
        cls, members = rows.column("cls"), rows.column("members")
        found: list[tuple[int, int]] = []
        for low, high, i, j, agree in _nodes(rows):
            sets = {r: np.frombuffer(members[r].as_buffer(), "<u8") for r in range(low, high)}
            parent = {int(c): int(c) for c in comp[low:high]}

            def find(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            order = np.argsort(-agree, kind="stable")
            for x, y in zip(i[order].tolist(), j[order].tolist()):
                a, b = find(int(comp[x])), find(int(comp[y]))
                if a != b and _linked(sets[x], sets[y]):
                    parent[a] = b
                    found.append((x, y))
        if found:
            a, b = (pa.array(x, pa.int64()) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([cls.take(a), cls.take(b)], names=["u", "v"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets reach the threshold."""
    for batch in batches:
        sets = [[np.frombuffer(x.as_buffer(), "<u8") for x in batch.column(c)] for c in ("ma", "mb")]
        yield batch.select(["a", "b"]).filter(pa.array([_linked(s, t) for s, t in zip(*sets)], pa.bool_()))


def _coordinates(tree: int) -> list[int]:
    """The tree's order of coordinates; the roots of all trees use different ones."""
    root = [2 * tree, 2 * tree + 1]
    rest = [c for c in range(COORDINATES) if c not in root]
    return root + list(np.random.default_rng(tree).permutation(rest))


class _Join:
    def __init__(self, docs: DataFrame):
        self.staging = Staging(docs.sparkSession, "near")
        self.rows = keyed(docs)
        self.signed = self.staging.keep(self.rows.mapInArrow(_sign, SIGNED), "signed")
        full = self.signed.where("n > 0")
        self.classes = self.staging.keep(
            full.groupBy("cls").agg(
                F.first("n").alias("n"), F.first("sketch").alias("sketch"),
                F.first("roots").alias("roots"), F.first("minima").alias("minima"),
                F.min(F.struct("doc_id", "version")).alias("row"),
            ),
            "classes",
        )

    def branch(self, members: DataFrame, level: int) -> DataFrame:
        """(tree, node, cls, n, root) one level below members (tree, node, cls, n, minima); ``root`` numbers the roots."""
        table = F.array(*[F.array(*[F.lit(int(c)) for c in _coordinates(t)[2 * level : 2 * level + 2]]) for t in range(TREES)])
        chosen = F.explode(F.get(table, F.col("tree"))).alias("_c")
        return members.select("tree", "node", "cls", "n", "minima", chosen).select(
            "tree", F.xxhash64("tree", "node", "_c", F.get("minima", F.col("_c"))).alias("node"), "cls", "n",
            (F.col("_c") if level == 0 else F.lit(-1)).alias("root"),
        )

    def roots(self) -> DataFrame:
        trees = F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree")
        return self.branch(self.classes.select(trees, F.lit(0).cast("long").alias("node"), "cls", "n", "minima"), 0)

    def shared(self, members: DataFrame) -> DataFrame:
        """Members of nodes with more than one class, with the node's size and hub.

        The size is the number of members, or that of members of MEAN_SHINGLES
        with as many shingles, if there are more of those: nodes of long texts
        are large with fewer members.
        """
        nodes = members.groupBy("node").agg(
            F.count("*").alias("_count"), F.sum(F.col("n").cast("long")).alias("_shingles"), F.min("cls").alias("hub")
        ).where("_count > 1")
        size = F.greatest("_count", F.expr(f"_shingles div {MEAN_SHINGLES}")).alias("size")
        return self.staging.keep(members.drop("n").join(nodes.select("node", size, "hub"), "node"), "nodes")

    def described(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with both sides' sizes and sketches."""
        for side in ("a", "b"):
            named = self.classes.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
            pairs = pairs.join(named, side)
        return pairs

    def star_pairs(self, members: DataFrame) -> DataFrame:
        pairs = members.where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
        return self.staging.keep(self.described(pairs).mapInArrow(_alike, PAIR), "pairs")

    def crossing(self, members: DataFrame, stars: DataFrame) -> DataFrame:
        """Members of nodes that touch several components, with their component."""
        comp = stars.select(F.col("v").alias("cls"), F.col("u").alias("_root"))
        known = members.join(comp, "cls", "left").withColumn("comp", F.coalesce("_root", "cls")).drop("_root")
        mixed = known.groupBy("node").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x < _y")
        return self.staging.keep(known.join(mixed.select("node"), "node", "left_semi"), "crossing")

    def small_links(self, members: DataFrame, large: DataFrame) -> DataFrame:
        """Links between components within nodes of bounded size, a node in one task."""
        bit = F.bit_or(F.expr("shiftleft(1, root)")).alias("large")
        masks = large.where("root >= 0").groupBy("cls").agg(bit)
        about = self.classes.select("cls", "n", "sketch", "roots")
        rows = members.select("node", "root", "cls", "comp").join(about, "cls").join(masks, "cls", "left")
        rows = self.staging.keep(rows.withColumn("large", F.coalesce("large", F.lit(0))), "members")
        sorted_rows = rows.repartition("node").sortWithinPartitions("node")
        asked = self.staging.keep(sorted_rows.mapInArrow(_in_question, "node long, cls binary"), "asked")
        sets = self.sets(asked.select("cls").distinct())
        full = rows.join(asked, ["node", "cls"]).join(sets, "cls")
        full = full.repartition("node").sortWithinPartitions("node")
        links = self.staging.keep(full.mapInArrow(_settle, "u binary, v binary"), "links")
        self.staging.drop(rows, asked, sets)
        return links

    def large_pairs(self, members: DataFrame) -> DataFrame:
        """The same within nodes of any size, a block of one side at a time."""
        rows = members.join(self.classes.select("cls", "n", "sketch"), "cls")
        blocks = F.ceil(F.col("size") / F.lit(BLOCK_ROWS)).cast("int")
        left = rows.select(
            "node", F.pmod(F.xxhash64("cls"), blocks).cast("int").alias("block"), F.col("cls").alias("a"),
            F.col("n").alias("na"), F.col("sketch").alias("sa"), F.col("comp").alias("ca"),
        )
        right = rows.select(
            "node", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.col("cls").alias("b"),
            F.col("n").alias("nb"), F.col("sketch").alias("sb"), F.col("comp").alias("cb"),
        )
        fit = (F.col("ca") < F.col("cb")) & (100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))
        both = left.join(right, ["node", "block"]).where(fit).select("a", "b", "na", "nb", "sa", "sb")
        return self.staging.keep(both.mapInArrow(_alike, PAIR).distinct(), "pairs")

    def sets(self, needed: DataFrame) -> DataFrame:
        """(cls, members) of the classes of a table (cls), from the texts."""
        row = F.xxhash64("row.doc_id", "row.version").alias("row")
        rows = self.staging.keep(self.classes.join(needed, "cls", "left_semi").select(row), "needed")
        bitmap = self.staging.spark.sparkContext.broadcast(bitmap_of(rows))
        texts = self.rows.select(F.xxhash64("doc_id", "version").alias("row"), "text")
        sets = texts.mapInArrow(_sets_of(bitmap), "row long, cls binary, members binary")
        # a row may stand in the table twice
        sets = sets.join(rows, "row", "left_semi").groupBy("cls").agg(F.first("members").alias("members"))
        sets = self.staging.keep(sets, "sets")
        self.staging.drop(rows)
        return sets

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """(u, v) links among pairs (a, b)."""
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
        left = sets.select(F.col("cls").alias("a"), F.col("members").alias("ma"))
        right = sets.select(F.col("cls").alias("b"), F.col("members").alias("mb"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb")
        links = both.mapInArrow(_confirm, PAIR).select(F.col("a").alias("u"), F.col("b").alias("v"))
        links = self.staging.keep(links, "confirmed")
        self.staging.drop(sets, pairs)
        return links

    def connect(self, stars: DataFrame, links: DataFrame) -> DataFrame:
        return stars if links.isEmpty() else star_forest(self.staging, links.unionAll(stars.select("u", "v")))

    def components(self) -> DataFrame:
        """(v, u): classes that are not the smallest of their component, with that smallest."""
        members = self.shared(self.roots())
        none = members.select(F.col("cls").alias("u"), F.col("cls").alias("v")).limit(0)
        stars = self.connect(none, self.confirm(self.star_pairs(members)))
        for level in range(1, DEPTH + 1):
            members = self.crossing(members, stars)
            large = members.where(F.col("size") > SMALL)
            stars = self.connect(stars, self.small_links(members.where(F.col("size") <= SMALL), large))
            if large.isEmpty():
                break
            if level == DEPTH:
                return self.connect(stars, self.confirm(self.large_pairs(large)))
            deeper = self.crossing(large.drop("comp"), stars).select("tree", "node", "cls")
            members = self.shared(self.branch(deeper.join(self.classes.select("cls", "n", "minima"), "cls"), level))
            stars = self.connect(stars, self.confirm(self.star_pairs(members.where(F.col("size") > SMALL))))
        return stars


def _decided(docs: DataFrame) -> DataFrame:
    """(doc_id, version, n_shingles, component_id, survives), a row per document.

    The row of a component with the smallest (doc_id, version) survives, null
    ids last; rows without shingles survive all.
    """
    join = _Join(docs)
    stars = join.components()
    rows = join.signed.select("doc_id", "version", "n", "cls")
    full = rows.where("n > 0").join(
        stars.select(F.col("v").alias("cls"), F.col("u").alias("_root")), "cls", "left"
    ).withColumn("comp", F.coalesce("_root", "cls"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("version").alias("v"))
    smallest = full.groupBy("comp").agg(F.min("doc_id").alias("component_id"), F.min(place).alias("_least"))
    survives = F.col("doc_id").eqNullSafe(F.col("_least.id")) & (F.col("version") == F.col("_least.v"))
    named = full.join(smallest, "comp").select(
        "doc_id", "version", F.col("n").alias("n_shingles"), "component_id", survives.alias("survives")
    )
    empty = rows.where("n = 0").select(
        "doc_id", "version", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("survives")
    )
    return named.unionAll(empty)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, version, n_shingles, component_id, kept), a row per document."""
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return _decided(docs).drop("survives").withColumn("kept", kept)


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each component, that with its smallest (id, version), all columns kept.

    Null ids come last.  Rows that repeat it wholly are dropped too.
    """
    decided = _decided(docs).select(
        F.col("doc_id").alias("_d"), F.col("version").alias("_v"), F.col("survives").alias("_kept")
    )
    decided = Staging(docs.sparkSession, "near").keep(
        decided.groupBy("_d", "_v").agg(F.first("_kept").alias("_kept"), F.count("*").alias("_n")), "decided"
    )
    version = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    gone = decided.where(~F.col("_kept"))
    out = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_d"]) & (version == gone["_v"]), "left_anti")
    again = decided.where(F.col("_kept") & (F.col("_n") > 1))
    if again.isEmpty():
        return out
    version = F.xxhash64(F.coalesce(out["text"], F.lit("")))
    same = out["doc_id"].eqNullSafe(again["_d"]) & (version == again["_v"])
    name = free_name(docs.columns, "_text_version")
    once = out.join(again, same, "left_semi").withColumn(name, F.xxhash64(F.coalesce("text", F.lit(""))))
    return out.join(again, same, "left_anti").unionAll(once.dropDuplicates(["doc_id", name]).drop(name))
