"""The prefix trie of conversations, built as a z-fast trie.

A conversation is a sequence of turns.  Each of its prefixes has a signature of
128 bits, the sum of its turns' hashes mixed with their depths, so that equal
prefixes and practically no others have equal signatures.  Conversations with
equal turns are one class, inserted once.

The trie is compacted: its nodes are the ends of classes and the prefixes where
classes part; a node holds the signatures along the edge above it.  Its handle
is the prefix whose depth is the two-fattest number of that edge, that is the
one divisible by the highest power of two (Belazzougui, Boldi, Pagh, Vigna,
2009).  A class finds its exit node by fat binary search: of the depths that
are left it probes the two-fattest, a join of its prefix with the handles, and
goes on below that node's end or above the probed depth.  So a conversation of
a thousand turns takes ten joins, not a thousand.

Classes are inserted in batches in random order, a batch being at most
``GROWTH`` times as large as all before.  Those that leave the trie on the same
edge, or for the same new turn, meet in one group, which becomes the new
subtrie there.  As a prefix that many classes share is almost surely in the
trie before the batch (a prefix with m classes in a batch is missing with a
probability of about (1 - 1/GROWTH)^m), groups stay at some hundred classes
however common a first turn is; the first batch is of bounded size.

Sums over subtrees come from jump pointers that double, by joins and groupings.
At last edges are expanded, a row per depth.

Nulls and edges: null roles and texts are empty; rows without a conversation id
belong to no conversation and take no part; a conversation without turns ends
at the root; rows that tie in turn are in the order of role and text; repeated
rows are turns; an empty table has no nodes.  A conversation's signatures are
one row (16 bytes a turn), its texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import Staging
from .words import mix

FIRST_BATCH, GROWTH = 4096, 8
SIGNATURE = 16
ROOT = bytes(SIGNATURE)
CHUNK = 1 << 13  # bytes of member lists that travel together

_SEQUENCES = "conv_id long, depth int, sig binary, sigs binary, chars array<long>"
_NODES = "sig binary, ext int, top int, top_sig binary, top_chars long, edge binary, chars array<long>"
_NO_MEMBER = hashlib.sha256(b"").hexdigest()


def rebuilt_turns(conversations: DataFrame, period: int = 100, choices: int = 6) -> DataFrame:
    """(conv_id, part, at, role, text): branches of each period's first conversation.

    Conversation c gets the first h turns of conversation c - c % period, then
    its own after its first h; h is crc32 of c in decimal, modulo ``choices``.
    Each conversation also has a row of part -1, which is no turn.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.withColumn("at", F.row_number().over(order)).drop("turn")
    taken = (F.crc32(F.col("conv_id").cast("string")) % choices).cast("int")
    ids = rows.select("conv_id").distinct().select("conv_id", taken.alias("_h"), (F.col("conv_id") - F.col("conv_id") % period).alias("_base"))
    heads = numbered.where((F.col("conv_id") % period == 0) & (F.col("at") < choices))
    heads = heads.select(F.col("conv_id").alias("_base"), "at", "role", "text")
    shared = ids.join(heads, "_base").where("at <= _h").select("conv_id", F.lit(0).alias("part"), "at", "role", "text")
    own = numbered.where(F.col("at") > taken).select("conv_id", F.lit(1).alias("part"), "at", "role", "text")
    marks = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("at"), F.lit("").alias("role"), F.lit("").alias("text"))
    return shared.unionAll(own).unionAll(marks)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix signatures and running text lengths of each conversation; its rows come in order, its mark first."""

    def finish(rows: list[np.ndarray]) -> pa.RecordBatch:
        conv, left, right, chars = np.concatenate(rows, axis=1)
        start = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        depth = np.arange(len(conv)) - np.repeat(start, np.diff(np.append(start, len(conv))))
        sums = np.zeros((len(conv), 2), np.uint64)
        for lane, key in enumerate((left, right)):
            turn = mix(key.view(np.uint64) + depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            sums[:, lane] = np.cumsum(np.where(depth > 0, turn, np.uint64(0)))
        first = np.repeat(start, np.diff(np.append(start, len(conv))))
        data = (sums - sums[first]).tobytes()
        total = np.cumsum(chars)
        running = (total - total[first])[depth > 0]
        stop = np.append(start[1:], len(conv))
        turns = stop - start - 1
        begin = ((start + 1) * SIGNATURE).tolist()
        end = (stop * SIGNATURE).tolist()
        return pa.RecordBatch.from_arrays([
            pa.array(conv[start]), pa.array(turns.astype(np.int32)), pa.array([data[e - SIGNATURE : e] for e in end], pa.binary()),
            pa.array([data[b:e] for b, e in zip(begin, end)], pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(turns)).astype(np.int32)), pa.array(running)),
        ], names=["conv_id", "depth", "sig", "sigs", "chars"])

    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy() for c in batch.columns])
        last = np.searchsorted(rows[0], rows[0, -1])  # first row of the batch's last conversation
        if held and rows[0, 0] != held[-1][0, -1]:
            last_before = True
        else:
            last_before = last > 0
        if held and last_before:
            yield finish([*held, rows[:, :last]])
            held = []
        elif not held and last:
            yield finish([rows[:, :last]])
        held.append(rows[:, last:] if last_before or not held else rows)
    if held:
        yield finish(held)


def _subtrie(depth: int, top_sig: bytes, top_chars: int, paths: list[list[bytes]], chars: list[list[int]]) -> list[tuple]:
    """Rows of the nodes that paths from one place make."""
    follower: dict[bytes, bytes] = {}
    nodes = {path[-1] for path in paths}
    for path in paths:
        for here, there in zip(path, path[1:]):
            if follower.setdefault(here, there) != there:
                nodes.add(here)
    made, seen = [], set()
    for path, sums in zip(paths, chars):
        begin, up = 0, (depth, top_sig, top_chars)
        for i, sig in enumerate(path):
            if sig in nodes:
                if sig not in seen:
                    seen.add(sig)
                    made.append((sig, depth + i + 1, *up, b"".join(path[begin : i + 1]), sums[begin : i + 1]))
                begin, up = i + 1, (depth + i + 1, sig, sums[i])
    return made


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """New and changed nodes of each group; groups come one after the other."""
    names = ["sig", "ext", "top", "top_sig", "top_chars", "edge", "chars"]
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    made: list[tuple] = []
    group: list[tuple] = []

    def end_group() -> None:
        if group:
            _, depth, top_sig, top_chars, _, _ = group[0]
            paths = [[tail[i : i + SIGNATURE] for i in range(0, len(tail), SIGNATURE)] for *_, tail, _ in group]
            made.extend(_subtrie(depth, top_sig, top_chars, paths, [row[5] for row in group]))
            group.clear()

    def rows() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)], names=names)
        made.clear()
        return out

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[0] != group[0][0]:
                end_group()
            group.append(row)
        if made:
            yield rows()
    end_group()
    if made:
        yield rows()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Member lists in pieces: rows of a class come together and in order."""
    out: list[tuple] = []
    sig, begin, ids = None, 0, []
    size = 0

    def end_piece() -> None:
        if ids:
            out.append((sig, begin, ",".join(ids).encode()))
            ids.clear()

    def rows() -> pa.RecordBatch:
        got = pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], names=["sig", "begin", "ids"]
        )
        out.clear()
        return got

    for batch in batches:
        for s, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if s != sig or size > CHUNK:
                end_piece()
                sig, begin, size = s, conv, 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield rows()
    end_piece()
    if out:
        yield rows()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each class's member list, streamed over its pieces."""
    sig, state = None, None

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["sig", "ends"])

    for batch in batches:
        done = []
        for s, ids in zip(batch.column("sig").to_pylist(), batch.column("ids")):
            if s != sig:
                if state is not None:
                    done.append((sig, state.hexdigest()))
                sig, state = s, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_buffer())
        if done:
            yield rows(done)
    if state is not None:
        yield rows([(sig, state.hexdigest())])


def two_fattest(low: str, high: str) -> Column:
    """The number of (low, high] that the highest power of two divides."""
    return F.expr(f"shiftleft(-1, length(bin({low} ^ {high})) - 1) & {high}")


def _prefix(sigs: str, depth: str) -> Column:
    return F.expr(f"substring({sigs}, {SIGNATURE} * ({depth}) - {SIGNATURE - 1}, {SIGNATURE})")


class PrefixTrie:
    """The compacted trie of turns (conv_id, part, at, role, text), as of ``rebuilt_turns``.

    ``nodes`` has the compacted nodes but the root; ``rows()`` all prefixes.
    """

    def __init__(self, turns: DataFrame):
        spark = turns.sparkSession
        self.staging = Staging(spark, "trie")
        keyed = turns.select(
            "conv_id", "part", "at", F.xxhash64("role", "text").alias("left"),
            F.xxhash64(F.lit("second"), "text", "role").alias("right"), F.length("text").cast("long").alias("chars"),
        )
        in_order = keyed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
        self.sequences = self.staging.keep(
            in_order.select("conv_id", "left", "right", "chars").mapInArrow(_sequences, _SEQUENCES), "sequences"
        )
        place = F.pmod(F.xxhash64("sig"), F.lit(1 << 52)) / F.lit(float(1 << 52))
        classes = self.sequences.groupBy("sig").agg(
            F.count("*").alias("own"), F.min("conv_id").alias("least"),
            F.min_by(F.struct("depth", "sigs", "chars"), "conv_id").alias("s"),
        ).select("sig", "own", "least", "s.*")
        self.classes = self.staging.keep(classes, "classes")
        size, deepest = self.classes.agg(F.count("*"), F.max("depth")).first()
        bounds, total = [], FIRST_BATCH
        while total < size:
            bounds.append(total / size)
            total *= GROWTH
        batch = reduce(lambda b, bound: b + (place >= bound).cast("int"), bounds, F.lit(0))
        waiting = self.staging.keep(
            self.classes.where("depth > 0").select("depth", "sigs", "chars", batch.alias("batch")), "waiting", partition_by=["batch"]
        )
        self.nodes = spark.createDataFrame([], _NODES)
        for k in range(len(bounds) + 1):
            self._insert(waiting.where(F.col("batch") == k).drop("batch"), deepest or 0, k == 0)

    def _insert(self, batch: DataFrame, deepest: int, first: bool) -> None:
        """Grows ``nodes`` by a batch of (depth, sigs, chars)."""
        found = batch.withColumn("a", F.lit(0)) if first else self._locate(batch, deepest)
        new = found.where("a < depth").select(
            _prefix("sigs", "a + 1").alias("key"), "a",
            F.when(F.col("a") > 0, _prefix("sigs", "a")).otherwise(F.lit(ROOT)).alias("top_sig"),
            F.when(F.col("a") > 0, F.get("chars", F.col("a") - 1)).otherwise(F.lit(0)).cast("long").alias("top_chars"),
            F.expr(f"substring(sigs, {SIGNATURE} * a + 1)").alias("tail"), F.expr("slice(chars, a + 1, depth - a)").alias("chars"),
        )
        new = self.staging.keep(new, "exits")
        old = self.nodes.withColumn("key", _prefix("edge", "1"))
        old = old.join(new.select("key").distinct(), "key", "left_semi")
        old = old.select("key", F.col("top").alias("a"), "top_sig", "top_chars", F.col("edge").alias("tail"), "chars")
        groups = new.unionAll(old).repartition("key").sortWithinPartitions("key")
        grown = self.staging.keep(groups.mapInArrow(_grow, _NODES), "grown")
        kept = self.nodes.join(grown.select("sig"), "sig", "left_anti").select(grown.columns)
        before, self.nodes = self.nodes, self.staging.keep(kept.unionAll(grown), "nodes")
        self.staging.drop(before, new, grown)

    def handles(self) -> DataFrame:
        """(handle, node, ext) of every node."""
        fat = self.nodes.withColumn("f", two_fattest("top", "ext"))
        return fat.select(_prefix("edge", "f - top").alias("handle"), F.col("sig").alias("node"), "ext")

    def _locate(self, batch: DataFrame, deepest: int) -> DataFrame:
        """Adds ``a``: the depth of the deepest node whose whole prefix the class has."""
        handles = self.staging.keep(self.handles(), "handles")
        state = batch.withColumns({"a": F.lit(0), "b": F.col("depth")})
        done = []
        for _ in range(deepest.bit_length()):
            probed = state.where("a < b").withColumn("f", two_fattest("a", "b")).withColumn("handle", _prefix("sigs", "f"))
            met = probed.join(handles, "handle", "left")
            below = (F.col("ext") <= F.col("depth")) & (_prefix("sigs", "ext") == F.col("node"))
            below = F.coalesce(below, F.lit(False))
            state = self.staging.keep(met.select(
                "depth", "sigs", "chars", F.when(below, F.col("ext")).otherwise(F.col("a")).alias("a"),
                F.when(below, F.col("b")).otherwise(F.col("f") - 1).alias("b"),
            ), "probes")
            done.append(state.where("a >= b"))
            if state.where("a < b").isEmpty():
                break
        return reduce(DataFrame.unionAll, done).drop("b")

    def _with_sums(self) -> DataFrame:
        """(sig, members, least, leaves, spent, edges, children) of every node, over its subtree.

        ``spent`` sums the members' text lengths from the root, ``edges`` the
        text lengths of the subtree's nodes, each once.
        """
        spark = self.nodes.sparkSession
        root = spark.range(1).select(
            F.lit(ROOT).alias("sig"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("all_chars"),
            F.lit(0).cast("long").alias("own_chars"),
        )
        chars = F.element_at("chars", -1)
        nodes = root.unionAll(self.nodes.select("sig", F.col("top_sig").alias("up"), chars, chars - F.col("top_chars")))
        children = self.nodes.groupBy(F.col("top_sig").alias("sig")).agg(F.count("*").alias("children"))
        own = self.classes.select("sig", "own", "least")
        start = nodes.join(own, "sig", "left").join(children, "sig", "left").select(
            "sig", "up", F.coalesce("own", F.lit(0)).alias("members"), "least",
            F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
            (F.coalesce("own", F.lit(0)) * F.col("all_chars")).alias("spent"), F.col("own_chars").alias("edges"),
            F.coalesce("children", F.lit(0)).alias("children"),
        )
        state = self.staging.keep(start, "sums")
        sums = ["members", "leaves", "spent", "edges"]
        while not state.where("up IS NOT NULL").isEmpty():
            gained = state.where("up IS NOT NULL").groupBy(F.col("up").alias("sig")).agg(
                *[F.sum(c).alias(f"_{c}") for c in sums], F.min("least").alias("_least")
            )
            # nothing is above the root, so what points at it looks its own row up and ignores it: no hot key
            points = F.col("up") != F.lit(ROOT)
            target = F.when(points, F.col("up")).otherwise(F.col("sig")).alias("_to")
            higher = state.where("up IS NOT NULL").select(F.col("sig").alias("_to"), F.col("up").alias("_up"))
            moved = state.select("*", target, points.alias("_points")).join(higher, "_to", "left")
            moved = moved.withColumn("_next", F.when(F.col("_points"), F.col("_up")))
            after = moved.join(gained, "sig", "left").select(
                "sig", F.col("_next").alias("up"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums],
                F.least("least", "_least").alias("least"), "children",
            ).select(state.columns)
            before, state = state, self.staging.keep(after, "sums")
            self.staging.drop(before)
        return state

    def ends(self) -> DataFrame:
        """(sig, ends): SHA-256 of each class's members, comma-joined in order."""
        rows = self.sequences.select("sig", "conv_id")
        n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        pieces = rows.repartitionByRange(n, "sig", "conv_id").sortWithinPartitions("sig", "conv_id")
        pieces = pieces.mapInArrow(_chunks, "sig binary, begin long, ids binary")
        return pieces.repartition("sig").sortWithinPartitions("sig", "begin").select("sig", "ids").mapInArrow(
            _digests, "sig binary, ends string"
        )

    def rows(self) -> DataFrame:
        """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every prefix."""
        sums = self._with_sums()
        ends = self.staging.keep(self.ends(), "ends")
        saved = F.col("spent") - F.coalesce("top_chars", F.lit(0)) * F.col("members") - F.col("edges")
        whole = sums.drop("up").join(self.nodes, "sig", "left").join(ends, "sig", "left").withColumn("whole", saved)
        whole = self.staging.keep(whole, "whole")
        least = whole.where(F.col("sig") == F.lit(ROOT)).select("least").scalar()
        # the root's children know its smallest member already
        parents = whole.where("ext IS NOT NULL").select(F.col("sig").alias("_to"), F.col("least").alias("_parent"))
        below = whole.where("ext IS NOT NULL").withColumn(
            "_to", F.when(F.col("top_sig") != F.lit(ROOT), F.col("top_sig")).otherwise(F.col("sig"))
        ).join(parents, "_to")
        above = F.when(F.col("top_sig") == F.lit(ROOT), least).otherwise(F.col("_parent"))
        # saved below this node: all of the subtree but the edge's own part
        all_chars, more = F.element_at("chars", -1), F.col("members") - 1
        strictly = F.col("whole") - more * (all_chars - F.col("top_chars"))
        each = below.select("*", above.alias("_above"), strictly.alias("_strictly"), F.posexplode("chars").alias("_k", "_sum"))
        last, top = F.col("_k") == F.col("ext") - F.col("top") - 1, F.col("_k") == 0
        before = F.when(top, F.col("top_chars")).otherwise(F.get("chars", F.col("_k") - 1))
        expanded = each.select(
            F.col("least").alias("conv_id"), (F.col("top") + 1 + F.col("_k")).cast("long").alias("depth"),
            F.when(top, F.col("_above")).otherwise(F.col("least")).alias("parent_conv_id"), F.col("members").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("_strictly") + more * (all_chars - before)).alias("saved_tokens"),
            F.when(last, F.coalesce("ends", F.lit(_NO_MEMBER))).otherwise(F.lit(_NO_MEMBER)).alias("ends_sha256"),
        )
        root = whole.where((F.col("sig") == F.lit(ROOT)) & (F.col("members") > 0)).select(
            F.col("least").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            F.col("members").alias("n_convs"), F.col("children").cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("whole").alias("saved_tokens"), F.coalesce("ends", F.lit(_NO_MEMBER)).alias("ends_sha256"),
        )
        return expanded.unionAll(root)
