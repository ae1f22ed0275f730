"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Index: a vector is normalised, rotated by a fixed random rotation, and kept as
the signs of its coordinates (packed bits) with one correction scalar, the
inner product of the rotated vector with its own code.  It is kept so under
``ROTATIONS`` independent rotations.  Search: the rotated query is rounded to
``QUERY_BITS`` bits per coordinate; its inner product with a code is a sum of
popcounts of the code with the query's bit planes.  Divided by the correction
scalar it estimates the cosine, and the scalar also gives the estimate's
standard error (Gao and Long, 2024).  The estimates under the rotations are
averaged, which cuts the error by the square root of their number; bounds are
``EPSILON`` standard errors wide, which one true neighbour in 300,000 exceeds.

Every vector is indexed, in blocks.  A block of queries meets each block of
codes once; that is a stated query set against all rows.  In it, the
``FIRST`` best estimates are scored exactly, and then every vector whose upper
bound reaches the k-th best of those scores.  Exact cosines are in double
precision, component after component.

Blocks of queries and of codes are files of the shared folder.  Neither is
copied for the blocks of the other: a task is told the numbers of a block of
queries and of up to ``BLOCKS_AT_ONCE`` blocks of codes, reads them one after
the other, and returns the k best of each query.

Equal vectors are one index entry with their k + 1 smallest ids: more cannot
be among the k nearest, as ties go to smaller ids.

Nulls and edges: vectors that are null, empty, zero or hold null or not finite
components, and rows with a null id, take no part; vectors are compared with
those of the same length only; a repeated row counts once; a query with fewer
candidates than k gets them all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import Staging
from ..plans.blocks import read_group, write_groups

EPSILON = 4.5
ROTATIONS = 8
QUERY_BITS = 6
FIRST = 32
CODE_ROWS = 8192
QUERY_ROWS = 512
QUERIES_AT_ONCE = 64
BLOCKS_AT_ONCE = 64
TASKS = 10_000

DIM = "int(octet_length(key) div 8)"


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _squares(x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for i in range(x.shape[1]):
        total += x[:, i] * x[:, i]
    return total


class Cosines:
    """Exact cosines of queries and vectors; sums run from the first component on."""

    def __init__(self, queries: np.ndarray, vectors: np.ndarray):
        self.q, self.v = np.ascontiguousarray(queries.T), np.ascontiguousarray(vectors.T)
        self.qq, self.vv = _squares(queries), _squares(vectors)

    def __call__(self, qi: np.ndarray, vi: np.ndarray) -> np.ndarray:
        out = np.empty(len(qi))
        for low in range(0, len(qi), 1 << 14):
            a, b = qi[low : low + (1 << 14)], vi[low : low + (1 << 14)]
            dot = np.zeros(len(a))
            for x, y in zip(self.q, self.v):
                dot += x[a] * y[b]
            out[low : low + (1 << 14)] = dot / np.sqrt(self.qq[a] * self.vv[b])
        return np.clip(out, -1.0, 1.0)


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    big = F.lit(float("inf"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big)) & F.exists("v", lambda x: x != 0.0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
    ).where(fine)


def _matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<f8").reshape(len(cells), -1)


def _as_keys(keep: int) -> Callable:
    """(key, ids): the bytes of each distinct vector of a batch with its smallest ids."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v")):
                key = (v.values.to_numpy(zero_copy_only=False) + 0.0).astype("<f8").tobytes()
                held.setdefault(key, []).append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array([sorted(set(x))[:keep] for x in held.values()], pa.list_(pa.int64()))],
                names=["key", "ids"],
            )

    return make


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, block, key, ids) with code and correction; rows come by dim."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            some = batch.take(pa.array(np.flatnonzero(dims == dim)))
            x = _matrix(some.column("key").to_pylist())
            x = x / np.abs(x).max(axis=1, keepdims=True)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            packed, own = [], []
            for seed in range(ROTATIONS):
                turned = unit @ rotation(int(dim), seed)
                packed.append(np.packbits(turned > 0, axis=1))
                own.append(np.abs(turned).sum(axis=1) / np.sqrt(dim))
            codes = np.concatenate(packed, axis=1)
            yield pa.RecordBatch.from_arrays([
                *some.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(list(np.stack(own, axis=1)), pa.list_(pa.float64())),
            ], names=[*some.schema.names, "code", "correction"])


def build_index(vectors: DataFrame, k: int, id_col: str, vector_col: str, staging: Staging, folder: str) -> dict[tuple[int, ...], str]:
    """Files of (key, ids, code, correction) by (dim, block): an entry per distinct vector, about CODE_ROWS a block."""
    pairs = _usable(vectors, id_col, vector_col).mapInArrow(_as_keys(k + 1), "key binary, ids array<long>")
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    stored = staging.keep(pairs.groupBy("key").agg(smallest.alias("ids")), "vectors")
    distinct = stored.withColumn("dim", F.expr(DIM))
    n = {r["dim"]: r["n"] for r in distinct.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # a row per length
    many = F.create_map(*[F.lit(int(x)) for d, c in n.items() for x in (d, -(-c // CODE_ROWS))])[F.col("dim")] if n else F.lit(1)
    dealt = distinct.select("dim", F.pmod(F.xxhash64("key"), many).alias("block"), "key", "ids")
    files = write_groups(dealt, ["dim", "block"], folder, _encode)
    staging.drop(stored)
    return files


def _words(packed: np.ndarray) -> np.ndarray:
    """Packed bits as 64-bit words, filled up with zeros."""
    width = -(-packed.shape[-1] // 8) * 8
    out = np.zeros((*packed.shape[:-1], width), np.uint8)
    out[..., : packed.shape[-1]] = packed
    return out.view("<u8")


def _one_estimate(unit: np.ndarray, codes: np.ndarray, correction: np.ndarray, seed: int):
    """(estimated cosines, variances) of the codes of one rotation."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, seed)
    low = turned.min(axis=1, keepdims=True)
    step = np.maximum((turned.max(axis=1, keepdims=True) - low) / ((1 << QUERY_BITS) - 1), 1e-300)
    level = np.rint((turned - low) / step).astype(np.uint8)
    words = np.ascontiguousarray(_words(codes).T)
    ones = np.bitwise_count(words).sum(axis=0, dtype=np.int64)
    total = np.zeros((len(unit), len(codes)), np.int32)
    for b in range(QUERY_BITS):
        plane = _words(np.packbits((level >> b) & 1, axis=1))
        for w, code in enumerate(words):
            count = np.bitwise_count(plane[:, w, None] & code[None, :])
            total += np.left_shift(count, b, dtype=np.int32)
    # sum over coordinates of sign * (low + step * level), signs from the bits
    level_sum = level.sum(axis=1, dtype=np.int64)[:, None]
    dot = (step * (2 * total - level_sum) + low * (2 * ones - dim)[None, :]) / np.sqrt(dim)
    # errors of the code, and of rounding the query, which are independent of each other
    spread = np.maximum((1 - correction**2) / correction**2 / max(dim - 1, 1), 0)
    return dot / correction[None, :], spread[None, :] + (step / correction[None, :]) ** 2 / 12


def estimates(queries: np.ndarray, codes: np.ndarray, correction: np.ndarray, epsilon: float):
    """(estimated cosines, error bounds), a row per query, from packed codes and popcounts.

    A code holds the bits of all rotations; ``correction`` has a column for each.
    """
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    turns = correction.shape[1]
    guess, variance = 0.0, 0.0
    for seed, own in enumerate(np.split(codes, turns, axis=1)):
        one, error = _one_estimate(unit, own, correction[:, seed], seed)
        guess, variance = guess + one, variance + error
    return guess / turns, epsilon * np.sqrt(variance) / turns


FOUND = "query_id long, vec_id long, score double"
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _top(query_ids, vec_ids, scores, k: int):
    """The k best of each query, ties to smaller ids."""
    order = np.lexsort((vec_ids, -scores, query_ids))
    q = query_ids[order]
    heads = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1]) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(heads, np.diff(np.concatenate([heads, [len(q)]])))
    best = order[rank < k]
    return query_ids[best], vec_ids[best], scores[best]


def _reached(cosines: Cosines, guess: np.ndarray, first_query: int, need: int) -> np.ndarray:
    """Each query's exact ``need``-th best cosine among the best estimates: others must be able to beat it."""
    n = guess.shape[1]
    first = min(n, max(need, FIRST))
    top = np.argpartition(guess, n - first, axis=1)[:, n - first :]
    query = np.repeat(np.arange(first_query, first_query + len(guess)), first)
    scores = cosines(query, top.ravel()).reshape(len(guess), first)
    need = min(need, first)
    return np.partition(scores, first - need, axis=1)[:, first - need]


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and elements of a column of lists."""
    return column.value_lengths().to_numpy(), column.flatten().to_numpy()


def _block_best(query_ids: np.ndarray, queries: np.ndarray, block: pa.RecordBatch, k: int, epsilon: float):
    """(query_ids, vec_ids, scores): the k best of each query in a block of codes."""
    vectors = _matrix(block.column("key").to_pylist())
    codes = np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8).reshape(len(vectors), -1)
    correction = _ids(block.column("correction"))[1].reshape(len(vectors), -1)
    sizes, flat = _ids(block.column("ids"))
    starts, cosines = np.cumsum(sizes) - sizes, Cosines(queries, vectors)
    for low in range(0, len(queries), QUERIES_AT_ONCE):
        guess, bound = estimates(queries[low : low + QUERIES_AT_ONCE], codes, correction, epsilon)
        least = _reached(cosines, guess, low, k + 1)
        qi, vi = np.nonzero(guess + bound >= least[:, None])
        qi += low
        score = cosines(qi, vi)
        # the ids of each vector that was scored
        many = sizes[vi]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        vec = flat[np.repeat(starts[vi], many) + within]
        q, score = np.repeat(query_ids[qi], many), np.repeat(score, many)
        other = q != vec
        yield _top(q[other], vec[other], score[other], k)


def _single(query_ids, vec_ids, scores):
    """A repeated id with different vectors counts by its nearest one."""
    order = np.lexsort((-scores, vec_ids, query_ids))
    q, v = query_ids[order], vec_ids[order]
    first = order[np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])])[: len(q)]]
    return query_ids[first], vec_ids[first], scores[first]


class _Plan:
    """Which block of queries meets which blocks of codes in a task, by the task's number."""

    def __init__(self, queries: dict[tuple[int, ...], str], codes: dict[tuple[int, ...], str], tasks: int):
        self.files = []  # of each length of vectors those of the queries, and ranges of those of the codes
        for dim in sorted({d for d, _ in queries} & {d for d, _ in codes}):
            asked, blocks = ([files[x] for x in sorted(files) if x[0] == dim] for files in (queries, codes))
            size = max(1, min(BLOCKS_AT_ONCE, len(blocks) * len(asked) // tasks))
            self.files.append((asked, [blocks[i : i + size] for i in range(0, len(blocks), size)]))
        self.ends = np.cumsum([len(asked) * len(ranges) for asked, ranges in self.files])
        self.total = int(self.ends[-1]) if len(self.ends) else 0

    def __getitem__(self, task: int) -> tuple[str, list[str]]:
        at = int(np.searchsorted(self.ends, task, side="right"))
        asked, ranges = self.files[at]
        group, span = divmod(task - (int(self.ends[at - 1]) if at else 0), len(ranges))
        return asked[group], ranges[span]


def _search(plan: _Plan, folder: str, k: int, epsilon: float) -> Callable:
    """Rows hold the numbers of tasks."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column("id").to_pylist():
                asked, blocks = plan[task]
                asked = read_group(folder, asked)
                query_ids, queries = asked.column("query_id").to_numpy(), _matrix(asked.column("key").to_pylist())
                best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
                for block in blocks:
                    found = [best, *_block_best(query_ids, queries, read_group(folder, block), k, epsilon)]
                    best = _top(*_single(*map(np.concatenate, zip(*found))), k)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(best, _FOUND.types)], schema=_FOUND)

    return search


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    epsilon: float = EPSILON,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest vectors of each query row."""
    spark = vectors.sparkSession
    staging = Staging(spark, "nearest")
    folder = staging.folder("blocks")
    codes = build_index(vectors, k, id_col, vector_col, staging, folder)
    asked = _usable(vectors.where(is_query), id_col, vector_col).mapInArrow(_as_keys(1 << 30), "key binary, ids array<long>")
    asked = staging.keep(asked.select(F.explode("ids").alias("query_id"), "key").distinct(), "queries")
    groups = max(1, -(-asked.count() // QUERY_ROWS))
    dealt = asked.select(F.expr(DIM).alias("dim"), F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group"), "query_id", "key")
    queries = write_groups(dealt, ["dim", "group"], folder)  # about QUERY_ROWS entries
    staging.drop(asked)
    plan = _Plan(queries, codes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = spark.range(0, plan.total, 1, max(1, min(plan.total, TASKS)))
    found = tasks.mapInArrow(_search(plan, folder, k, epsilon), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # a repeated id with different vectors counts by its nearest one
    single = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return single.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
