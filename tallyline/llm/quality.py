"""Quality filter by importance resampling.

Two generative models over hashed n-grams of tokens (one and two; words and
runs of punctuation, lower-cased A-Z; ``BUCKETS`` buckets) are counted: one
over the target texts, which are labelled documents of good quality, one over
all documents.  A document's log
weight is the sum over its n-grams of log p_target - log p_raw.  Documents are
drawn without replacement by Gumbel top-k: the k largest of log weight plus
Gumbel noise, seeded by the document's id (Xie et al., 2023).

k counts the documents, over the whole table, whose log weight is no worse
than the cut that tells good from poor labelled documents best.  At most
``FIT_ROWS`` labelled rows, the smallest by a hash of their ids, are used:
good ones of one half are the target texts, the other half, unseen by the
target model, sets the cut.  Raw counts, weights, k and the draw cover all
documents.  The k-th key is found exactly by counting keys in equal bins of the
range that holds it, again and again; rows equal to it are all taken.

With ``drop_toxic`` a labelled document is good only if it is not toxic as
well, and a toxic target model joins the weight.  Rare insults drown in a sum
over all n-grams, so this model keeps the words alone that stand out: words
(``TOXIC_BUCKETS`` buckets) in more toxic than good documents of the first
half, with a likelihood ratio G2 over ``TOXIC_G2``.  A document's toxic score
is the sum of their log odds, each word once; the cut comes from the other
half, and past it the target's density is 0 and the log weight minus infinity.

Nulls and edges: a null or empty text has log weight 0; labels that are null,
or without a document, count as none; of several labels of an id the worst
counts; without labels of both kinds, every document is kept, and without toxic
and good labels in both halves none is dropped as toxic.  Rows with equal
ids share their noise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import Staging
from . import words as W

BUCKETS = 1 << 14
FIT_ROWS = 20_000
PRIOR = 0.5
TOXIC_BUCKETS = 1 << 20
TOXIC_G2 = 10.0


def _buckets(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, and the row it is in; a row's n-grams are together."""
    starts, pairs = W.windows(block.hashes, block.first, 2, seed=7)
    row = block.row_of_word
    hashes = np.concatenate([W.mix(block.hashes), pairs])
    return (hashes >> np.uint64(32)).astype(np.int64) % BUCKETS, np.concatenate([row, row[starts]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        label = batch.column("_quality").fill_null(-1).to_numpy(zero_copy_only=False)
        for block in W.blocks(batch.column("text"), W.LOWER, classes=W.MARKS_APART):
            bucket, row = _buckets(block)
            raw += np.bincount(bucket, minlength=BUCKETS)
            use = label[block.rows.start : block.rows.stop][row] == 1
            good += np.bincount(bucket[use], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int64()), pa.array(raw[seen], pa.int64()), pa.array(good[seen], pa.int64())],
        names=["bucket", "raw", "target"],
    )


def _word_rows(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the words of a block, each bucket once a row."""
    bucket = (W.mix(block.hashes) >> np.uint64(32)).astype(np.int64) % TOXIC_BUCKETS
    both = np.unique(block.row_of_word.astype(np.int64) * TOXIC_BUCKETS + bucket)
    return both // TOXIC_BUCKETS, both % TOXIC_BUCKETS


def _count_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and clean documents by word bucket; bucket -1 counts all of them."""
    found = np.zeros((2, TOXIC_BUCKETS), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        toxic = batch.column("_toxic").to_numpy(zero_copy_only=False)
        rows += np.bincount(toxic, minlength=2)
        for block in W.blocks(batch.column("text"), W.LOWER, classes=W.MARKS_APART):
            row, bucket = _word_rows(block)
            of = toxic[block.rows.start : block.rows.stop][row]
            for k in (0, 1):
                found[k] += np.bincount(bucket[of == k], minlength=TOXIC_BUCKETS)
    seen = np.flatnonzero(found.sum(axis=0))
    cells = [np.concatenate([[-1], seen]), *(np.concatenate([[rows[k]], found[k][seen]]) for k in (1, 0))]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], names=["bucket", "toxic", "clean"])


def toxic_words(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, log odds) of the words that stand out in toxic documents, by bucket.

    ``counts`` has (bucket, toxic, clean), with all documents in bucket -1.
    """
    everything = counts.where("bucket = -1").first()
    if everything is None or not everything["toxic"] or not everything["clean"]:
        return np.zeros(0, np.int64), np.zeros(0)
    t, c = float(everything["toxic"]), float(everything["clean"])

    def term(seen: Column, share: float, of: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * (t + c) / (of * share))).otherwise(0.0)

    a, b = F.col("toxic"), F.col("clean")
    n = a + b
    g2 = 2 * (term(a, t, n) + term(b, c, n) + term(t - a, t, t + c - n) + term(c - b, c, t + c - n))
    rows = counts.where((F.col("bucket") >= 0) & (a * c > b * t) & (g2 > TOXIC_G2)).orderBy("bucket").collect()
    bucket, toxic, clean = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    return bucket, np.log((toxic + PRIOR) / (t + 2 * PRIOR)) - np.log((clean + PRIOR) / (c + 2 * PRIOR))


def _toxic_scores(block: W.Block, words: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    buckets, odds = words
    if not len(buckets):
        return np.zeros(len(block.rows))
    row, bucket = _word_rows(block)
    at = np.minimum(np.searchsorted(buckets, bucket), len(buckets) - 1)
    hit = buckets[at] == bucket
    return np.bincount(row[hit], weights=odds[at[hit]], minlength=len(block.rows))


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw per bucket, both with an additive prior."""
    p = (target + PRIOR) / (target.sum() + PRIOR * BUCKETS)
    q = (raw + PRIOR) / (raw.sum() + PRIOR * BUCKETS)
    return np.log(p) - np.log(q)


def _weights(block: W.Block, ratio: np.ndarray) -> np.ndarray:
    bucket, row = _buckets(block)
    return np.bincount(row, weights=ratio[bucket], minlength=len(block.rows))


def _scorer(ratio: np.ndarray, words: tuple[np.ndarray, np.ndarray]) -> Callable:
    """Adds ``_ratio`` and ``_toxic`` to every row; the rows' own columns pass through."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (_weights(b, ratio), _toxic_scores(b, words))
                for b in W.blocks(batch.column("_text"), W.LOWER, classes=W.MARKS_APART)
            ]
            scores = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0)] * 2
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *[pa.array(x, pa.float64()) for x in scores]],
                names=[*names, "_ratio", "_toxic"],
            )

    return score


def gumbel(doc_id: Column, seed: int) -> Column:
    """Gumbel noise from a hash of seed and id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut with the fewest labelled rows on the wrong side; the lowest of equals."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order].astype(np.int64)
    lost = np.concatenate([[0], np.cumsum(g)])
    passed = (1 - g).sum() - np.concatenate([[0], np.cumsum(1 - g)])
    first = np.concatenate([[True], w[1:] != w[:-1], [True]])  # equal weights stay on one side
    wrong = np.where(first, lost + passed, len(w) + 1)
    at = int(np.argmin(wrong))
    if at == 0:
        return -np.inf
    return float((w[at - 1] + w[at]) / 2) if at < len(w) else float(w[-1]) + 1.0


def kth_largest(keys: DataFrame, k: int, bins: int = 4096) -> float:
    """The k-th largest value of the double column ``key``.

    Each pass counts the rows in equal bins of the range that holds the value
    and goes on with one bin; ``bins`` rows reach the driver.
    """
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low < high:
        place = F.least(F.floor((F.col("key") - low) / F.lit((high - low) / bins)), F.lit(bins - 1))
        inside = keys.where(F.col("key").between(low, high)).groupBy(place.alias("bin"))
        for _, n, least, most in sorted(
            inside.agg(F.count("*"), F.min("key"), F.max("key")).collect(), reverse=True
        ):
            if k <= n:
                break
            k -= n
        low, high = least, most
    return low


def fitting_labels(labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, quality, toxic) of at most ``fit_rows`` labelled ids; the worst label of an id in both."""
    worst = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("quality"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    return worst.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def _possible() -> Column:
    return F.col("_weight") > F.lit(-np.inf)


class Resampler:
    """The fitted models, the cut, k and the k-th key of one table of documents."""

    def __init__(
        self, docs: DataFrame, labels: DataFrame, seed: int = 0, fit_rows: int = FIT_ROWS, drop_toxic: bool = False
    ):
        self.seed = seed
        self.staging = Staging(docs.sparkSession, "quality")
        fit = self.staging.keep(fitting_labels(labels, fit_rows), "fit").withColumnsRenamed(
            {"doc_id": "_id", "quality": "_quality", "toxic": "_toxic"}
        )
        if drop_toxic:
            fit = fit.withColumn("_quality", F.col("_quality") * (1 - F.col("_toxic")))
        else:
            fit = fit.withColumn("_toxic", F.lit(0))
        first_half = F.xxhash64(F.lit(1), F.col("_id")) % 2 == 0
        target = F.broadcast(fit.where(first_half))  # at most fit_rows rows of three numbers
        judges = F.broadcast(fit.where(~first_half).withColumnRenamed("_toxic", "_is_toxic"))
        texts = docs.select(F.col("doc_id").cast("long"), "text")
        labelled = texts.join(target, texts["doc_id"] == target["_id"], "left").select("text", "_quality")
        counts = labelled.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket").agg(
            F.sum("raw").alias("raw"), F.sum("target").alias("target")
        )
        raw, good_counts = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for bucket, n, m in counts.collect():  # at most BUCKETS rows
            raw[bucket], good_counts[bucket] = n, m
        self.ratio = log_ratio(raw, good_counts)
        self.words = self._toxic_model(texts, target) if drop_toxic else (np.zeros(0, np.int64), np.zeros(0))
        scored = self.staging.keep(self._scored(docs.select("doc_id", "text")).select("doc_id", "_ratio", "_toxic"), "scores")
        sample = scored.join(judges, scored["doc_id"] == judges["_id"]).select(
            "_ratio", "_toxic", "_quality", "_is_toxic"
        ).collect()
        weights, toxic, good, is_toxic = (np.array(c) for c in zip(*sample)) if sample else [np.zeros(0)] * 4
        clean = is_toxic == 0
        self.cut = best_cut(weights[clean], good[clean]) if 0 < good[clean].sum() < clean.sum() else -np.inf
        told = (good == 1) | ~clean
        self.toxic_cut = best_cut(-toxic[told], good[told]) if 0 < good[told].sum() < told.sum() else -np.inf
        scored = self._keyed(scored)
        self.k = scored.where((F.col("_weight") >= F.lit(float(self.cut))) & _possible()).count()
        keys = scored.where(_possible()).select(F.col("_key").alias("key"))
        self.least = kth_largest(keys, self.k) if self.k else np.inf
        self.scored = scored

    def _toxic_model(self, texts: DataFrame, target: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        told = texts.join(target, texts["doc_id"] == target["_id"]).where("_quality = 1 OR _toxic = 1")
        counts = told.select("text", "_toxic").mapInArrow(_count_toxic, "bucket long, toxic long, clean long")
        return toxic_words(self.staging.keep(
            counts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic"
        ))

    def _scored(self, docs: DataFrame) -> DataFrame:
        """Rows with ``_ratio`` and ``_toxic``; ``_text`` is the text without nulls."""
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
        rows = docs.select("*", F.col("text").alias("_text"))
        return rows.mapInArrow(_scorer(self.ratio, self.words), ", ".join([*fields, "_ratio double", "_toxic double"]))

    def _keyed(self, scored: DataFrame) -> DataFrame:
        """Scored rows with ``_weight`` and ``_key``."""
        clean = -F.col("_toxic") >= F.lit(float(self.toxic_cut))
        weighted = scored.withColumn("_weight", F.when(clean, F.col("_ratio")).otherwise(F.lit(-np.inf)))
        return weighted.withColumn("_key", F.col("_weight") + gumbel(F.col("doc_id"), self.seed))

    def decisions(self) -> DataFrame:
        """(doc_id, log_weight, key, kept), a row per document."""
        return self.scored.select(
            "doc_id", F.col("_weight").alias("log_weight"), F.col("_key").alias("key"),
            (F.col("_key") >= F.lit(float(self.least))).alias("kept"),
        )

    def drawn(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that were drawn, all columns kept; nothing is shuffled."""
        renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
        at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
        rows = renamed.withColumns({"doc_id": F.col(at["doc_id"]), "text": F.col(at["text"])})
        kept = self._keyed(self._scored(rows)).where(F.col("_key") >= F.lit(float(self.least)))
        return kept.select(*[F.col(at[c]).alias(c) for c in docs.columns])


def resample(
    docs: DataFrame, labels: DataFrame, seed: int = 0, fit_rows: int = FIT_ROWS, drop_toxic: bool = False
) -> DataFrame:
    return Resampler(docs, labels, seed, fit_rows, drop_toxic).drawn(docs)
