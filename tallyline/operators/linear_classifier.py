"""Training, applying and ensembling of linear text classifiers.

Documents are (doc_id, label, features array) with label 'spam' or 'ham';
models are (model_id, feature, weight).  A feature counts once per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import sigmoid, sign_vote
from ..plans.blocks import Blocks, write_blocks
from ..plans.durable import checkpointed, checkpointed_by, release
from ..plans.prefix import first_of_each, with_positions
from ..plans.rows import explode_counts, explode_once
from ..plans.skew import hot_keys, salt_many, salt_one
from ..plans.staging import Staging

DELTA = 0.002
MAX_DOCS = 20_000  # labelled documents in one sequence of updates
BLOCK_DOCS = 256


def _is_spam() -> Column:
    return (F.col("label") == "spam").cast("double")


# --- sequential training -------------------------------------------------


def _fold(batches: Iterator[pd.DataFrame], delta: float) -> Iterator[pd.DataFrame]:
    """Weights of each (model, shard) run of rows, updated document by document."""
    run, index, weights = None, {}, np.zeros(1024)

    def finished() -> pd.DataFrame:
        model, shard, shards = run
        return pd.DataFrame({
            "model_id": [model] * len(index), "shard": shard, "shards": shards,
            "feature": list(index), "weight": weights[:len(index)],
        })

    for batch in batches:
        for model, shard, shards, y, features in batch.itertuples(index=False, name=None):
            if run != (model, shard, shards):
                if run is not None and index:
                    yield finished()
                run, index, weights = (model, shard, shards), {}, np.zeros(1024)
            if features is None or not len(features):
                continue
            seen = np.array([index.setdefault(f, len(index)) for f in features])
            while len(index) > len(weights):
                weights = np.concatenate([weights, np.zeros(len(weights))])
            p = 1.0 / (1.0 + np.exp(-weights[seen].sum()))
            np.add.at(weights, seen, (y - p) * delta)
    if run is not None and index:
        yield finished()


def _trained(placed: DataFrame, delta: float, order: Sequence[str]) -> DataFrame:
    """(model_id, shard, shards, feature, weight): every shard in its own sequence."""
    ordered = placed.repartition("model_id", "shard").sortWithinPartitions(
        "model_id", "shard", *order, "doc_id"
    )
    rows = ordered.select("model_id", "shard", "shards", _is_spam().alias("y"), "features")
    types = dict(placed.dtypes)
    feature_type = types["features"].removeprefix("array<").removesuffix(">")
    schema = (
        f"model_id {types['model_id']}, shard int, shards int, feature {feature_type}, weight double"
    )
    return rows.mapInPandas(lambda batches: _fold(batches, delta), schema)


def _with_model(docs: DataFrame) -> DataFrame:
    return docs if "model_id" in docs.columns else docs.withColumn("model_id", F.lit("all"))


def train_sgd(
    docs: DataFrame, delta: float = DELTA, order: Sequence[str] = ("doc_id",), max_docs: int = MAX_DOCS,
) -> DataFrame:
    """(model_id, feature, weight): one pass of stochastic gradient descent per model.

    ``docs`` may have a model_id; without one, all train the model 'all'.
    Documents are visited by ``order``; ties go by doc_id.  One model is one
    sequence and so one task, which is why a model is fitted on its first
    ``max_docs`` labelled documents only; they are found by ranks in ranges of
    the order, without a window over a model.  ``train_sgd_sharded`` and
    ``train_batch`` train in parallel, on all documents.
    """
    key = list(dict.fromkeys([*order, "doc_id"]))
    chosen = first_of_each(_with_model(docs), key, max_docs, ["model_id"])
    placed = chosen.withColumns({"shard": F.lit(0), "shards": F.lit(1)})
    return _trained(placed, delta, order).select("model_id", "feature", "weight")


def shard_of(doc_id: Column, shards: int) -> Column:
    """A document's shard, from the first 15 hex digits of the md5 of its id."""
    digits = F.substring(F.md5(doc_id.cast("string")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def train_sgd_sharded(
    docs: DataFrame, shards: int | None = None, delta: float = DELTA, order: Sequence[str] = ("doc_id",),
    shard_docs: int = MAX_DOCS,
) -> DataFrame:
    """(model_id, feature, weight): several sequences per model, their weights averaged.

    There are enough ``shards``, unless given, for about ``shard_docs`` of all
    documents in each, so a task's share stays the same as the input grows.
    Parameter mixing: a feature that a shard has not seen counts as 0 there.
    """
    docs = _with_model(docs)
    shards = shards or max(1, -(-docs.count() // shard_docs))
    placed = docs.withColumns({"shard": shard_of(F.col("doc_id"), shards), "shards": F.lit(shards)})
    mean = (F.sum("weight") / F.max("shards")).alias("weight")
    return _trained(placed, delta, order).groupBy("model_id", "feature").agg(mean)


# --- repeated runs -------------------------------------------------------


def shuffled_order(docs: DataFrame, seeds: Sequence[int], id_col: str = "doc_id", carried: Sequence[str] = ()) -> DataFrame:
    """(seed, doc_id, carried..., position): a random order of the rows for each seed.

    The order is by md5 of document and seed, so a seed always gives the same
    one; positions run from 0 on.  Nothing is sorted in one task.
    """
    each = docs.select(F.col(id_col).alias("doc_id"), *carried, F.explode(F.lit([int(s) for s in seeds])).alias("seed"))
    turn = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("seed").cast("string")))
    return with_positions(each, [turn, "doc_id"], ["seed"]).select("seed", "doc_id", *carried, "position")


def _run(folder: str, files: list[str], words: int, delta: float):
    """Trains on (seed, y, block, place) rows that come in order; features are read from the packed blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(folder, files)
        now, weights, seen = None, None, None

        def finished() -> pa.RecordBatch:
            some = np.flatnonzero(seen)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), now, np.int64)), pa.array(some), pa.array(weights[some])], names=["model_id", "code", "weight"]
            )

        for batch in batches:
            for seed, y, block, place in zip(*(c.to_numpy() for c in batch.columns)):
                if seed != now:
                    if now is not None:
                        yield finished()
                    now, weights, seen = seed, np.zeros(words), np.zeros(words, bool)
                features = blocks.row(block, place)
                if len(features):
                    p = 1.0 / (1.0 + np.exp(-weights[features].sum()))
                    np.add.at(weights, features, (y - p) * delta)
                    seen[features] = True
        if now is not None:
            yield finished()

    return run


def train_runs(docs: DataFrame, seeds: Sequence[int], delta: float = DELTA, max_docs: int = MAX_DOCS) -> DataFrame:
    """(model_id, feature, weight): one model per seed, each trained in its own shuffled order, in one job.

    The runs share one stored copy of at most ``max_docs`` documents (the first
    by md5 of their id), with features as numbers, in packed blocks.  What is
    shuffled for a seed is a number and a label per document; its task reads
    the features where they lie.
    """
    staging = Staging(docs.sparkSession, "runs")
    ranked = docs.select("doc_id", _is_spam().alias("y"), "features").withColumn("_md5", F.md5(F.col("doc_id").cast("string")))
    sample = with_positions(first_of_each(ranked.withColumn("_all", F.lit(0)), ["_md5", "doc_id"], max_docs, ["_all"]), ["_md5", "doc_id"])
    sample = staging.keep(sample.select("position", "doc_id", "y", F.coalesce("features", F.array().cast(dict(docs.dtypes)["features"])).alias("features")))
    distinct = explode_once(sample, "features", "feature").distinct()
    words = staging.keep(with_positions(distinct, ["feature"], name="code"), "words")
    coded = explode_counts(sample, "features", "feature", "k", "position").join(words, "feature")
    rows = sample.select("position").join(
        coded.groupBy("position").agg(F.collect_list(F.struct("code", "k")).alias("ck")), "position", "left"  # a document's words
    ).select("position", F.flatten(F.transform("ck", lambda x: F.array_repeat(x["code"], x["k"].cast("int")))).alias("codes"))
    folder = staging.folder("blocks")
    files = write_blocks(rows, "position", "codes", folder, BLOCK_DOCS)
    turns = shuffled_order(sample.withColumnRenamed("position", "nth"), seeds, carried=["nth", "y"])
    turns = turns.repartition("seed").sortWithinPartitions("seed", "position")
    placed = turns.select("seed", "y", F.expr(f"nth div {BLOCK_DOCS}").alias("block"), (F.col("nth") % BLOCK_DOCS).alias("place"))
    weights = placed.mapInArrow(_run(folder, files, words.count(), delta), "model_id long, code long, weight double")
    return weights.join(words, "code").select(F.col("model_id").cast("int").alias("model_id"), "feature", "weight")


# --- batch training ------------------------------------------------------


def _gradient(docs: DataFrame, delta: float, *extra: Column) -> DataFrame:
    """(model_id, feature, weight): delta * residual summed over occurrences."""
    seen = explode_once(docs, "features", "feature", "model_id", "residual")
    step = F.sum(F.lit(delta) * F.col("residual")).alias("weight")
    return seen.groupBy("model_id", "feature").agg(step, *extra)


def train_batch(docs: DataFrame, delta: float = DELTA, epochs: int = 1) -> DataFrame:
    """(model_id, feature, weight) by full-batch gradient steps per model.

    Each epoch adds delta * sum of (y - p) over the occurrences of a feature,
    with p from the weights of the previous epoch.  The first epoch needs no
    scores: every p is one half.  Later epochs read two stored layouts, the
    documents to update and their features (a hot one salted) to score, so
    that only weights, partial scores and partial gradients are shuffled.
    """
    labelled = docs.select("model_id", "doc_id", _is_spam().alias("y"), "features")
    half = (F.col("y") - F.lit(0.5)).alias("residual")
    if epochs <= 1:
        return _gradient(labelled.select("model_id", "features", half), delta)

    doc_key, key = ["model_id", "doc_id"], ["model_id", "feature"]
    by_doc = checkpointed_by(checkpointed(labelled), doc_key)
    first = checkpointed(
        _gradient(by_doc.select("*", half), delta, F.count("*").alias("n"))
    )
    hot = checkpointed(hot_keys(first, key))
    counted = explode_counts(by_doc, "features", "feature", "k", *doc_key)
    by_feature = checkpointed_by(salt_many(counted, hot, key, ["doc_id"]), [*key, "slot"])
    model = first.drop("n")
    for _ in range(epochs - 1):
        scores = (
            by_feature.join(salt_one(model, hot, key), [*key, "slot"])
            .groupBy(*doc_key).agg(F.sum(F.col("k") * F.col("weight")).alias("score"))
        )
        scored = by_doc.join(scores, doc_key).withColumn("residual", F.col("y") - sigmoid("score"))
        steps = model.unionByName(_gradient(scored, delta))
        before, model = model, checkpointed(steps.groupBy(*key).agg(F.sum("weight").alias("weight")))
        release(before)
    return model


# --- applying ------------------------------------------------------------


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, label, feature, k): counted in the row, so that each feature of a
    document travels once; a document without features keeps one row."""
    return explode_counts(docs, "features", "feature", "k", "doc_id", "label", keep_empty=True)


ERROR = 2.0**-40


def _totals() -> list[Column]:
    """The score, and the sum of its terms' sizes."""
    term = F.coalesce(F.col("k") * F.col("weight"), F.lit(0.0))
    return [F.sum(term).alias("score"), F.sum(F.abs(term)).alias("_size")]


def _sign(score: Column, size: Column) -> Column:
    """-1, 0 or 1; 0 if the score is within the float error of its terms' sum,
    so that weights that cancel out give 0 in whatever order tasks add them."""
    return F.when(F.abs(score) <= F.lit(ERROR) * size, F.lit(0)).otherwise(sign_vote(score))


def _label(sign: Column) -> Column:
    return F.when(sign > 0, F.lit("spam")).otherwise(F.lit("ham")).alias("pred")


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, label, score, pred) by one model.

    The score sums the weights of all feature occurrences; unknown features
    and documents without features give 0, and 0 is ham.
    """
    weighted = _occurrences(docs).join(model.select("feature", "weight"), "feature", "left")
    summed = weighted.groupBy("doc_id", "label").agg(*_totals())
    return summed.select("doc_id", "label", "score", _label(_sign(F.col("score"), F.col("_size"))))


def score_models(docs: DataFrame, models: DataFrame) -> DataFrame:
    """(model_id, doc_id, label, score, pred): every document by every model.

    Features travel once for all models; a document without a known feature
    of a model scores 0 there.
    """
    known = (
        _occurrences(docs).join(models, "feature")
        .groupBy("model_id", "doc_id", "label").agg(*_totals())
    )
    names = models.select("model_id").distinct()
    zero = F.lit(0.0)
    each = names.agg(F.collect_list("model_id")).scalar()  # one value per model
    spine = docs.select("doc_id", "label", F.explode(each).alias("model_id")).select(
        "model_id", "doc_id", "label", zero.alias("score"), zero.alias("_size")
    )
    summed = known.unionByName(spine).groupBy("model_id", "doc_id", "label").agg(
        F.sum("score").alias("score"), F.sum("_size").alias("_size")
    )
    return summed.select("model_id", "doc_id", "label", "score", _label(_sign(F.col("score"), F.col("_size"))))


def score_ensemble(docs: DataFrame, models: DataFrame, method: str) -> DataFrame:
    """(doc_id, label, score, pred) by several models, plus mean for 'average'.

    'average' emits the sum of the model scores and decides on their mean;
    'vote' emits the sum of the signs of the model scores.
    """
    if method == "average":
        number = models.select("model_id").distinct().agg(F.count("*")).scalar()
        weighted = _occurrences(docs).join(models.select("feature", "weight"), "feature", "left")
        total = weighted.groupBy("doc_id", "label").agg(*_totals())
        pred = _label(_sign(F.col("score"), F.col("_size")))
        return total.select("doc_id", "label", "score", (F.col("score") / number).alias("mean"), pred)
    if method == "vote":
        per_model = (
            _occurrences(docs).join(models, "feature", "left")
            .groupBy("doc_id", "label", "model_id").agg(*_totals())
        )
        vote = _sign(F.col("score"), F.col("_size"))
        votes = per_model.groupBy("doc_id", "label").agg(F.sum(vote).alias("score"))
        return votes.select("doc_id", "label", "score", _label(F.col("score")))
    raise ValueError("method must be 'average' or 'vote'")
