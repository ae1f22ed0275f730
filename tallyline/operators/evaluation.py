"""Evaluation of predictions (doc_id, label, score, pred).

Scores are first counted per distinct value; ordered statistics then run over
ranges of scores, so no task sorts all documents.  The functions read their
input more than once: pass a stored table, not a pipeline that scores anew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import RATE_EDGES, guarded_rate, logit, rate_bucket, sigmoid
from ..plans.durable import checkpointed
from ..plans.prefix import running_before, with_score_block


def _spam() -> Column:
    return F.col("label") == "spam"


def _per_score(preds: DataFrame, by: Sequence[str], blocks: int | None) -> DataFrame:
    """(by..., block, score, s, h): spam and ham documents per distinct score."""
    counted = preds.groupBy(*by, "score").agg(
        F.count_if(_spam()).alias("s"), F.count_if(~_spam()).alias("h")
    )
    return with_score_block(counted, "score", by, blocks)


def _inversion_rate(inversions: Column, h: Column, s: Column) -> Column:
    """Share of (spam, ham) pairs in the wrong order; none counts as half a pair."""
    pairs = F.nullif(h.cast("double") * s.cast("double"), F.lit(0.0))
    return F.when(inversions == 0, F.lit(0.5)).otherwise(inversions) / pairs


def _inversions(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., hams, spams, inversions) from (by..., block, score, s, h).

    Inside a range of scores, hams are matched with the spams scoring lower;
    between ranges, all hams of one with all spams of the earlier ones.
    """
    by = list(by)
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*by, "block").orderBy("score").rowsBetween(*earlier)
    below = F.coalesce(F.sum("s").over(inside), F.lit(0)).cast("double") + F.col("s") / F.lit(2.0)
    per_block = (
        rows.withColumn("inversions", F.col("h") * below).groupBy(*by, "block")
        .agg(*[F.sum(c).alias(c) for c in ("s", "h", "inversions")])
    )
    across = Window.partitionBy(*by).orderBy("block").rowsBetween(*earlier)
    before = F.coalesce(F.sum("s").over(across), F.lit(0)).cast("double")
    total = per_block.withColumn("inversions", F.col("inversions") + F.col("h") * before)
    return total.groupBy(*by).agg(
        F.sum("h").alias("hams"), F.sum("s").alias("spams"), F.sum("inversions").alias("inversions")
    )


def one_minus_roca(preds: DataFrame, by: Sequence[str] = (), blocks: int | None = None) -> DataFrame:
    """(by..., hams, spams, one_minus_roca): the percentage of (spam, ham) pairs
    where the spam scores below the ham, equal scores counting one half."""
    by = list(by)
    sums = _inversions(_per_score(preds, by, blocks), by)
    rate = _inversion_rate(F.col("inversions"), F.col("hams"), F.col("spams"))
    return sums.select(*by, "hams", "spams", (F.lit(100.0) * rate).alias("one_minus_roca"))


def lam(preds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., hams, spams, fp, fn, lam): logistic average misclassification, percent."""
    wrong = F.col("pred") != F.col("label")
    counts = preds.groupBy(*by).agg(
        F.count_if(~_spam()).alias("hams"), F.count_if(_spam()).alias("spams"),
        F.count_if(~_spam() & wrong).alias("fp"), F.count_if(_spam() & wrong).alias("fn"),
    )
    mean = (logit(guarded_rate("fn", "spams")) + logit(guarded_rate("fp", "hams"))) / F.lit(2.0)
    return counts.withColumn("lam", F.lit(100.0) * sigmoid(mean))


def _points(counted: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., kind, bucket, rate) from (by..., block, score, s, h)."""
    by = list(by)
    rows = running_before(counted, ["s", "h"], "block", "score", by)
    totals = counted.groupBy(*by).agg(F.sum("s").cast("double").alias("_spams"), F.sum("h").cast("double").alias("_hams"))
    if by:
        rows = rows.join(totals, by)
    else:
        rows = rows.withColumns({c: totals.select(c).scalar() for c in ("_spams", "_hams")})
    seen_s, seen_h = F.col("s_before") + F.col("s"), F.col("h_before") + F.col("h")
    rates = rows.select(
        *by, "block",
        (F.greatest(seen_s.cast("double"), F.lit(0.5)) / F.nullif(F.col("_spams"), F.lit(0.0))).alias("fn"),
        (F.greatest(F.col("_hams") - seen_h, F.lit(0.5)) / F.nullif(F.col("_hams"), F.lit(0.0))).alias("fp"),
    )
    # both rates are monotone in a range, so its share of a bucket is one value; then the ranges are merged
    both = [
        rates.groupBy(*by, "block", rate_bucket(of).alias("bucket")).agg(F.min(rate).alias("rate")).withColumn("kind", F.lit(kind))
        for kind, of, rate in (("fp_at_fn", "fn", "fp"), ("fn_at_fp", "fp", "fn"))
    ]
    return both[0].unionByName(both[1]).groupBy(*by, "kind", "bucket").agg(F.min("rate").alias("rate"))


def _with_edge(points: DataFrame) -> DataFrame:
    edge = F.element_at(F.lit(list(RATE_EDGES)), F.col("bucket") + 1)
    return points.select("kind", "bucket", edge.alias("edge"), *[c for c in points.columns if c not in ("kind", "bucket")])


def operating_points(preds: DataFrame, blocks: int | None = None) -> DataFrame:
    """(kind, bucket, edge, rate) along the ascending scores.

    ``fp_at_fn``: in each bucket of the false-negative rate, the false-positive
    rate of its last score; ``fn_at_fp``: in each bucket of the false-positive
    rate, the false-negative rate of its first score.  The first falls and the
    second rises with the score, so both are the smallest rate of the bucket.
    Counts of 0 become one half.  Buckets no score falls into have no row.
    """
    return _with_edge(_points(_per_score(preds, [], blocks), []))


# --- bootstrap -----------------------------------------------------------

PARTS = 12  # a group is drawn in parts of a power of two documents, up to 2 ** PARTS
_COARSE = 32


def poisson_steps(mean: int) -> list[float]:
    """How often something is drawn: k if the uniform is at least the first k of these.

    Sums of the probabilities of 0, 1, 2, ...; those that no draw of 52 bits
    tells from 0 are 0, and they end where no draw tells the sum from 1.
    """
    steps, total, k = [], 0.0, 0
    while k <= mean or total < 1 - 2.0**-52:
        term = math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        if k > mean and term < 2.0**-60:
            break
        total += term
        steps.append(total if total > 2.0**-53 else 0.0)
        k += 1
    return steps


def _uniform(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def _drawn(uniform: Column, mean: int) -> Column:
    """The number of steps up to the uniform; every 32nd step tells which 32 to look at."""
    steps = poisson_steps(mean)
    sure = steps.count(0.0)
    steps = steps[sure:]

    def table(some: list[float]) -> Column:
        # one literal for Spark to fold, not one for each step
        return F.split(F.lit(",".join(map(repr, some))), ",").cast("array<double>")

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda step: step <= uniform))

    if len(steps) <= 2 * _COARSE:
        return (below(table(steps)) + sure).cast("bigint")
    start = below(table(steps[_COARSE - 1 :: _COARSE])) * _COARSE
    return (start + below(F.slice(table(steps), start + 1, F.lit(_COARSE))) + sure).cast("bigint")


def poisson_draws(groups: DataFrame, n: str, key: Column) -> DataFrame:
    """The groups with ``drawn``, Poisson-distributed with mean ``n``, a row for each part.

    A sum of Poisson numbers is one: n documents are drawn at once, in parts of
    2 ** PARTS and one for each lower bit of n, and the parts' draws add up to
    the group's.  A part's draw comes from the md5 of the key and the part.
    """
    large = F.expr(f"{n} div {1 << PARTS}")
    parts = F.concat(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda i: F.col(n).bitwiseAND(F.pow(F.lit(2), i).cast("bigint")) != 0),
            lambda i: F.struct(i.cast("bigint").alias("bit"), F.lit(0).cast("bigint").alias("nth")),
        ),
        F.transform(
            F.when(large > 0, F.sequence(F.lit(1).cast("bigint"), large)).otherwise(F.array().cast("array<bigint>")),
            lambda j: F.struct(F.lit(PARTS).cast("bigint").alias("bit"), j.alias("nth")),
        ),
    )
    each = groups.withColumn("_part", F.explode(parts)).withColumn(
        "_u", _uniform(F.concat_ws(":", key, F.col("_part")["bit"].cast("string"), F.col("_part")["nth"].cast("string")))
    )
    draw = F.lit(None).cast("bigint")
    for bit in range(PARTS + 1):
        draw = F.when(F.col("_part")["bit"] == bit, _drawn(F.col("_u"), 1 << bit)).otherwise(draw)
    return each.withColumn("drawn", draw).drop("_part", "_u")


# How often one document is drawn: k if the uniform is at least the first k of these.
POISSON_1 = tuple(math.exp(-1) * sum(1 / math.factorial(i) for i in range(k + 1)) for k in range(17))


def _document_draws(preds: DataFrame, doc: str, reps: int, seed: int) -> DataFrame:
    """(rep, score, spam, wrong, drawn): a Poisson(1) draw for every document and repetition, 0 too.

    The draw comes from the md5 of document, repetition and seed.  It is a sum
    of comparisons, which Spark compiles.
    """
    wrong = F.col("pred") != F.col("label")
    each = preds.select(
        "score", _spam().alias("spam"), wrong.alias("wrong"), doc, F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep")
    ).withColumn("_u", _uniform(F.concat_ws(":", F.col(doc).cast("string"), F.col("rep").cast("string"), F.lit(str(seed)))))
    drawn = sum((F.when(F.col("_u") >= step, 1).otherwise(0) for step in POISSON_1), F.lit(0))
    return each.withColumn("drawn", drawn.cast("bigint")).drop("_u", doc)


def _resampled(preds: DataFrame, reps: int, seed: int, blocks: int | None, doc: str | None = None) -> DataFrame:
    """(rep, block, score, s, h, fn, fp): drawn documents per score, of each repetition.

    Documents with the same score, label and prediction are counted first, and
    drawn together; with ``doc``, their key, each is drawn by itself.
    """
    if doc:
        drawn = _document_draws(preds, doc, reps, seed)
    else:
        wrong = F.col("pred") != F.col("label")
        groups = preds.groupBy("score", _spam().alias("spam"), wrong.alias("wrong")).agg(F.count("*").alias("n"))
        groups = checkpointed(groups)
        each = groups.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
        key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("score", "spam", "wrong", "rep")], F.lit(str(seed)))
        drawn = poisson_draws(each, "n", key).where("drawn > 0")

    def times(condition: str) -> Column:
        return F.sum(F.when(F.expr(condition), F.col("drawn")).otherwise(0))

    counted = drawn.groupBy("rep", "score").agg(
        times("spam").alias("s"), times("NOT spam").alias("h"),
        times("spam AND wrong").alias("fn"), times("NOT spam AND wrong").alias("fp"),
    )
    if doc:
        counted = counted.where("s + h > 0")  # scores that no draw fell on
    return with_score_block(counted, "score", ["rep"], blocks)


def roca_ci(
    preds: DataFrame, reps: int = 100, seed: int = 0, blocks: int | None = None, doc: str | None = None
) -> DataFrame:
    """(metric, estimate, low, high): 95 % bootstrap intervals of 1-ROCA and LAM, percent.

    Poisson bootstrap: every document counts Poisson(1) times in every
    repetition, documents that are alike Poisson(n) times together.  Draws
    depend on the group, repetition and seed only.  The work grows with the
    distinct groups, not with the documents.  With ``doc``, their key, every
    document is drawn by itself, and draws depend on document, repetition and
    seed.
    """
    counted = _resampled(preds, reps, seed, blocks, doc)
    errors = counted.groupBy("rep").agg(F.sum("fn").alias("fn"), F.sum("fp").alias("fp"))
    sums = _inversions(counted, ["rep"]).join(errors, "rep")
    roca = logit(_inversion_rate(F.col("inversions"), F.col("hams"), F.col("spams")))
    average = (logit(guarded_rate("fn", "spams")) + logit(guarded_rate("fp", "hams"))) / F.lit(2.0)
    spread = sums.select(roca.alias("roca"), average.alias("lam")).agg(
        F.stddev_samp("roca").alias("one_minus_roca"), F.stddev_samp("lam").alias("lam")
    ).unpivot([], ["one_minus_roca", "lam"], "metric", "sd")
    estimates = one_minus_roca(preds, blocks=blocks).select(
        F.lit("one_minus_roca").alias("metric"), F.col("one_minus_roca").alias("estimate")
    ).unionByName(lam(preds).select(F.lit("lam").alias("metric"), F.col("lam").alias("estimate")))
    center, margin = logit(F.col("estimate") / 100.0), F.lit(1.96) * F.col("sd")
    return estimates.join(spread, "metric").select(
        "metric", "estimate",
        (F.lit(100.0) * sigmoid(center - margin)).alias("low"),
        (F.lit(100.0) * sigmoid(center + margin)).alias("high"),
    )


def resampled_points(preds: DataFrame, reps: int = 100, seed: int = 0, blocks: int | None = None) -> DataFrame:
    """(kind, bucket, edge, reps, rate): both rate curves averaged over the bootstrap's repetitions.

    Rates are averaged as logits; ``reps`` counts the repetitions with a score
    in the bucket.
    """
    points = _points(_resampled(preds, reps, seed, blocks), ["rep"])
    # a rate of 1 has no finite logit
    inside = points.withColumn("rate", F.least("rate", F.lit(1 - 1e-9)))
    mean = inside.groupBy("kind", "bucket").agg(F.count("*").alias("reps"), sigmoid(F.avg(logit(F.col("rate")))).alias("rate"))
    return _with_edge(mean)


def run_summary(rocas: DataFrame) -> DataFrame:
    """(runs, low, high, mean) of 1-ROCA over repeated runs."""
    return rocas.agg(
        F.count("*").alias("runs"), F.min("one_minus_roca").alias("low"),
        F.max("one_minus_roca").alias("high"), F.avg("one_minus_roca").alias("mean"),
    )
