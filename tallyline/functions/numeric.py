"""Small numeric rules used by scoring, evaluation and comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper edges (inclusive) of the operating-point rate buckets.
RATE_EDGES = (
    0.0001, 0.0002, 0.0005,
    0.001, 0.002, 0.005,
    0.01, 0.02, 0.05,
    0.1, 0.2, 0.5,
    1.0,
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def logit(p: Column | str) -> Column:
    p = _col(p)
    return F.log(p / (F.lit(1.0) - p))


def guarded_rate(hits: Column | str, total: Column | str) -> Column:
    """hits/total kept inside (0, 1): 0 counts as a half, total as total - 1/2."""
    hits, total = _col(hits), _col(total)
    safe = (
        F.when(hits == 0, F.lit(0.5))
        .when(hits == total, total - F.lit(0.5))
        .otherwise(hits)
    )
    return F.when(total > 0, safe / F.nullif(total, F.lit(0)))


def sign_vote(score: Column | str) -> Column:
    """-1, 0 or +1 by the sign of the score."""
    return F.signum(_col(score)).cast("int")


def rate_bucket(rate: Column | str) -> Column:
    """Index of the first edge that is not below the rate."""
    rate = _col(rate)
    bucket = F.when(rate <= F.lit(RATE_EDGES[0]), F.lit(0))
    for i, edge in enumerate(RATE_EDGES[1:-1], start=1):
        bucket = bucket.when(rate <= F.lit(edge), F.lit(i))
    return bucket.otherwise(F.lit(len(RATE_EDGES) - 1))


def floor_hundredths(v: Column | str) -> Column:
    return F.floor(_col(v) * F.lit(100.0)) / F.lit(100.0)
