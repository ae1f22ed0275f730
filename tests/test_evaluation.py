import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.functions.numeric import RATE_EDGES
from tallyline.operators import evaluation as ev

SCHEMA = "doc_id long, label string, score double, pred string"


def made(n=200, seed=5, distinct=40, shift=0.3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = rng.choice(["spam", "ham", "ham"])
        score = round(rng.gauss(shift if label == "spam" else -shift, 1) * distinct / 6) / (distinct / 6)
        rows.append((i, label, score, "spam" if score > 0 else "ham"))
    return rows


def brute_roca(rows):
    spam = [r[2] for r in rows if r[1] == "spam"]
    ham = [r[2] for r in rows if r[1] == "ham"]
    wrong = sum((s < h) + 0.5 * (s == h) for s in spam for h in ham)
    return 100 * (wrong or 0.5) / (len(spam) * len(ham))


def brute_points(rows):
    """Walk up the distinct scores; last value per FN bucket, first per FP bucket."""
    spams = sum(r[1] == "spam" for r in rows)
    hams = len(rows) - spams
    points = {}
    for score in sorted({r[2] for r in rows}):
        fn = sum(r[1] == "spam" and r[2] <= score for r in rows) or 0.5
        fp = sum(r[1] == "ham" and r[2] > score for r in rows) or 0.5
        def bucket(x):
            return next(i for i, e in enumerate(RATE_EDGES) if x <= e)
        points["fp_at_fn", bucket(fn / spams)] = fp / hams
        points.setdefault(("fn_at_fp", bucket(fp / hams)), fn / spams)
    return points


CASES = {
    "mixed": made(), "fine": made(300, distinct=100_000), "tied": [(i, "spam" if i % 3 else "ham", 1.0, "spam") for i in range(9)],
    "perfect": [(i, "spam" if i > 4 else "ham", float(i), "spam") for i in range(10)],
    "reversed": [(i, "ham" if i > 4 else "spam", float(i), "spam") for i in range(10)],
    "top matters": [(1, "ham", 9.0, "spam"), (2, "spam", 5.0, "spam"), (3, "ham", 1.0, "spam")],
}


@pytest.mark.parametrize("blocks", [2, 7, 1024])
@pytest.mark.parametrize("case", CASES)
def test_roca(spark, case, blocks):
    df = spark.createDataFrame(CASES[case], SCHEMA)
    assert ev.one_minus_roca(df, blocks=blocks).first().one_minus_roca == pytest.approx(brute_roca(CASES[case]))


def test_roca_by_group(spark):
    groups = {"a": made(80, 1), "b": made(120, 2, shift=1.0)}
    rows = [(g, *r) for g, rs in groups.items() for r in rs]
    df = spark.createDataFrame(rows, "g string, " + SCHEMA)
    got = {r.g: r.one_minus_roca for r in ev.one_minus_roca(df, by=["g"], blocks=8).collect()}
    assert got == pytest.approx({g: brute_roca(rs) for g, rs in groups.items()})
    summary = ev.run_summary(ev.one_minus_roca(df, by=["g"])).first()
    assert summary.runs == 2 and summary.low == pytest.approx(min(got.values()))


def test_roca_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, "ham", 1.0, "ham")], SCHEMA)
    assert ev.one_minus_roca(df).first().one_minus_roca is None


@pytest.mark.parametrize("blocks", [3, 1024])
@pytest.mark.parametrize("case", [c for c in CASES if c != "tied"])
def test_operating_points(spark, case, blocks):
    df = spark.createDataFrame(CASES[case], SCHEMA)
    got = {(r.kind, r.bucket): r.rate for r in ev.operating_points(df, blocks).collect()}
    assert got == pytest.approx(brute_points(CASES[case]))


def test_lam(spark):
    rows = CASES["mixed"]
    hams, spams = (sum(r[1] == k for r in rows) for k in ("ham", "spam"))
    fp = sum(r[1] == "ham" and r[3] == "spam" for r in rows)
    fn = sum(r[1] == "spam" and r[3] == "ham" for r in rows)
    mean = (math.log(fn / (spams - fn)) + math.log(fp / (hams - fp))) / 2
    got = ev.lam(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.hams, got.spams, got.fp, got.fn) == (hams, spams, fp, fn)
    assert got.lam == pytest.approx(100 / (1 + math.exp(-mean)))
    none_missed = ev.lam(spark.createDataFrame(CASES["perfect"], SCHEMA)).first()
    assert none_missed.fn == 0 and 0 < none_missed.lam < 100


def test_intervals_hold_the_estimate_and_do_not_depend_on_the_layout(spark):
    df = spark.createDataFrame(made(400, distinct=5_000), SCHEMA)
    first = {r.metric: r for r in ev.roca_ci(df, reps=60, seed=3, blocks=16).collect()}
    for r in first.values():
        assert r.low < r.estimate < r.high
    other = {r.metric: r for r in ev.roca_ci(df.repartition(13), reps=60, seed=3, blocks=5).collect()}
    seeded = {r.metric: r for r in ev.roca_ci(df, reps=60, seed=4, blocks=16).collect()}
    for m, r in first.items():
        assert tuple(other[m])[1:] == pytest.approx(tuple(r)[1:], rel=1e-9)
        assert seeded[m].low != r.low
    # An ordinary bootstrap, drawing documents with replacement, gives a similar width.
    rng = np.random.default_rng(0)
    rows = made(400, distinct=5_000)
    draws = [brute_roca([rows[i] for i in rng.integers(0, len(rows), len(rows))]) / 100 for _ in range(200)]
    sd = np.std([math.log(x / (1 - x)) for x in draws], ddof=1)
    r = first["one_minus_roca"]
    width = (math.log(r.high / (100 - r.high)) - math.log(r.low / (100 - r.low))) / (2 * 1.96)
    assert width == pytest.approx(sd, rel=0.35)


@pytest.mark.parametrize("n", [1, 6, 37])
def test_draws_are_poisson(spark, n):
    rows = 60_000
    groups = spark.range(rows).withColumn("n", F.lit(n))
    drawn = ev.poisson_draws(groups, "n", F.concat_ws(":", F.col("id").cast("string"), F.lit("7")))
    counts = {r.n: r["count"] for r in drawn.groupBy("id").agg(F.sum("drawn").alias("n")).groupBy("n").count().collect()}
    for k in range(3 * n + 5):
        share = math.exp(k * math.log(n) - n - math.lgamma(k + 1))
        assert counts.get(k, 0) / rows == pytest.approx(share, abs=4.5 * math.sqrt(share / rows) + 1e-9)
    assert sum(counts.values()) == rows


def test_large_groups_are_drawn_in_bounded_parts(spark):
    n = 5 * 2**ev.PARTS + 2**11 + 1
    drawn = ev.poisson_draws(spark.range(400).withColumn("n", F.lit(n)), "n", F.col("id").cast("string"))
    assert drawn.count() == 400 * 7
    totals = [r.n for r in drawn.groupBy("id").agg(F.sum("drawn").alias("n")).collect()]
    assert np.mean(totals) == pytest.approx(n, abs=5 * math.sqrt(n / 400)) and np.var(totals) == pytest.approx(n, rel=0.35)


def test_steps_of_a_poisson_number():
    for mean in (1, 2, 64, 4096):
        steps = ev.poisson_steps(mean)
        assert steps == sorted(steps) and steps[-1] == pytest.approx(1, abs=1e-11) and len(steps) < 2 * mean + 60


def sampled(spark, rows, reps, seed):
    """The rows of each repetition: alike documents are drawn together, so any of them stands for all."""
    alike = {}
    for r in rows:
        alike.setdefault((r[2], r[1] == "spam", r[3] != r[1]), []).append(r)
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("score", "spam", "wrong", "rep")], F.lit(str(seed)))
    groups = spark.createDataFrame([(*k, len(v)) for k, v in alike.items()], "score double, spam boolean, wrong boolean, n long")
    each = groups.withColumn("rep", F.explode(F.lit(list(range(reps)))))
    samples = [[] for _ in range(reps)]
    for d in ev.poisson_draws(each, "n", key).collect():
        samples[d.rep] += [alike[d.score, d.spam, d.wrong][0]] * d.drawn
    return samples


def test_weights_of_draws_follow_a_plain_loop(spark):
    rows = made(60)
    logits = []
    for sample in sampled(spark, rows, 20, 5):
        x = brute_roca(sample) / 100
        logits.append(math.log(x / (1 - x)))
    sd = np.std(logits, ddof=1)
    got = {r.metric: r for r in ev.roca_ci(spark.createDataFrame(rows, SCHEMA), reps=20, seed=5).collect()}["one_minus_roca"]
    centre = math.log(got.estimate / (100 - got.estimate))
    assert math.log(got.low / (100 - got.low)) == pytest.approx(centre - 1.96 * sd)


def test_resampled_points_follow_a_plain_loop(spark):
    rows = made(150)
    logits = {}
    for sample in sampled(spark, rows, 12, 0):
        for at, rate in brute_points(sample).items():
            rate = min(rate, 1 - 1e-9)
            logits.setdefault(at, []).append(math.log(rate / (1 - rate)))
    want = {at: (len(x), 1 / (1 + math.exp(-np.mean(x)))) for at, x in logits.items()}
    got = {(r.kind, r.bucket): (r.reps, r.rate) for r in ev.resampled_points(spark.createDataFrame(rows, SCHEMA), reps=12, blocks=5).collect()}
    assert got.keys() == want.keys()
    assert all(got[at][0] == want[at][0] and got[at][1] == pytest.approx(want[at][1]) for at in want)


def test_one_group_with_nearly_all_scores(spark):
    """It lies in many ranges, and no array is carried by the rows."""
    rows = [("big", *r) for r in made(2_000, 3, distinct=100_000)] + [("small", *r) for r in made(20, 4)]
    df = spark.createDataFrame(rows, "g string, " + SCHEMA)
    counted = ev._per_score(df, ["g"], 16)
    sizes = {(r.g, r.block): r.n for r in counted.groupBy("g", "block").agg(F.count("*").alias("n")).collect()}
    assert len([k for k in sizes if k[0] == "big"]) >= 12 and max(sizes.values()) < 2_000 / 4
    assert not [c for c, kind in counted.dtypes if kind.startswith("array")]
    got = {r.g: r.one_minus_roca for r in ev.one_minus_roca(df, by=["g"], blocks=16).collect()}
    assert got == pytest.approx({g: brute_roca([r[1:] for r in rows if r[0] == g]) for g in ("big", "small")})


def test_documents_drawn_by_themselves(spark):
    """Alike documents are drawn apart: what is drawn follows a plain loop over documents and repetitions."""
    rows = made(60) + [(100 + i, "spam", 1.0, "ham") for i in range(9)]
    steps, logits = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(17)]), []
    for rep in range(20):
        sample = []
        for r in rows:
            u = int(hashlib.md5(f"{r[0]}:{rep}:5".encode()).hexdigest()[:13], 16) / 2**52
            sample += [r] * int((steps <= u).sum())
        x = brute_roca(sample) / 100
        logits.append(math.log(x / (1 - x)))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.metric: r for r in ev.roca_ci(df, reps=20, seed=5, doc="doc_id").collect()}["one_minus_roca"]
    centre = math.log(got.estimate / (100 - got.estimate))
    assert math.log(got.low / (100 - got.low)) == pytest.approx(centre - 1.96 * np.std(logits, ddof=1))
