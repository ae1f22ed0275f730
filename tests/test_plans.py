import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline.plans import (
    Staging, checkpointed, checkpointed_by, explode_counts, explode_once, first_of_each, release, running_before, salted_join,
    shared_folder, to_stripes, with_positions, with_score_block,
)
from tallyline.plans.blocks import Blocks, read_group, read_parts, write_blocks, write_groups, write_parts


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_join(spark, how):
    """One key holds a third of the rows."""
    rng = random.Random(1)
    many = spark.createDataFrame([(0 if rng.random() < 0.34 else rng.randrange(500), i) for i in range(3_000)], "k int, i int")
    one = spark.createDataFrame([(k, str(k)) for k in range(0, 400)], "k int, name string")
    counts = many.groupBy("k").agg(F.count("*").alias("n"))
    got = salted_join(many, one, ["k"], ["i"], counts, how)
    want = many.join(one, "k", how)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_salting_bounds_the_largest_group(spark):
    from tallyline.plans import hot_keys, salt_many

    many = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    counts = many.groupBy("k").agg(F.count("*").alias("n"))
    salted = salt_many(many, hot_keys(counts, ["k"]), ["k"], ["id"])
    assert salted.groupBy("k", "slot").count().agg(F.max("count")).first()[0] < 9_000 / 256 * 3


@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_before(spark, group):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), o, rng.randrange(5), rng.randrange(9)) for o in range(200)]
    df = spark.createDataFrame(rows, "g string, o int, v int, w int").withColumn("b", F.floor(F.col("o") / 16))
    for r in running_before(df, ["v", "w"], "b", "o", group).collect():
        earlier = [x for x in rows if x[1] < r.o and (not group or x[0] == r.g)]
        assert r.v_before == sum(x[2] for x in earlier) and r.w_before == sum(x[3] for x in earlier)


@pytest.mark.parametrize("blocks", [2, 31, 33, 64, 1024])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_score_blocks(spark, blocks, by):
    rng = random.Random(blocks)
    scores = sorted({("ab"[i % 2], rng.choice([rng.gauss(0, 1 + i % 2), 0.0, 1.0])) for i in range(3_000)})
    df = spark.createDataFrame(scores, "g string, score double")
    rows = with_score_block(df, "score", by, blocks).collect()
    assert len(rows) == len(scores)
    groups = {}
    for r in rows:
        groups.setdefault(r.g if by else "", []).append((r.score, r.block))
    for placed in groups.values():
        placed.sort()
        assert all(a[1] <= b[1] and (a[0] < b[0] or a[1] == b[1]) for a, b in zip(placed, placed[1:]))
        sizes = {}
        for score, block in set(placed):
            sizes[block] = sizes.get(block, 0) + 1
        assert len(sizes) <= blocks and max(sizes.values()) <= 3 * len(set(placed)) / blocks + 3


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_positions(spark, by):
    """One group holds most rows; there are nulls, ties and repeated rows."""
    rng = random.Random(6)
    rows = [(rng.choice(["a"] * 8 + ["b", None]), rng.choice([1, 2, None]), rng.choice([None, rng.randrange(400)])) for _ in range(2_000)]
    df = spark.createDataFrame(rows, "g string, h int, o int").repartition(7)
    placed = with_positions(df, ["o"], by)
    assert placed.columns == ["g", "h", "o", "position"]
    groups = {}
    for r in placed.collect():
        groups.setdefault(tuple(r[c] for c in by), []).append((r.position, -1 if r.o is None else r.o))
    for group in groups.values():
        group.sort()
        assert [p for p, _ in group] == list(range(len(group))) and [o for _, o in group] == sorted(o for _, o in group)
    assert sum(map(len, groups.values())) == len(rows)
    assert with_positions(df.limit(0), ["o"], by).count() == 0


def test_first_of_each(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randrange(300), i) for i in range(900)] + [("c", 1, 2_000), ("c", 1, 2_000)]
    got = first_of_each(spark.createDataFrame(rows, "g string, o int, i int").repartition(5), ["o", "i"], 50, ["g"])
    want = [r for g in ("a", "b", None) for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])[:50]] + rows[-2:]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    tied = first_of_each(spark.createDataFrame(rows, "g string, o int, i int"), ["o"], 1, ["g"]).where("g = 'c'")
    assert tied.count() == 2
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_blocks(spark):
    rows = [(i, list(range(i % 5))) for i in range(50)] + [(50, None)]
    folder = Staging(spark, "test").folder("blocks")
    df = spark.createDataFrame(rows, "position long, numbers array<long>").repartition(6)
    blocks = Blocks(folder, write_blocks(df, "position", "numbers", folder, 8))
    assert [blocks.row(i // 8, i % 8).tolist() for i, _ in rows] == [x or [] for _, x in rows]


def test_groups_are_files(spark):
    folder = Staging(spark, "test").folder("groups")
    df = spark.range(100).selectExpr("id % 3 as a", "id % 5 as b", "id", "array(string(id)) as words")
    files = write_groups(df.repartition(4), ["a", "b"], folder)
    assert len(files) == 15
    for (a, b), file in files.items():
        got = read_group(folder, file).to_pylist()
        assert sorted(r["id"] for r in got) == [i for i in range(100) if (i % 3, i % 5) == (a, b)]
        assert all(r == {"id": r["id"], "words": [str(r["id"])]} for r in got)
    assert write_groups(df.limit(0), ["a", "b"], folder) == {}


def test_parts_of_a_file(spark):
    folder = Staging(spark, "test").folder("parts")
    parts = [b"one", b"", b"\0" * 5000, b"end"]
    file = write_parts(folder, parts)
    assert read_parts(folder, file, [2, 0]) == [parts[2], parts[0]]
    assert read_parts(folder, file, range(4)) == parts


def test_bucketed_tables_keep_the_layout(spark):
    df = checkpointed_by(spark.range(100).withColumn("k", F.col("id") % 7), ["k"])
    plan = df.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert sorted(r["count"] for r in df.groupBy("k").count().collect()) == [14] * 5 + [15] * 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tallyline_")]


def test_released_tables_are_deleted(spark):
    stored = checkpointed(spark.range(10))
    (file, *_) = [f.removeprefix("file://") for f in stored.inputFiles()]
    assert os.path.exists(file)
    release(stored)
    assert not os.path.exists(file)
    release(spark.range(3))  # nothing stored, nothing to do


def test_tables_are_staged_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    stored = checkpointed(spark.range(10).withColumn("v", F.lit(None).cast("string")))
    assert all(f.removeprefix("file://").startswith(folder) for f in stored.inputFiles())
    assert stored.count() == 10 and stored.columns == ["id", "v"]
    staging = Staging(spark, "test")
    kept = staging.keep(spark.range(5))
    (file, *_) = kept.inputFiles()
    assert os.path.exists(file.removeprefix("file://"))
    staging.drop(kept)
    assert not os.path.exists(file.removeprefix("file://"))


def test_stripes_are_bounded(spark):
    df = spark.range(1_000).select(F.lit("x").alias("k"), F.col("id").alias("y"), F.col("id").alias("v"))
    stripes = to_stripes(df, "k", "y", "v", width=50)
    sizes = [len(r.stripe) for r in stripes.collect()]
    assert sum(sizes) == 1_000 and len(sizes) == 20 and max(sizes) < 100


def test_computed_arrays_are_evaluated_once(spark):
    from tallyline.functions import tokens

    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "id long, text string")
    df = explode_once(docs.select("id", tokens("text").alias("ws")), "ws", "w", "id")
    assert [tuple(r) for r in df.collect()] == [(1, "a"), (1, "b")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_elements_are_counted_in_the_row(spark):
    from collections import Counter

    rng = random.Random(4)
    rows = [(i, [rng.choice("abcd") for _ in range(rng.randrange(12))]) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "i int, xs array<string>")
    counted = explode_counts(df, "xs", "x", "n", "i")
    want = {(i, x): n for i, xs in rows for x, n in Counter(xs or []).items()}
    assert {(r.i, r.x): r.n for r in counted.collect()} == want
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    kept = explode_counts(df, "xs", "x", "n", "i", keep_empty=True).where("x is null").collect()
    assert {r.i for r in kept} == {i for i, xs in rows if not xs} and all(r.n is None for r in kept)
