import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.operators import pagerank as pr
from tallyline.plans import hot_keys


def frames(spark, nodes, edges):
    return (spark.createDataFrame([(n,) for n in nodes], "id long"),
            spark.createDataFrame(edges, "src long, dst long"))


def model(nodes, edges, source, iterations, alpha=0.15):
    """Push, sum, measure the missing mass, jump: node by node."""
    out = defaultdict(list)
    for s, d in edges:
        out[s].append(d)
    p = {n: float(n == source) for n in nodes}
    for _ in range(iterations):
        mass = dict.fromkeys(nodes, 0.0)
        for n in nodes:
            for d in out[n]:
                if d in mass:
                    mass[d] += p[n] / len(out[n])
        missing = 1.0 - sum(mass.values())
        p = {n: (1 - alpha) * m for n, m in mass.items()}
        if source in p:
            p[source] += alpha + (1 - alpha) * missing
    return p


# Node 3 repeats a neighbour, 4 is dangling, 5 points to the absent 99, 6 is isolated.
NODES = [1, 2, 3, 4, 5, 6]
EDGES = [(1, 2), (1, 3), (2, 1), (2, 5), (3, 4), (3, 4), (3, 1), (5, 99), (5, 1)]


@pytest.mark.parametrize("sources", [[1], [1, 2], [4, 6, 3]])
@pytest.mark.parametrize("iterations", [0, 1, 4])
def test_small_graph(spark, sources, iterations):
    nodes, edges = frames(spark, NODES, EDGES)
    ranks = pr.pagerank(nodes, edges, sources, iterations, checkpoint_every=2)
    got = {(r.source, r.id): r.p for r in pr.dense_ranks(ranks, nodes, sources).collect()}
    assert len(got) == len(sources) * len(NODES)
    for s in sources:
        want = model(NODES, EDGES, s, iterations)
        assert {n: got[s, n] for n in NODES} == pytest.approx(want, abs=1e-14)
        assert sum(got[s, n] for n in NODES) == pytest.approx(1.0, abs=1e-12)


def test_hub_holding_most_edges(spark):
    rng = random.Random(3)
    nodes = list(range(400))
    edges = [(0, d) for d in range(1, 400)] + [(rng.randrange(400), rng.randrange(400)) for _ in range(300)]
    n, e = frames(spark, nodes, edges)
    graph = pr.transitions(n, e)
    slots = {r.src: r.slots for r in graph.hot.collect()}
    assert slots[0] > 100
    largest = graph.steps.groupBy("src", "slot").count().agg(F.max("count")).first()[0]
    assert largest < 20
    got = {r.id: r.p for r in pr.pagerank(n, e, [0], 3).collect()}
    want = {k: v for k, v in model(nodes, edges, 0, 3).items() if v > 0}
    assert got == pytest.approx(want, abs=1e-13)


def test_steps_are_not_shuffled_again(spark):
    nodes, edges = frames(spark, NODES, EDGES)
    graph = pr.transitions(nodes, edges)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pr.iterate(pr.init_ranks(nodes, [1]), graph)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = plan[plan.index("SortMergeJoin"):]
    left = joined[:joined.index("FileScan parquet")]
    assert "Exchange" not in left and "Bucketed: true" in joined


def test_hot_keys_are_bounded(spark):
    counts = spark.createDataFrame([(i, 1 if i else 1000) for i in range(1001)], "k long, n long")
    assert [tuple(r) for r in hot_keys(counts, ["k"], fan=8).collect()] == [(0, 4)]
    even = spark.createDataFrame([(i, 1) for i in range(1000)], "k long, n long")
    assert hot_keys(even, ["k"], fan=8).count() == 0


def test_unknown_source_has_no_probability(spark):
    nodes, edges = frames(spark, NODES, EDGES)
    ranks = pr.dense_ranks(pr.pagerank(nodes, edges, [77], 2), nodes, [77])
    assert ranks.agg(F.sum("p")).first()[0] == 0.0


def test_node_listed_twice_fails(spark):
    nodes, edges = frames(spark, [*NODES, 2], EDGES)
    with pytest.raises(Exception, match="node listed twice: 2"):
        pr.pagerank(nodes, edges, [1], 1).collect()


def test_resume_equals_one_run(spark, tmp_path):
    nodes, edges = frames(spark, NODES, EDGES)
    base = str(tmp_path / "run")
    pr.pagerank(nodes, edges, [1, 2], 2, base=base)
    resumed = pr.pagerank(nodes, edges, [1, 2], 5, start=2, base=base, checkpoint_every=2)
    assert {p.name for p in (tmp_path / "run").iterdir()} == {"iter0002", "iter0004", "iter0005"}
    whole = pr.pagerank(nodes, edges, [1, 2], 5)
    assert {(r.source, r.id): r.p for r in resumed.collect()} == pytest.approx(
        {(r.source, r.id): r.p for r in whole.collect()}, abs=1e-15)
    with pytest.raises(ValueError):
        pr.pagerank(nodes, edges, [1], 3, start=1)


def test_statistics(spark):
    nodes, edges = frames(spark, NODES, EDGES)
    assert tuple(pr.graph_stats(nodes, edges).first()) == (6, 9, 4)
    listed_twice, _ = frames(spark, [*NODES, 2], EDGES)
    assert tuple(pr.validate_graph(listed_twice, edges).first()) == (1, 1)
    start = pr.init_ranks(nodes, [5])
    assert tuple(pr.mass_balance(start, nodes, edges).first()) == (5, 0.5, 0.5)


def test_top_nodes_break_ties_by_id(spark):
    rows = [(1, 7, 0.2), (1, 3, 0.2), (1, 9, 0.6), (2, 4, 1.0)]
    ranks = spark.createDataFrame(rows, "source long, id long, p double")
    got = [tuple(r) for r in pr.top_nodes(ranks, 2).orderBy("source", "rank").collect()]
    assert got == [(1, 1, 9, 0.6), (1, 2, 3, 0.2), (2, 1, 4, 1.0)]
    plan = pr.top_nodes(ranks, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_top_nodes_of_small_probabilities(spark):
    rows = [(1, i, p) for i, p in enumerate([1e-14, 1e-13, 4e-13, 9e-13, 9e-13 * (1 + 1e-13)])]
    got = [r.id for r in pr.top_nodes(spark.createDataFrame(rows, "source long, id long, p double"), 5).orderBy("rank").collect()]
    assert got == [3, 4, 2, 1, 0]


def test_sources_listed_twice(spark):
    nodes = spark.createDataFrame([(1,), (2,)], "id long")
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    ranks = pr.pagerank(nodes, edges, [1, 1], 1)
    assert pr.dense_ranks(ranks, nodes, [1, 1]).count() == 2
