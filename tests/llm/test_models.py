"""Language model, neighbours, quality, archives, chat, mixing, pipeline."""

import base64
import hashlib
import math
import random
import tracemalloc
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallyline.llm import archives, chat, language_model, mixing, nearest, packed, quality, shards
from tallyline.llm.workload import QUERIES
from tallyline.plans import Staging

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lm_tokens(text):
    return brute.words(text, brute.LOWER) + [None]


def kneser_ney(rows, held_out):
    counts = Counter()
    for d, t in rows:
        if not held_out(d):
            w = lm_tokens(t)
            counts.update(zip(["<s>", *w[:-1]], w))
    left, context, seen, unigrams = Counter(), Counter(), defaultdict(Counter), Counter()
    for (a, b), n in counts.items():
        left[b] += 1
        context[a] += n
        seen[a][min(n, 3)] += 1
        unigrams[b] += n

    def discount(values):
        n = [Counter(values)[i] for i in (1, 2, 3, 4)]
        if min(n) == 0:
            return [0, 0.5, 1, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) for i in (1, 2, 3))]

    d1, d2 = discount(left.values()), discount(counts.values())
    total, types, all_left = sum(unigrams.values()), len(unigrams), sum(left.values())

    def p1(w):
        freed = sum(d1[min(n, 3)] for n in left.values()) / all_left if all_left else 1
        return (max(left[w] - d1[min(left[w], 3)], 0) / all_left if all_left else 0) + freed / (types + 1)

    def p2(a, w):
        if not context[a]:
            return p1(w)
        freed = sum(d2[i] * n for i, n in seen[a].items()) / context[a]
        return max(counts[a, w] - d2[min(counts[a, w], 3)], 0) / context[a] + freed * p1(w)

    out = []
    for d, t in rows:
        w = lm_tokens(t)
        out.append((
            d, len(w), sum(x in unigrams for x in w),
            sum(math.log10((unigrams[x] + 1) / (total + types + 1)) for x in w),
            sum(math.log10(p2(a, b)) for a, b in zip(["<s>", *w[:-1]], w)), total,
        ))
    return out, p2, unigrams


@pytest.mark.parametrize("train_all", [True, False])
def test_language_model(spark, train_all, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 300)
    rng = random.Random(2)
    rows = [(d, " ".join(f"W{int(rng.expovariate(0.05))}" for _ in range(rng.randrange(60)))) for d in range(80)]
    rows += [(90, None), (91, ""), (92, "the end"), (92, "the end"), (None, "W1 w2"), (93, "x " * 5000), (94, "É é E e")]
    held = (lambda d: d is not None and d % 7 == 2) if train_all else (lambda d: True)
    want, p2, unigrams = kneser_ney(rows, held)
    training = ~(F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False))) if train_all else F.lit(False)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(4)
    got = [(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score, r.train_tokens) for r in language_model.score_documents(docs, training).collect()]
    order = lambda r: (str(r[0]), *r[1:3], round(r[4], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:3] == w[:3] and g[5] == w[5] and g[3:5] == pytest.approx(w[3:5], abs=1e-7)
    if train_all:
        for a in ("<s>", b"w1", b"never"):
            assert sum(p2(a, w) for w in unigrams) + p2(a, "unknown") == pytest.approx(1)


@pytest.mark.parametrize("order", [3, 4])
def test_language_model_of_higher_order(spark, order, monkeypatch):
    """Longer contexts by recursion over dictionaries; a shared passage gets likelier with the order."""
    monkeypatch.setattr(language_model, "CHUNK_TOKENS", 300)
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randrange(12)}" for _ in range(30))
    rows = [(d, " ".join(f"W{int(rng.expovariate(0.2))}" for _ in range(rng.randrange(50)))) for d in range(70)]
    rows += [(100 + d, passage) for d in range(5)] + [(200, None), (201, "never w1 w2")]
    held = lambda d: d % 7 == 2
    padded = lambda t: ["<s>"] * (order - 1) + lm_tokens(t)
    tables = {order: Counter(tuple(x[i : i + order]) for d, t in rows if not held(d) for x in [padded(t)] for i in range(len(x) - order + 1))}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    d, total, seen = {}, Counter(), defaultdict(Counter)
    for k, table in tables.items():
        d[k] = language_model.discounts([Counter(table.values())[i] for i in (1, 2, 3, 4)])
        for g, c in table.items():
            total[k, g[:-1]] += c
            seen[k, g[:-1]][min(c, 3)] += 1

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(tables[1]) + 1)
        h = (k, g[:-1])
        if not total[h]:
            return p(g[1:])
        c = tables[k][g]
        return max(c - d[k][min(c, 3)], 0) / total[h] + sum(d[k][i] * n for i, n in seen[h].items()) / total[h] * p(g[1:])

    want = {i: sum(math.log10(p(tuple(x[j : j + order]))) for x in [padded(t)] for j in range(len(x) - order + 1)) for i, t in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    training = F.col("doc_id") % 7 != 2
    got = {r.doc_id: r.score for r in language_model.score_documents(docs, training, order=order).collect()}
    assert got == pytest.approx(want, abs=1e-7)
    lower = {r.doc_id: r.score for r in language_model.score_documents(docs, training, order=order - 1).collect()}
    assert got[100] > lower[100]


def test_discounts_free_some_mass():
    assert language_model.discounts([100, 10, 30, 1])[2] == 1.0
    assert language_model.discounts([100, 50, 20, 10]).tolist() == pytest.approx([0, 0.5, 1.4, 2.0])
    for n in ([1, 1, 9, 9], [5, 90, 1, 60], [3, 3, 3, 90]):
        assert all(0 < d < i + 1 for i, d in enumerate(language_model.discounts(n)[1:]))


@pytest.mark.parametrize("order", [2, 3])
def test_triple_copies_leave_no_word_impossible(spark, order):
    """Few texts twice, most three times: the estimated D2 is below 0."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(12)) for _ in range(50)]
    copies = [1] * 20 + [2] * 6 + [3] * 20 + [4] * 4
    rows = [(7 * i, t) for i, t in enumerate(t for t, n in zip(texts, copies) for _ in range(n))]
    words = [t.split() for t, n in zip(texts, copies) if n == 2]
    rows += [(1, f"{words[0][3]} {words[1][3]} unheard {words[2][5]} {words[0][6]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = language_model.score_documents(docs, F.col("doc_id") % 7 == 0, order=order).collect()
    assert all(math.isfinite(r.score) and math.isfinite(r.perplexity) for r in got)


@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=20), st.integers(1, 9))
@settings(max_examples=30, deadline=None)
def test_shards(tmp_path_factory, keys, others, parts):
    folder = f"file://{tmp_path_factory.mktemp('shards')}"
    stored = np.array(sorted(keys), np.uint64)
    values = np.arange(1, len(stored) + 1)
    part = packed.parts_of(stored, parts)
    names = {
        int(p): shards.write_shard(folder, "t", stored[part == p], [values[part == p].astype("<i8")]) for p in np.unique(part)
    }
    asked = np.array(sorted(keys | others), np.uint64)
    found = shards.Table(folder, names, parts, ["<i8"]).look_up(asked)[0]
    want = dict(zip(stored.tolist(), values.tolist()))
    assert found.tolist() == [want.get(k, 0) for k in asked.tolist()]


def test_shards_keep_large_values_apart(tmp_path):
    """A small value takes a byte; others are listed, and come back as they were."""
    folder = f"file://{tmp_path}/shards"
    keys = np.arange(1, 1001, dtype=np.uint64)
    values = np.where(keys % 100 == 0, keys.astype(np.int64) << 32, keys.astype(np.int64) % 254)
    values[:3] = 254, 255, -7
    name = shards.write_shard(folder, "t", keys, [values, values % 3])
    table = shards.Table(folder, {0: name}, 1, ["<i8", "u1"])
    asked = np.arange(0, 1003, dtype=np.uint64)
    found = table.look_up(asked)
    assert found[0].tolist() == [0, *values.tolist(), 0, 0] and found[1].tolist() == [0, *(values % 3).tolist(), 0, 0]
    assert (tmp_path / "shards" / name).stat().st_size < 1000 * 11


@pytest.mark.parametrize("width", [2, 3, 4])
def test_grams_travel_with_their_words_once(width):
    """Packed n-grams take a few bytes a word and come back whole; a context of several words is in one range."""
    rng = np.random.default_rng(width)
    words = [rng.integers(0, 2**64, 300, np.uint64)[rng.integers(0, 300, 20_000)] for _ in range(width)]
    key, words, counts = language_model._merge(words, np.ones(20_000, np.int64))
    rows = list(language_model._packed_grams(key, words, counts, 5))
    assert sum(len(c) for _, cells in rows for c in cells) < len(key) * (8 * width + 4) / 3
    batch = next(language_model._batches(rows, language_model._GRAMS))
    *back, n = language_model._unpacked_grams([batch], width)
    assert sorted(zip(*map(np.ndarray.tolist, back), n.tolist())) == sorted(zip(*map(np.ndarray.tolist, words), counts.tolist()))
    if width > 2:
        ranges = {}
        for p, cells in rows:
            one = pa.RecordBatch.from_pydict({"part": [p], "cells": [cells]}, schema=language_model._GRAMS)
            for context in zip(*map(np.ndarray.tolist, language_model._unpacked_grams([one], width)[: width - 1])):
                ranges.setdefault(context, set()).add(p)
        assert all(len(r) == 1 for r in ranges.values())


def test_rare_words_are_sent_as_numbers_and_stored_in_groups(tmp_path):
    """Texts full of rare words: 8 bytes a word were sent, and 9 bytes stored for an n-gram."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 60_000, 999).tolist()) for _ in range(100)]
    batch, parts, folder = pa.RecordBatch.from_pydict({"text": texts}), 4, f"file://{tmp_path}/model"
    rows = [r for b in language_model._store_vocabulary(folder, parts)(language_model._send_words(parts)(iter([batch]))) for r in b.to_pylist()]
    table = shards.Table(folder, {r["part"]: r["file"] for r in rows}, parts, [])
    vocabulary = language_model.Vocabulary(table, {r["part"]: r["words"] for r in rows})
    assert vocabulary.bounds[-1] == len(set(" ".join(texts).split())) + 2
    sent = list(language_model._send_grams(parts, 3, vocabulary)(iter([batch])))
    grams = sum(len(c) for b in sent for cells in b.column("cells").to_pylist() for c in cells)
    assert grams < 8 * 100_000
    stored = [r for b in language_model._store_grams(folder, parts, 3, True, vocabulary)(iter(sent)) for r in b.to_pylist()]
    size = {kind: sum((tmp_path / "model" / r["file"]).stat().st_size for r in stored if r["kind"] == kind) for kind in ("shard", "context")}
    assert size["shard"] < 5 * 100_000 and size["context"] < 12 * 100_000


@given(st.dictionaries(st.integers(0, 2**64 - 1), st.dictionaries(st.integers(0, 2**33), st.integers(0, 300), min_size=1, max_size=9), max_size=90), st.integers(1, 4))
@settings(max_examples=30, deadline=None)
def test_members_of_groups(tmp_path_factory, groups, parts):
    folder = f"file://{tmp_path_factory.mktemp('members')}"
    keys = np.array(sorted(groups), np.uint64)
    part = packed.parts_of(keys, parts)
    names, place, offset = {}, np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for p, here in shards.by_part(part, parts):
        some = [sorted(groups[int(k)].items()) for k in keys[here]]
        first = np.cumsum([0, *map(len, some)])[:-1]
        flat = np.array([m for g in some for m in g], np.int64).reshape(-1, 2)
        names[p], offset[here] = shards.write_members(folder, "m", first, flat[:, 0].astype(np.uint64), flat[:, 1])
        place[here] = np.arange(len(here))
    asked = [(i, m) for i, k in enumerate(keys.tolist()) for near in groups[k] for m in (near, near + 1)]
    at, member = np.array(asked, np.int64).reshape(-1, 2).T
    size = np.array([len(groups[k]) for k in keys.tolist()], np.int64)
    found = shards.Members(folder, names, parts).look_up(part[at], place[at], offset[at], size[at], member.astype(np.uint64))
    assert found.tolist() == [groups[int(keys[i])].get(m, 0) for i, m in asked]


@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 5) | st.integers(2**64 - 9, 2**64 - 1), max_size=60))
@settings(deadline=None)
def test_order_by_upper_bits_and_place(values):
    values = np.array(values, np.uint64)
    assert packed.ascending(values).tolist() == np.argsort(values, kind="stable").tolist()
    known, place = packed.distinct(values)
    assert known.tolist() == sorted(set(values.tolist())) and (known[place] == values).all()


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


@pytest.mark.parametrize("order", [2, 3])
def test_sent_grams_take_little_more_memory_than_their_words(order):
    rng = np.random.default_rng(order)
    tokens = 600_000
    texts = [" ".join(map(str, rng.integers(0, 100_000, 999).tolist())) for _ in range(tokens // 1000)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    tracemalloc.start()
    sent = list(language_model._send_grams(50, order)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6 + 3 * 8 * order * tokens  # a block of texts, and the words
    *words, counts = language_model._unpacked_grams(sent, order)
    assert counts.sum() == tokens and len(set(zip(*map(np.ndarray.tolist, words)))) == len(counts)


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CODE_ROWS", 64)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 3)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(24).round(3).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(30)]  # ties with a query
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [None] + [1.0] * 23), (504, [float("nan")] + [1.0] * 23),
             (505, [float("inf")] + [1.0] * 23), (None, rows[3][1]), (550, [1.0, 2.0]), (551, [1.0, 2.0]), (600, [-0.0, 1.0]), (601, [5.0])]
    rows += [rows[7], rows[50]]
    fine = {i: v for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    want = []
    for q, v in fine.items():
        if q % 50 == 0:
            others = [(-cosine(v, x), i) for i, x in fine.items() if i != q and len(x) == len(v)]
            want += [(q, n + 1, i) for n, (_, i) in enumerate(sorted(others)[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(5)
    got = nearest.nearest(df, F.col("vec_id") % 50 == 0).collect()
    assert len(set(want) & {(r.query_id, r.rank, r.vec_id) for r in got}) >= 0.98 * len(want) and len(got) == len(want)
    assert all(r.score == pytest.approx(cosine(fine[r.query_id], fine[r.vec_id]), abs=1e-12) for r in got)
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_copies_neither_queries_nor_codes(spark, monkeypatch):
    """No block of queries is broadcast or shuffled for the blocks of codes that it meets, nor the other way round."""
    monkeypatch.setattr(nearest, "CODE_ROWS", 16)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 4)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 8))
    x[200:] = x[:100]  # more ids of the same vectors
    rows = [(i % 290, v) for i, v in enumerate(x.tolist())]  # and ids that come again with another vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    result = nearest.nearest(df, F.col("vec_id") % 7 == 0, k=3)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in result.collect()}
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    want = {}
    for q in sorted({i for i, _ in rows if i % 7 == 0}):
        best = {}
        for v in (v for i, v in rows if i == q):
            for i, y in rows:
                if i != q:
                    best[i] = max(best.get(i, -2.0), cosine(v, y))
        for rank, (score, i) in enumerate(sorted((-s, i) for i, s in best.items())[:3]):
            want[q, rank + 1] = (i, -score)
    assert got.keys() == want.keys()
    assert all(got[at][0] == i and got[at][1] == pytest.approx(s, abs=1e-12) for at, (i, s) in want.items())


@pytest.mark.parametrize("asked, blocks, tasks", [(1, 1, 8), (3, 200, 8), (40, 5, 8), (40, 500, 8), (5, 7, 1000)])
def test_every_block_of_queries_meets_every_block_of_codes_once(asked, blocks, tasks):
    queries = {(d, i): f"q{d}-{i}" for d in (2, 3) for i in range(asked)} | {(9, 0): "alone"}
    codes = {(d, i): f"c{d}-{i}" for d in (2, 3, 4) for i in range(blocks)}
    plan = nearest._Plan(queries, codes, tasks)
    met = [(q, c) for q, some in (plan[t] for t in range(plan.total)) for c in some]
    assert sorted(met) == sorted((f"q{d}-{i}", f"c{d}-{j}") for d in (2, 3) for i in range(asked) for j in range(blocks))
    assert max(len(plan[t][1]) for t in range(plan.total)) <= nearest.BLOCKS_AT_ONCE


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = {r.vec_id: list(map(float, r.embedding)) for r in df.collect()}
    x = np.array(list(rows.values()))
    ids = np.array(list(rows))
    got = {(r.query_id, r.vec_id) for r in nearest.nearest(df, F.col("vec_id") % 20 == 0, k=10).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = set()
    for q in np.flatnonzero(ids % 20 == 0):
        score = unit @ unit[q]
        score[q] = -2
        want |= {(int(ids[q]), int(ids[j])) for j in np.argsort(-score)[:10]}
    assert len(got & want) >= 0.9 * len(want)


def test_quality_counts_and_draw(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    fitted = quality.Resampler(docs, labels, seed=3)
    rows = {r.doc_id: r for r in fitted.decisions().collect()}
    assert len(rows) == docs.count()
    keys = sorted((r.key for r in rows.values()), reverse=True)
    assert sum(r.kept for r in rows.values()) == fitted.k == sum(r.log_weight >= fitted.cut for r in rows.values())
    assert all(r.kept == (r.key >= keys[fitted.k - 1]) for r in rows.values())
    good = {r.doc_id: r.quality for r in labels.collect()}
    kept_good = [rows[d].kept for d, q in good.items() if q == 1 and d in rows]
    kept_poor = [rows[d].kept for d, q in good.items() if q == 0 and d in rows]
    assert np.mean(kept_good) >= 0.95 and np.mean(kept_poor) <= 0.3
    noise = [r.key - r.log_weight for r in rows.values()]
    assert abs(np.mean(noise) - 0.5772) < 0.35 and len(set(noise)) == len(noise)
    drawn = fitted.drawn(docs.withColumn("_key", F.lit("x")).withColumn("c0", F.lit(0)))
    assert {r.doc_id for r in drawn.collect()} == {d for d, r in rows.items() if r.kept} and drawn.columns[-2:] == ["_key", "c0"]


def test_quality_weights_by_hand(spark):
    import pyarrow as pa

    ratio = np.arange(quality.BUCKETS) / 1000.0
    texts = ["Good words, good words!", None, "", "one"]
    block = next(quality.W.blocks(pa.array(texts), quality.W.LOWER, classes=quality.W.MARKS_APART))
    assert block.counts.tolist() == [6, 0, 0, 1]  # good words , good words !
    bucket, row = quality._buckets(block)
    assert np.bincount(row, minlength=4).tolist() == [11, 0, 0, 1]
    want = [sum(ratio[b] for b, r in zip(bucket, row) if r == i) for i in range(4)]
    assert quality._weights(block, ratio).tolist() == pytest.approx(want)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "e", "s", 3), (None, None, "e", None, None), (1, "a b", "e", "s", 3), (2, "", "e", "s", 0)], DOCS)
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0), (9, 1, None)], "doc_id long, quality int, toxic int")
    assert quality.resample(docs, none).count() == 4
    assert quality.resample(docs.limit(0), none).count() == 0
    both = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert sorted((r.doc_id, r.quality) for r in quality.fitting_labels(both).collect()) == [(1, 0), (2, 1)]
    assert quality.fitting_labels(both, 1).count() == 1


def insulting(spark, folder):
    """Tables with poor texts and with rare insults in texts of good quality; their labels."""
    rng = random.Random(6)
    insults = ["idiot", "clown", "pathetic"]
    rows, labels = [], []
    for d in range(900):
        w = [f"w{rng.randrange(300)}" for _ in range(80)]
        poor, toxic = d % 5 == 0, d % 6 == 1
        if poor:
            w = [f"junk{rng.randrange(40)}" for _ in range(80)]
        if toxic:
            w[rng.randrange(80)], w[rng.randrange(80)] = rng.sample(insults, 2)
        rows.append((d, " ".join(w) + ("!!" if d % 4 else ", Why?"), "en", "s", 1))
        if d % 7:
            labels.append((d, int(not poor), int(toxic)))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no such words in there")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, labels


def plain_quality(rows, labels, drop_toxic=True):
    return brute.quality([r[:2] for r in rows], labels, drop_toxic, quality.BUCKETS, quality.TOXIC_BUCKETS, quality.TOXIC_G2)


@pytest.mark.parametrize("drop_toxic", [True, False])
def test_quality_equals_plain_counts(spark, tmp_path, drop_toxic):
    """The whole method again: hashes, counts, ratio, both cuts, toxic words and the draw."""
    rows, labels = insulting(spark, tmp_path)
    want, odds = plain_quality(rows, labels, drop_toxic)
    docs, told = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.Resampler(docs, told, drop_toxic=drop_toxic).decisions().collect()}
    assert len(got) == len(want) and bool(odds) == drop_toxic
    assert {d: r.kept for d, r in got.items()} == {d: kept for d, (_, kept) in want.items()}
    assert all(r.log_weight == pytest.approx(want[d][0], abs=1e-9) for d, r in got.items())
    if drop_toxic:
        query = {r.doc_id: r.kept for r in QUERIES["op5_quality"](spark, str(tmp_path)).collect()}
        assert query == {d: r.kept for d, r in got.items()}


def test_pipeline_drops_toxic(spark, tmp_path):
    """The first stage equals the plain method with its toxic model, and so differs from that without."""
    rows, labels = insulting(spark, tmp_path)
    kept, without = ({d for d, (_, k) in plain_quality(rows, labels, drop)[0].items() if k} for drop in (True, False))
    toxic = {r[0] for r in rows if r[0] % 6 == 1}
    assert len(without & toxic) > 50 > len(kept & toxic)
    name, stage = corpus_pipeline.STAGES[0]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()} == kept
    final = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert final <= kept and len(final) > 0.8 * len(kept)


def test_quality_drops_toxic(spark, tmp_path):
    """Rare insults in texts of good quality: rows of the judging half, unseen by the models."""
    rows, labels = insulting(spark, tmp_path)
    kept = {r.doc_id for r in QUERIES["op5_quality"](spark, str(tmp_path)).where("kept").collect()}
    share = lambda ids: np.mean([d in kept for d in ids])
    good = [d for d, q, t in labels if q and not t]
    assert share([d for d, q, t in labels if t]) <= 0.05 and share(good) >= 0.95
    assert share([d for d, q, t in labels if not q]) <= 0.05


@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.data())
@settings(max_examples=6, deadline=None)
def test_kth_largest(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "key double")
    assert quality.kth_largest(df, k, bins=4) == sorted(values, reverse=True)[k - 1]


def test_best_cut():
    assert quality.best_cut(np.array([1.0, 2.0, 3.0, 4.0]), np.array([0, 0, 1, 1])) == 2.5
    assert quality.best_cut(np.array([1.0, 1.0]), np.array([0, 1])) == -np.inf
    assert quality.best_cut(np.array([5.0, 1.0, 0.0]), np.array([0, 1, 0])) in (0.5, 6.0)


def warc_rows(spark, rows, **options):
    staging = Staging(spark, "test")
    folder = staging.folder("archives")
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    archives.write_archives(df, folder, **options)
    read = archives.read_archives(spark, folder)
    return read, archives.resolved_records(staging, read)


@pytest.mark.parametrize("min_bytes,compression", [(0, "gzip"), (4, "none")])
def test_archives(spark, min_bytes, compression):
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n\u00e9"
    rows = [(5, "http://a/", tricky), (3, "http://b/\r\nX: y", tricky), (9, None, tricky), (1, "u", ""), (2, "u", None), (4, "u", "abc"),
            (6, "v", "abc"), (7, "u", "\r\n\r\n"), (8, "u", "long " * 50_000), (None, "n", "abcd"), (10, "m", "abcd"), (None, "n", "alone"),
            (11, "d", "twice"), (11, "d", "twice")]
    read, resolved = warc_rows(spark, rows, min_bytes=min_bytes, compression=compression)
    first = {}
    for p, _, h in rows:
        h = (h or "").encode()
        if p is not None and len(h) >= min_bytes:
            first[h] = min(first.get(h, p), p)
    want = []
    for p, _, h in rows:
        h = (h or "").encode()
        original = first.get(h, p)
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        want.append((p, len(h), digest, "response" if p == original else "revisit", None if p == original else original))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in resolved.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    back = {r.page_id: r for r in read.where("record_type = 'response'").collect()}
    assert bytes(back[3].payload).decode() == tricky and back[3].url == "http://b/%0D%0AX: y"
    assert len({r.record_id for r in read.collect()}) == len({(p, h or "") for p, _, h in rows})


def test_archives_of_a_null_page_id(spark):
    """It comes after all others: the response's own url is the one that revisits name."""
    rows = [(None, "http://null/", "same"), (5, "http://five/", "same"), (7, "http://seven/", "same")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.original, r.original_url) for r in archives.resolve(df, "page_id", "url", "html").collect()}
    assert got == {p: (5, "http://five/") for p in (None, 5, 7)}


def test_archives_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVES", ((10, 50), (1_000, 4)))
    sizes = [0, 5, 10, 11, 500, 1_000, 1_001, 9_000]
    rows = [(i, "u", "x" * (sizes[i % 8] - 4 if sizes[i % 8] > 9 else 0) + f"{i:04}") for i in range(160)]
    staging = Staging(spark, "test")
    folder = staging.folder("archives")
    archives.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    held = [
        [len(block) for _, block in archives._records_of(pa.py_buffer(bytes(r.content)))]
        for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect()
    ]
    assert sum(map(len, held)) == 160 and max(len(h) for h in held if h and max(h) > 1_081) == 1
    assert max(len(h) for h in held if h and 120 < max(h) <= 1_081) == 4
    read = archives.resolved_records(staging, archives.read_archives(spark, folder))
    assert sorted((r.page_id, r.payload_bytes) for r in read.collect()) == [(i, len(t)) for i, _, t in rows]


def test_archives_empty(spark):
    assert warc_rows(spark, [(1, "u", "x")])[0].limit(0).count() == 0
    staging = Staging(spark, "test")
    folder = staging.folder("archives")
    archives.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert archives.resolved_records(staging, archives.read_archives(spark, folder)).count() == 0


def threads(spark, rows, **options):
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    out = chat.format_threads(df.repartition(3), **options)
    return out.select(
        "tree", "leaf", "n_turns", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "loss_spans",
    ).collect()


def test_reply_trees(spark):
    nasty = "\\### assistant: </turn>\n\\b\\h < : \U0001f600"
    rows = [
        (1, 1, None, "user", nasty, 1.0), (1, 2, 1, "assistant", "a" + nasty, 0.5), (1, 3, 1, "assistant", "b", 3.0),
        (1, 4, 2, "user", None, None), (1, 5, 4, "assistant", "", 0.0), (1, 6, 3, "ro:le#<", "c", 1.0),
        (2, 1, 99, "user", "parent is missing", 0.0), (None, 1, None, None, "no tree", 0.0), (None, 2, 1, "assistant", "reply", 0.0),
        (3, 1, 2, "user", "cycle", 0.0), (3, 2, 1, "user", "cycle", 0.0), (4, 1, None, "user", "once", 0.0), (4, 1, None, "user", "once", 0.0),
        (5, None, None, "user", "no id", 0.0),
    ]
    got = {(r.tree, r.leaf): r for r in threads(spark, rows)}
    assert set(got) == {(1, 5), (1, 6), (2, 1), (None, 2), (4, 1)}
    assert [(t.role, t.text) for t in got[1, 5].turns] == [("user", nasty), ("assistant", "a" + nasty), ("user", ""), ("assistant", "")]
    assert got[1, 5].loss == "a" + nasty and got[1, 6].loss == "b" and got[None, 2].loss == "reply" and got[2, 1].loss == ""
    assert [t.role for t in got[1, 6].turns] == ["user", "assistant", "ro:le#<"] and got[None, 2].turns[0].role == ""
    best = {(r.tree, r.leaf) for r in threads(spark, rows, branches=1)}
    assert best == {(1, 6), (2, 1), (None, 2), (4, 1)}  # means: 0.375 and 1.667


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "</turn>", ""]), st.text("\\#<:/turn>bhlc \né\U0001f600", max_size=12)), min_size=1, max_size=9))
@settings(max_examples=5, deadline=None)
def test_template_is_reversible(spark, turns):
    rows = [(1, i + 1, i or None, role, text, 0.0) for i, (role, text) in enumerate(turns)]
    (r,) = threads(spark, rows)
    assert [(t.role, t.text) for t in r.turns] == turns and r.n_turns == len(turns)
    assert r.loss == "".join(t for role, t in turns if role == "assistant")


def test_long_thread_and_empty_table(spark):
    rows = [(1, i + 1, i or None, "user" if i % 2 else "assistant", f"t{i}", 0.0) for i in range(300)]
    (r,) = threads(spark, rows)
    assert r.n_turns == 300 and [t.text for t in r.turns] == [f"t{i}" for i in range(300)]
    assert r.loss == "".join(f"t{i}" for i in range(0, 300, 2))
    assert threads(spark, rows[:0]) == []


def targets(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    return {r.source: r for r in mixing.source_targets(Staging(spark, "test"), df, **options).collect()}


def filled(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        more = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= more


@given(st.dictionaries(st.sampled_from(["a", "b", "Z", "é", "\U0001f600", "", None, "z1", "z10"]), st.integers(0, 400), min_size=1))
@settings(max_examples=8, deadline=None)
def test_targets(spark, sizes):
    got = targets(spark, [(i, s, n) for i, (s, n) in enumerate(sizes.items())])
    want = filled(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes}
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)
    assert sum(r.target for r in got.values()) == pytest.approx(sum(sizes.values()))
    assert all(r.rate <= 3 for r in got.values())


def test_mix(spark):
    rng = random.Random(1)
    rows = [(d, "w " * rng.randrange(1, 9), "en", f"s{d % 5}", 1) for d in range(2000)]
    rows += [(2000, None, "en", "s1", None), (None, "x y", "en", None, 3), (1, "w w", "en", "s1", 3)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("copies", F.lit(0)).withColumn("rate", F.lit("r"))
    plan = mixing.mixture_plan(docs).collect()
    again = mixing.mixture_plan(docs.repartition(7)).collect()
    assert len(plan) == len(rows) and sorted(map(repr, plan)) == sorted(map(repr, again))
    taken, target = Counter(), {}
    for r in plan:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        assert 0 <= r.copies <= 3 and abs(r.copies - r.target / r.source_size) < 1
    assert all(abs(taken[s] - target[s]) < 0.15 * target[s] for s in target if s)
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in plan)
    clash = docs.withColumns({c: F.lit(c) for c in ("_rate", "__copy_number", "_copy", "_source", "c0")})
    again = mixing.mix(clash)
    assert again.columns == clash.columns and again.where("_rate = '_rate' AND __copy_number = '__copy_number'").count() == out.count()
    assert mixing.mix(docs.limit(0)).count() == 0


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == docs.columns
    kept = {r.doc_id for r in quality.Resampler(docs, labels).decisions().where("kept").collect()}
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in kept)
    lines = brute.line_repeats([r[:2] for r in rows])
    rows = [(d, lines[n], s) for n, (d, t, s) in enumerate(rows) if lines[n].strip() or not t.strip()]
    near = brute.near([r[:2] for r in rows])
    rows = [r for r in rows if near[r[0]][1] == r[0]]
    items = [(r.item_id, brute.words(r.text, brute.PLAIN)) for r in benchmark.collect()]
    leaking = {d for d, t, _ in rows for _, p in items if p and brute.fewest_edits(p, brute.words(t, brute.PLAIN))[0] <= len(p) // 10}
    rows = [r for r in rows if r[0] not in leaking]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    target = filled(sizes)
    copies = {}
    for d, _, s in rows:
        rate = min(target[s] / sizes[s], 3)
        draw = int(hashlib.md5(f"0:{d}".encode()).hexdigest()[:13], 16) / 2**52
        copies[d] = int(rate) + (draw < rate - int(rate))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter({(d, t): copies[d] for d, t, _ in rows if copies[d]})
    assert len(rows) < docs.count()
