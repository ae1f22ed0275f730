import json
import math
import time
from collections import Counter
from itertools import batched, permutations
from pathlib import Path

import numpy as np
import pytest
from test_text import first_set, texts

from tallyline.operators import bigrams, cooccurrence, reconcile
from tallyline.plans import blocks, staging


def as_lines(spark, given):
    rows = [(i // 7, i % 7, t) for i, t in enumerate(given)]
    return spark.createDataFrame(rows, "docno long, line_no int, text string")


def brute_pmi(given, min_count, limit):
    sets = [first_set(t, limit) for t in given]
    single = Counter(w for s in sets for w in s)
    pairs = Counter(p for s in sets for p in permutations(s, 2))
    return {
        (x, y): (n, math.log10(len(given) * n / (single[x] * single[y])))
        for (x, y), n in pairs.items() if n >= min_count
    }


@pytest.mark.parametrize("min_count, limit", [(1, 100), (10, 100), (10, 4), (1, None)])
def test_pmi_against_brute_force(spark, min_count, limit):
    given = texts(200)
    want = brute_pmi(given, min_count, limit)
    got = {(r.x, r.y): (r.n, r.pmi) for r in cooccurrence.pmi(as_lines(spark, given), min_count, limit).collect()}
    assert got.keys() == want.keys()
    for pair, (n, value) in want.items():
        assert got[pair][0] == n and got[pair][1] == pytest.approx(value, abs=1e-12)


def test_ten_lines_are_enough_nine_are_not(spark):
    given = ["p q"] * 9 + ["r s"] * 10 + ["t u"] * 11 + [""] * 5
    rows = cooccurrence.pmi(as_lines(spark, given)).collect()
    assert {(r.x, r.y): r.n for r in rows} == {("r", "s"): 10, ("s", "r"): 10, ("t", "u"): 11, ("u", "t"): 11}
    assert rows[0].pmi == pytest.approx(math.log10(35 * rows[0].n / rows[0].n ** 2))


@pytest.mark.parametrize("held,block", [(1 << 22, 256), (50, 3), (1, 1)])
def test_pmi_is_symmetric_and_stripes_hold_the_same(spark, monkeypatch, held, block):
    monkeypatch.setattr(cooccurrence, "HELD", held)
    monkeypatch.setattr(cooccurrence, "BLOCK", block)
    lines = as_lines(spark, texts(150))
    pmi = cooccurrence.pmi(lines, 3).cache()
    rows = {(r.x, r.y): r.pmi for r in pmi.collect()}
    assert all(rows[y, x] == v for (x, y), v in rows.items())
    stripes = cooccurrence.pmi_stripes(lines, 3, width=2)
    widest = max(len(r.stripe) for r in stripes.collect())
    assert widest < max(Counter(x for x, _ in rows).values())
    flat = cooccurrence.flatten_stripes(stripes)
    assert {(r.x, r.y): r.pmi for r in flat.collect()} == rows
    assert reconcile.reconcile(pmi, flat, ["x", "y"], "pmi").count() == 0
    stats = cooccurrence.pair_stats(pmi).first()
    assert stats.ordered_pairs == len(rows) == 2 * stats.unordered_pairs


def test_neighbors_and_top(spark):
    rows = [("a", "b", 1, 2.0), ("b", "a", 1, 2.0), ("a", "c", 1, 3.0), ("c", "a", 1, 3.0), ("a", "d", 1, 2.0)]
    pmi = spark.createDataFrame([(x, y, n, v, v) for x, y, n, v in rows], "x string, y string, n long, lift double, pmi double")
    assert [r.y for r in cooccurrence.neighbors(pmi, "a", "left", 2).collect()] == ["c", "b"]
    assert [r.x for r in cooccurrence.neighbors(pmi, "a", "right", 5).collect()] == ["c", "b"]
    assert [(r.x, r.y) for r in cooccurrence.top_pairs(pmi, 2).collect()] == [("a", "c"), ("a", "b")]
    with pytest.raises(ValueError):
        cooccurrence.neighbors(pmi, "a", "both")


def test_reconcile(spark):
    a = spark.createDataFrame([("k1", 1.0), ("k2", 1.231), ("k3", 1.23), ("k4", 2.0)], "k string, v double")
    b = spark.createDataFrame([("k1", 1.0), ("k2", 1.239), ("k3", 1.24), ("k5", 2.0)], "k string, v double")
    got = {r.k: r.status for r in reconcile.reconcile(a, b, ["k"], "v").collect()}
    assert got == {"k3": "mismatch", "k4": "missing", "k5": "extra"}


def test_bigram_forms(spark):
    lines = spark.createDataFrame([("",), ("a",), ("a b",), ("a b c",), ("a c a b",)], "text string")
    pairs = {(r.a, r.b): r.f for r in bigrams.bigram_freq(lines).collect()}
    assert pairs == {
        ("a", "*"): 3.0, ("b", "*"): 1.0, ("c", "*"): 1.0,
        ("a", "b"): 2 / 3, ("a", "c"): 1 / 3, ("b", "c"): 1.0, ("c", "a"): 1.0,
    }
    short = bigrams.bigram_freq(lines, min_tokens=2, with_marginal=False)
    rows = {(r.a, r.b): r.f for r in short.collect()}
    assert rows == {("a", "b"): 3 / 4, ("a", "c"): 1 / 4, ("b", "c"): 1.0, ("c", "a"): 1.0}
    stripes = {r.a: r.stripe for r in bigrams.bigram_stripes(lines).collect()}
    assert stripes["a"] == {"b": 3 / 4, "c": 1 / 4}


def test_bigram_counts_are_shuffled_once(spark):
    lines = spark.createDataFrame([("a b c",)], "text string")
    df = bigrams.bigram_freq(lines)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan or "ReusedQueryStage" in plan


def test_long_lines_are_cut_into_blocks(spark):
    words = [chr(97 + i % 26) + chr(97 + i // 26 % 26) + chr(97 + i // 676) for i in range(600)]
    given = [" ".join(words), " ".join(words[:300]), " ".join(words[200:]), "aaa"]
    got = {(r.x, r.y): r.n for r in cooccurrence.cooccur(as_lines(spark, given)).collect()}
    want = Counter(p for t in given for p in permutations(set(t.split()), 2))
    assert got == want


def test_close_pairs_are_told_apart(spark):
    rows = [("a", y, 1, 1.0 + i * 1e-12, 0.0) for i, y in enumerate("bcd")]
    pmi = spark.createDataFrame(rows, "x string, y string, n long, lift double, pmi double")
    assert [r.y for r in cooccurrence.top_pairs(pmi, 3).collect()] == ["d", "c", "b"]


@pytest.mark.parametrize("held", [1 << 22, 7])
def test_pairs_are_counted_in_tiles_of_bands(spark, monkeypatch, held):
    """No pair is shuffled: what is shuffled does not grow with the square of a line's words."""
    monkeypatch.setattr(cooccurrence, "FEW", 1)
    monkeypatch.setattr(cooccurrence, "BLOCK", 5)
    monkeypatch.setattr(cooccurrence, "HELD", held)
    given = texts(150) + [" ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400))]
    lines = as_lines(spark, given)
    vocabulary, _ = cooccurrence._vocabulary(lines, 1, None)
    starts = cooccurrence._bands(vocabulary)
    assert len(starts) - 1 > 8 and starts == sorted(set(starts)) and starts[-1] == vocabulary.count()
    tiles = cooccurrence._tiles(lines, vocabulary, starts, None).collect()
    occurrences = sum(len(first_set(t, None)) for t in given)
    assert sum(len(r.words) for r in tiles) <= 2 * cooccurrence.BANDS * occurrences
    want = Counter(p for t in given for p in permutations(first_set(t, None), 2))
    assert {(r.x, r.y): r.n for r in cooccurrence.cooccur(lines).collect()} == want
    flat = cooccurrence.flatten_stripes(cooccurrence.pmi_stripes(lines, 2, width=7))
    assert {(r.x, r.y) for r in flat.collect()} == {p for p, n in want.items() if n >= 2}


def test_words_are_stored_once_however_many_bands(spark, monkeypatch):
    """Tiles read their bands' words from files: nothing is shuffled for them, and more bands hold no more words."""
    monkeypatch.setattr(cooccurrence, "FEW", 1)
    monkeypatch.setattr(cooccurrence, "BLOCK", 3)
    monkeypatch.setattr(cooccurrence, "UNIT", 20)
    monkeypatch.setattr(cooccurrence, "FILE", 1500)
    monkeypatch.setattr(cooccurrence, "NAMES", 4)
    given = texts(150)
    lines = as_lines(spark, given)
    vocabulary, _ = cooccurrence._vocabulary(lines, 2, None)
    single = Counter(w for t in given for w in first_set(t, None))
    for tile in (1 << 26, 40):
        monkeypatch.setattr(cooccurrence, "TILE", tile)
        starts = cooccurrence._bands(vocabulary)
        tiles = cooccurrence._tiles(lines, vocabulary, starts, None)
        assert "Exchange" not in tiles._jdf.queryExecution().executedPlan().toString()
        rows = tiles.collect()
        bands = len(starts) - 1
        assert sorted(tuple(r.words) for r in rows) == sorted((*starts[g : g + 2], *starts[h : h + 2]) for g in range(bands) for h in range(g, bands))
        listing = json.loads(blocks.read_file(rows[0].folder, rows[0].listing).tobytes())
        stored, units = 0, 0
        for file in listing["files"]:
            for part in blocks.read_parts(rows[0].folder, file, range(bands)):
                for cells in batched(cooccurrence._cells(part), 3):
                    units += 1
                    stored += int(cooccurrence._unpacked(cells[1], int(np.frombuffer(cells[0], "<i8")[0])).sum())
        assert stored == sum(n for n in single.values() if n >= 2)
        assert units > bands * len(listing["files"]) > bands
        got = {(r.x, r.y): r.n for r in cooccurrence.cooccur(lines, 2).collect()}
        pairs = Counter(p for t in given for p in permutations(first_set(t, None), 2))
        assert got == {p: n for p, n in pairs.items() if n >= 2}
    assert bands > 10


def test_pairs_are_named_in_their_tile(spark):
    """No pair is shuffled for the names and counts of its words, nor for its place in a stripe."""
    lines = as_lines(spark, texts(60))
    for made in (cooccurrence.pmi(lines, 2), cooccurrence.pmi_stripes(lines, 2, width=7)):
        made.collect()
        above = made._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
        assert "Exchange" not in above and "Join" not in above


@pytest.mark.parametrize("held", [1 << 22, 5])
def test_rows_of_one_line_are_one_line(spark, monkeypatch, held):
    """Lines whose key repeats, or is null, are counted with the words of all their rows."""
    monkeypatch.setattr(cooccurrence, "HELD", held)
    monkeypatch.setattr(cooccurrence, "FEW", 1)
    given = [(1, 0, "a b c"), (1, 0, "b d"), (None, 0, "a d"), (None, 0, "c e"), (2, 0, "a b"), (3, 1, None), (3, 1, "e"), (4, 0, "")]
    lines = spark.createDataFrame(given, "docno long, line_no int, text string")
    want = Counter()
    for words in ("abcbd", "adce", "ab", "e"):
        want.update(permutations(words, 2))
    stats = {(r.x, r.y): r.n for r in cooccurrence.cooccur(lines).where("x != y").collect()}
    assert stats == {p: n for p, n in want.items() if p[0] != p[1]}
    flat = cooccurrence.flatten_stripes(cooccurrence.pmi_stripes(lines, 1, width=2))
    single = Counter(w for _, _, t in given if t for w in t.split())
    assert {(r.x, r.y): pytest.approx(r.pmi) for r in flat.collect()} == {
        (x, y): math.log10(len(given) * n / (single[x] * single[y])) for (x, y), n in want.items()
    }


def test_staging_drops_its_shuffles(spark):
    """Their files do not wait for the driver's garbage collection; later queries keep what the session says."""
    before = spark.conf.get(staging.CLEANUP)
    with staging.shuffles_dropped(spark):
        assert spark.conf.get(staging.CLEANUP) == "true"
    assert spark.conf.get(staging.CLEANUP) == before
    store = staging.Staging(spark, "test")
    folder = store.folder("plain")

    def files():
        root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return root.getAllFiles().mkString("\n").count("shuffle_")

    shuffled = spark.range(1000).repartition(4, "id")
    start = files()
    shuffled.write.parquet(folder)
    plain = files()
    assert plain > start
    kept = store.keep(shuffled)
    for _ in range(50):
        if files() <= plain:
            break
        time.sleep(0.1)
    assert files() <= plain and kept.count() == 1000


def test_reconcile_of_stored_tables(spark):
    """Each side stored by its keys gives the same rows, repeated and null keys included, and shuffles nothing more."""
    a = spark.createDataFrame([("k1", 1.0), ("k2", 1.231), ("k3", 1.23), ("k4", 2.0), ("k4", 3.0), (None, 1.0)], "k string, v double")
    b = spark.createDataFrame([("k1", 1.0), ("k2", 1.239), ("k3", 1.24), ("k4", 2.0), ("k5", 2.0), (None, 1.0)], "k string, v double")
    stored = reconcile.reconcile(a, b, ["k"], "v", store=True)
    assert Counter(stored.collect()) == Counter(reconcile.reconcile(a, b, ["k"], "v").collect())
    assert "Exchange" not in stored._jdf.queryExecution().executedPlan().toString()


def test_reconcile_compares_a_part_of_the_keys_at_a_time(spark, monkeypatch):
    """Of keys of two types as well; each part of the sides is gone once it is compared."""
    sizes = []
    drop = staging.Staging.drop_partition

    def dropped(store, table, *part):
        drop(store, table, *part)
        sizes.append(sum(f.stat().st_size for f in Path(store.root.removeprefix("file:")).glob("*-[ab]/*/*.parquet")))

    monkeypatch.setattr(staging.Staging, "drop_partition", dropped)
    a = spark.createDataFrame([(i if i % 9 else None, i % 4, float(i % 7)) for i in range(400)], "k int, j int, v double")
    b = spark.createDataFrame([(float(i) if i % 9 else -0.0, i % 4, float(i % 5)) for i in range(-2, 300)], "k double, j int, v double")
    a = a.unionAll(spark.createDataFrame([(0, 1, 1.0)], a.schema))
    stored = reconcile.reconcile(a, b, ["k", "j"], "v", store=True)
    plain = reconcile.reconcile(a, b, ["k", "j"], "v")
    assert stored.schema == plain.schema and Counter(stored.collect()) == Counter(plain.collect())
    assert len(sizes) == 2 * reconcile.TURNS and sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1] == 0
