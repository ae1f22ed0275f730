"""Substring, line and near dedup, decontamination: against brute force."""

import hashlib
import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.llm import components, decontaminate, line_dedup, near_dedup, substring_dedup, words
from tallyline.llm.workload import QUERIES
from tallyline.plans import Staging

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA).repartition(3)


def sentence(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Documents with copies, near copies, shared passages, blanks of all kinds, and edge cases."""
    rng = random.Random(5)
    passage = sentence(rng, 60)
    rows = []
    for d in range(60):
        kind = d % 6
        text = sentence(rng, rng.randrange(0, 90))
        if kind == 1:
            text = text + "\n" + passage + "\n" + sentence(rng, 20)
        if kind == 2 and d > 6:
            text = rows[d - 6][1]
        if kind == 3 and d > 6:
            w = rows[d - 6][1].split(" ")
            if len(w) > 40:
                w[len(w) // 2] = "changed"
            text = " ".join(w)
        if kind == 4:
            text = "first line\n  second line \n\nthird line\t\n" + text + "\nlast\nfirst line\nsecond line"
        rows.append((d, text))
    rows += [
        (100, None), (101, ""), (102, " \t\n\x0b\x0c\r "), (103, "one"), (104, "One"), (105, "a b c d"), (106, "a b c d"),
        (107, "É" * 50 + " " + passage + " x"), (108, "long " * 3000), (109, "long " * 2999), (110, "x" * 5000),
        (111, passage.replace(" ", "\r\n")), (112, "\U0001f600 " * 20), (113, "a\x00b " * 30),
    ]
    return rows


def test_words_and_windows():
    import pyarrow as pa

    texts = ["The cat  sat\ton THE mat", None, "", "x" * 1000 + " y", "É the"]
    block = next(words.blocks(pa.array(texts), words.LOWER))
    assert block.counts.tolist() == [6, 0, 0, 2, 2]
    assert block.hashes[0] == block.hashes[4] == block.hashes[9] and len(set(block.hashes.tolist())) == 8
    starts, hashes = words.windows(block.hashes, block.first, 2)
    assert starts.tolist() == [0, 1, 2, 3, 4, 6, 8] and len(set(hashes.tolist())) == 7


def test_long_text_is_hashed_in_pieces(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"word{i % 97}" for i in range(3000))
    whole = next(words.blocks(pa.array([text]), size=1 << 20))
    monkeypatch.setattr(words, "BLOCK", 500)
    cut = next(words.blocks(pa.array([text]), size=1 << 20))
    assert (whole.hashes == cut.hashes).all() and (whole.starts == cut.starts).all()


def test_cover_aligns_all_positions():
    for i in range(substring_dedup.PERIOD):
        for j in range(substring_dedup.PERIOD):
            assert any(
                (i + s) % substring_dedup.PERIOD in substring_dedup.COVER and (j + s) % substring_dedup.PERIOD in substring_dedup.COVER
                for s in range(substring_dedup.PERIOD)
            )


@pytest.mark.parametrize("chunk", [50, 3_000_000])
def test_substrings(spark, corpus, chunk, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_WORDS", chunk)
    got = substring_dedup.substring_dedup(frame(spark, corpus)).collect()
    want = brute.substrings(corpus)
    ids = {d: n for n, (d, _) in enumerate(corpus)}
    assert {ids[r.doc_id]: (r.n_words, r.n_removed, r.text) for r in got} == want
    assert sum(x[1] for x in want.values()) > 1000


def test_substrings_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(20))
    rows = [(None, text), (None, text), (1, text), (1, text), (1, text + " more"), (2, "x " + text), (2, text + " y")]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(frame(spark, rows)).collect())
    assert got == sorted([
        ("None", 20, 0), ("None", 20, 0), ("1", 20, 0), ("1", 20, 0), ("1", 21, 0), ("2", 21, 20), ("2", 21, 20),
    ])


def test_lines(spark, corpus):
    want = brute.line_repeats(corpus)
    got = {r.doc_id: r for r in line_dedup.line_dedup(frame(spark, corpus)).collect()}
    assert {d: got[d].text for d, _ in corpus} == {d: want[n] for n, (d, _) in enumerate(corpus)}
    assert sum(r.n_removed for r in got.values()) > 30


def test_line_edges(spark):
    rows = [(None, "a\nb"), (1, "a\n\n b "), (1, "a\n\n b "), (2, "b\na\nb\nc"), (3, None), (4, "a"), (5, "c\nd\nc\nd\nc\nd")]
    got = sorted((str(r.doc_id), r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(frame(spark, rows)).collect())
    assert got == sorted([
        ("None", "a\nb", 2, 0), ("1", "", 2, 2), ("1", "", 2, 2), ("2", "c", 4, 3), ("3", "", 0, 0), ("4", "", 1, 1),
        ("5", "d", 6, 5),
    ])


@pytest.mark.parametrize("single_words,window", [(1, 4), (1, 1), (3, 4), (3, 2), (1000, 3)])
def test_winnowing(spark, single_words, window, monkeypatch):
    """Runs of short lines, alone or among others, copies, hot lines and one long text."""
    monkeypatch.setattr(line_dedup, "WINDOW", window)
    rng = random.Random(window)
    lines = [" ".join(rng.choice("pqrst") for _ in range(rng.choice([1, 1, 2, 3, 5]))) for _ in range(30)]
    rows = []
    for d in range(60):
        text = [rng.choice(lines) if rng.random() < 0.5 else f"own {d} {i} words" for i in range(rng.randrange(12))]
        if d % 3 == 0:
            at = rng.randrange(len(lines) - 8)
            text[2:2] = lines[at : at + 8]
        rows.append((d, "\n".join([*text, "hot"])))
    rows += [(60, "\n".join(lines * 40)), (61, rows[7][1]), (62, rows[7][1] + "\nmore"), (63, None), (64, "\n \n")]
    want = brute.winnowed(rows, single_words, window)
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(frame(spark, rows).repartition(7), single_words).collect()}
    assert got == {d: want[n] for n, (d, _) in enumerate(rows)}
    if single_words == 1:
        assert want == brute.line_repeats(rows)


def test_single_lines(spark, corpus, tmp_path):
    """Lines between unlike neighbours, and texts of one line."""
    rng = random.Random(8)
    passage, notice = sentence(rng, 60), "All rights reserved by the makers of this."
    rows = [*corpus, (200, f"a1\n{passage}\nb1"), (201, f"a2\n {passage}\nb2"), (202, passage), (203, f"{notice}\nc1\n\n{notice}\nc2")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = {rows[n][0]: hashlib.sha256(t.encode()).hexdigest() for n, t in brute.line_repeats(rows).items()}
    for query in ("op10_line_dedup", "op10_single_lines"):
        got = {r.doc_id: r for r in QUERIES[query](spark, str(tmp_path)).collect()}
        assert {d: r.kept_sha256 for d, r in got.items()} == want
        assert [got[d].n_removed for d in (200, 201, 202, 203)] == [0, 1, 1, 1]


def test_dedup_documents_keeps_columns(spark, corpus):
    docs = frame(spark, corpus).withColumn("removed", F.lit(7)).withColumn("version", F.lit("v")).withColumn("n_lines", F.lit(1))
    out = line_dedup.dedup_documents(docs)
    assert out.columns == docs.columns
    want = brute.line_repeats(corpus)
    rows = {r.doc_id: r for r in out.collect()}
    for n, (d, text) in enumerate(corpus):
        if want[n].strip(" \t\r\v\f\n") or not (text or "").strip(" \t\r\v\f\n"):
            assert (rows[d].text or "") == want[n] and rows[d].removed == 7 and rows[d].version == "v"
            assert (rows[d].text is None) == (text is None)
            assert rows[d].n_chars == len(want[n])
        else:
            assert d not in rows


@pytest.mark.parametrize("small,depth", [(1024, 6), (2, 6), (2, 1)])
def test_near(spark, corpus, small, depth, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "DEPTH", depth)
    rng = random.Random(9)
    base = sentence(rng, 120, 5000).split(" ")
    rows = list(corpus)
    for d in range(200, 260):  # a large group of near copies, each unlike some others
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.random()}"
        rows.append((d, " ".join(w)))
    for d in range(300, 340):  # many that share half of their words
        rows.append((d, " ".join(base[:60]) + " " + sentence(rng, 60, 5000)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    want = {d: (n, c, c == d) for d, (n, c) in brute.near(rows).items()}
    assert got == want and sum(not x[2] for x in want.values()) > 50


def test_near_with_long_texts_in_a_node(spark, monkeypatch):
    """A node of few members is large by their shingles, and is branched."""
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    monkeypatch.setattr(near_dedup, "MEAN_SHINGLES", 16)
    rng = random.Random(4)
    base = sentence(rng, 900, 9000).split(" ")
    rows = []
    for d in range(30):
        w = list(base)
        for _ in range(rng.randrange(25)):
            w[rng.randrange(len(w))] = f"n{rng.random()}"
        rows.append((d, " ".join(w[: 900 - 20 * (d % 7)])))
    join = near_dedup._Join(frame(spark, rows))
    sizes = {r["size"] for r in join.shared(join.roots()).select("size").distinct().collect()}
    assert max(sizes) > 30 * 40
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {d: c for d, (_, c) in brute.near(rows).items()}


def test_keep_one_each(spark, corpus):
    rows = corpus + [corpus[1], corpus[1], (100, None), (None, "some words of no id at all"), (None, "some words of no id at all")]
    docs = frame(spark, rows).withColumn("kept", F.lit(1)).withColumn("component_id", F.lit("c")).withColumn("_v", F.lit(1))
    docs = docs.withColumn("_text_version", F.lit(2)).withColumn("__Text_version", F.lit(3))
    out = near_dedup.keep_one_each(docs.drop("_v"))
    want = {d for d, (_, c) in brute.near(corpus).items() if d == c} | {None}
    got = [r.doc_id for r in out.collect()]
    assert out.columns == docs.drop("_v").columns and len(got) == len(set(got)) and set(got) == want


def test_keep_one_each_of_null_and_shared_ids(spark):
    rng = random.Random(12)
    base = [sentence(rng, 100, 5000) for _ in range(3)]
    rows = [(None, f"{base[0]} {end}") for end in ("x", "y", "z")]  # no id in the whole component
    rows += [(5, f"{base[1]} {end}") for end in ("x", "y")] + [(9, base[1])]  # the smallest id twice
    rows += [(None, f"{base[2]} x"), (7, base[2])]
    rows += [(5, sentence(rng, 50, 5000)), (11, ""), (12, "")]
    out = [(r.doc_id, r.text) for r in near_dedup.keep_one_each(frame(spark, rows)).collect()]
    assert [sum(t.startswith(b) for _, t in out) for b in base] == [1, 1, 1] and len(out) == 6
    assert {d for d, t in out if t.startswith(base[1])} == {5} and {d for d, t in out if t.startswith(base[2])} == {7}


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=25))
@settings(max_examples=4, deadline=None)
def test_components(spark, links):
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "u long, v long")
    stars = components.star_forest(Staging(spark, "test"), df).collect()
    assert {r.v: r.u for r in stars} == {x: find(x) for x in parent if find(x) != x} and len(stars) == len({r.v for r in stars})


@given(st.lists(st.integers(0, 3), min_size=1, max_size=90), st.lists(st.integers(0, 3), max_size=120))
@settings(max_examples=200, deadline=None)
def test_myers(pattern, text):
    assert decontaminate.myers(np.array(pattern), np.array(text, np.int64)) == brute.fewest_edits(pattern, text)


def test_leaks(spark):
    rng = random.Random(3)
    items = [(i, sentence(rng, n, 3000)) for i, n in enumerate([1, 3, 5, 9, 10, 19, 20, 45, 80, 200])]
    items += [(20, None), (21, ""), (22, "--- !!"), (23, items[6][1]), (None, items[7][1])]
    docs = []
    for d in range(60):
        i = d % 10
        w = items[i][1].upper().split(" ") if d % 2 else items[i][1].split(" ")
        for _ in range(rng.randrange(max(2, 2 * len(w) // 10 + 1))):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], ["other"], [w[at], "more"]])
            if not w:
                w = ["gone"]
        docs.append((d, sentence(rng, 40, 3000) + "  " + ", ".join(w) + "\n" + sentence(rng, 30, 3000)))
    docs += [(100, None), (101, ""), (102, "plain text"), (None, items[8][1]), (103, items[9][1] * 40)]
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.leak_table(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute.leaks(docs, items)
    assert got == want and len({d for d, _ in want}) > 20 and max(want.values()) > 3


def test_decontaminate(spark):
    passage = " ".join(f"b{i}" for i in range(30))
    docs = frame(spark, [(1, "a " + passage + " z"), (1, "clean"), (2, "clean too"), (None, passage), (3, None), (2, "clean too")])
    out = decontaminate.decontaminate(docs.withColumn("_d", F.lit(1)), spark.createDataFrame([(5, passage)], "item_id long, text string"))
    assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text) == [("1", "clean"), ("2", "clean too"), ("2", "clean too")]
    assert out.count() == 4 and out.columns[-1] == "_d"
    assert decontaminate.decontaminate(docs, spark.createDataFrame([], "item_id long, text string")).count() == 6


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    assert substring_dedup.substring_dedup(docs).count() == 0
    assert line_dedup.line_dedup(docs).count() == line_dedup.dedup_documents(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == near_dedup.keep_one_each(docs).count() == 0
    assert decontaminate.leak_table(docs, spark.createDataFrame([(1, "x")], "item_id long, text string")).count() == 0
