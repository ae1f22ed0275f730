import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import bitmap_search, boolean_search, inverted_index
from tallyline.sources import index_store


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "a b b"), (2, "a c"), (300, "b c c c"), (301, "d a"), (900, "a b c d")]
    return spark.createDataFrame(rows, "docno long, text string")


@pytest.fixture(scope="module")
def postings(docs):
    return inverted_index.term_freq(docs).cache()


def test_term_freq_and_index(postings):
    rows = {(r.term, r.docno): r.tf for r in postings.collect()}
    assert rows["b", 1] == 2 and rows["c", 300] == 3 and len(rows) == 12
    index = {(r.term, r.block): (r.df, [tuple(p) for p in r.postings])
             for r in inverted_index.build_index(postings, 256).collect()}
    assert index["a", 0] == (4, [(1, 1), (2, 1)])
    assert index["a", 1] == (4, [(301, 1)]) and index["a", 3] == (4, [(900, 1)])


@pytest.mark.parametrize("span", [1, 2, 256, 65_536])
def test_gaps_round_trip(spark, span):
    rng = random.Random(span)
    rows = [(t, d, rng.randint(1, 9)) for t in "pqr" for d in rng.sample(range(2_000), 60)]
    postings = spark.createDataFrame(rows, "term string, docno long, tf int")
    encoded = inverted_index.encode_gaps(postings, span).cache()
    lists = {t: sorted(d for u, d, _ in rows if u == t) for t in "pqr"}
    got = {t: [r.gap for r in encoded.where(F.col("term") == t).orderBy("block", "pos").collect()] for t in "pqr"}
    assert got == {t: [b - a for a, b in zip([0, *ds], ds)] for t, ds in lists.items()}
    back = sorted(tuple(r) for r in inverted_index.decode_gaps(encoded).collect())
    assert back == sorted(rows)


CASES = {
    "a b AND": {1, 900}, "a b OR": {1, 2, 300, 301, 900}, "a b AND c OR": {1, 2, 300, 900},
    "a b c AND OR": {1, 2, 300, 301, 900}, "zzz": set(), "a zzz OR": {1, 2, 301, 900},
    "a zzz AND": set(), "A a AND": set(), "b a": {1, 2, 301, 900}, " d ": {301, 900},
    "a a AND": {1, 2, 301, 900},
}


@pytest.mark.parametrize("query", CASES)
def test_search(postings, query):
    assert {r.docno for r in boolean_search.search(postings, query).collect()} == CASES[query]


def test_search_batch(spark, postings):
    queries = spark.createDataFrame([(q, q) for q in CASES], "query_id string, query string")
    got = {q: set() for q in CASES}
    for r in boolean_search.search_batch(postings, queries).collect():
        got[r.query_id].add(r.docno)
    assert got == CASES


@pytest.fixture(scope="module")
def bitmaps(postings):
    return {dense: bitmap_search.bitmap_index(postings, dense).cache() for dense in (1, 2, 128)}


@pytest.mark.parametrize("dense", [1, 2, 128])
@pytest.mark.parametrize("query", CASES)
def test_search_on_bitmaps(bitmaps, query, dense):
    assert sorted(r.docno for r in bitmap_search.search(bitmaps[dense], query).collect()) == sorted(CASES[query])


def test_bitmaps_of_many_ranges(spark):
    """Numbers below 0 and at the ends of ranges, terms in every document, repeated postings."""
    rng = random.Random(3)
    span = bitmap_search.SPAN
    numbers = {-2 * span, -span, 1 - span, -1, 0, 1, span - 1, span, span + 1, 5 * span} | {rng.randrange(-span, 4 * span) for _ in range(3_000)}
    of = {"all": numbers, "half": {n for n in numbers if n % 2}, "few": set(rng.sample(sorted(numbers), 20)), "one": {span}}
    rows = [(t, n, 1) for t, ns in of.items() for n in ns] + [("few", min(of["few"]), 1), ("all", None, 1)]
    index = bitmap_search.bitmap_index(spark.createDataFrame(rows, "term string, docno long, tf int")).cache()
    kinds = {(r.term, r.bits is not None) for r in index.collect()}
    assert ("all", True) in kinds and ("one", False) in kinds and ("one", True) not in kinds
    found = lambda q: {r.docno for r in bitmap_search.search(index, q).collect()}
    assert found("all") == numbers and found("half few AND") == of["half"] & of["few"]
    assert found("few one OR half AND all AND") == (of["few"] | of["one"]) & of["half"]
    assert {r.term: r.df for r in bitmap_search.document_frequency(index).collect()} == {t: len(ns) for t, ns in of.items()}


@pytest.mark.parametrize("query", ["AND", "a AND", "", "a b AND OR"])
def test_malformed(postings, bitmaps, query):
    for module, index in ((boolean_search, postings), (bitmap_search, bitmaps[2])):
        with pytest.raises(ValueError):
            module.search(index, query)


def test_malformed_in_a_batch(spark, postings):
    queries = spark.createDataFrame([("q", "a AND")], "query_id string, query string")
    with pytest.raises(Exception, match="needs two operands"):
        boolean_search.search_batch(postings, queries).collect()


def test_only_the_query_terms_are_read(spark, postings, tmp_path):
    from tallyline.sources import read_index, write_index

    write_index(postings, str(tmp_path / "index"))
    df = boolean_search.search(read_index(spark, str(tmp_path / "index")), "a b AND")
    assert "In(term, [a,b])" in df._jdf.queryExecution().executedPlan().toString()


def test_fetch_and_shorten(spark, docs, postings):
    fetched = boolean_search.fetch(boolean_search.search(postings, "d"), docs)
    assert {r.line for r in boolean_search.result_lines(fetched).collect()} == {"301\td a", "900\ta b c d"}
    df = spark.createDataFrame([("x" * 80,), ("x" * 81,)], "text string")
    assert [r[0] for r in df.select(boolean_search.shortened("text")).collect()] == ["x" * 80, "x" * 80 + "..."]


def test_gaps_go_on_over_ranges(spark):
    """Postings are shuffled once, and a list or term cut by ranges continues from the earlier ones."""
    rows = [("the", d, 1 + d % 3) for d in range(3, 4000)] + [(f"w{d % 700}", d, 1) for d in range(4000)] + [("the", None, 1), ("only", None, 2)]
    postings = spark.createDataFrame(rows, "term string, docno long, tf int")
    encoded = inverted_index.encode_gaps(postings, 64)
    assert encoded._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 0
    last, place, want = {}, {}, []
    for term, docno, tf in sorted((r for r in rows if r[1] is not None)):
        block = docno // 64
        place[term, block] = place.get((term, block), 0) + 1
        before = last.get(term, None if term == "the" else 0)  # after a posting without number
        want.append((term, block, place[term, block], None if before is None else docno - before, tf))
        last[term] = docno
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in encoded.collect()), key=key) == sorted(want, key=key)
    numbered = postings.where("docno IS NOT NULL")
    back = inverted_index.decode_gaps(inverted_index.encode_gaps(numbered, 64))
    assert sorted(tuple(r) for r in back.collect()) == sorted(r for r in rows if r[1] is not None)


def test_range_partitioner_does_not_count_terms_again(spark, tmp_path):
    """The index's rows are made once; the sample is taken of stored ones."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(i, f"a b c{i % 7}") for i in range(500)], "docno long, text string")
    index_store.write_index(inverted_index.term_freq(docs).mapInArrow(count, "term string, docno long, tf int"), str(tmp_path / "i"))
    assert seen.value == 1500  # a, b and c of each
