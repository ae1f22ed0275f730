"""The registered queries: every operator applied to whole given tables.

Parameters are fixed in the callables.  Doubles are rounded where the order of
a sum, or the last bit of a logarithm, may differ between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import tokens
from .operators import (
    bitmap_search, bigrams, boolean_search, cooccurrence, counting, evaluation, inverted_index,
    linear_classifier, pagerank, reconcile, star,
)
from .plans import Staging
from .plans.durable import checkpointed
from .plans.rows import explode_counts
from .sources.documents import document_lines, number_lines, read_labeled, read_lines
from .sources.graphs import read_adjacency
from .sources.index_store import read_index, write_index
from .sources.models import read_models, read_predictions, write_model
from .sources.tables import SCHEMAS, load_tables, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

STAR = ("lineitem", "orders", "customer", "part", "supplier", "nation")
LABELS = {3: "NATION_3", 24: "NATION_24"}
SEARCH_BATCH = (
    ("nested", "the of AND de OR"), ("narrow", "the and AND de AND"), ("wide", "les un OR der OR"),
    ("unknown", "the zzzunknown AND"), ("upper", "THE the OR"), ("extra", "the of de"),
)
SUPPLIER_1, SUPPLIER_2, PART_3 = 4, 8, 13
INDEX_SPAN = 256
SHARD_DOCS, RUNS = 100, 10


def _round(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- star schema ---------------------------------------------------------


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return load_tables(spark, sf, STAR)


def _q6(spark: SparkSession, sf: str) -> DataFrame:
    summary = star.pricing_summary(_star(spark, sf), "1998-03")
    money = _round(summary, 2, "sum_qty", "sum_base_price", "sum_charge")
    return _round(money, 4, "sum_disc_price").transform(
        lambda d: _round(d, 6, "avg_qty", "avg_price", "avg_disc")
    )


def _q7(date: str) -> Query:
    return lambda spark, sf: _round(star.top_revenue(_star(spark, sf), date, "o_orderpriority"), 4, "revenue")


def _q3_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """The tables written as delimited files, read back, then Q3."""
    folder = Staging(spark, "delimited").folder("tables")
    for name in ("lineitem", "part", "supplier"):
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        fields = [f.strip().split(" ") for f in SCHEMAS[name].split(",")]
        columns = [
            (F.col(c) if c in table.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields
        ]
        table.select(*columns).write.csv(f"{folder}/{name}.tbl", sep="|")
    return star.parts_and_suppliers(load_tables(spark, folder, ("lineitem", "part", "supplier"), "tbl"), "1998-03-15")


# --- text ----------------------------------------------------------------


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return docs.withColumnRenamed("doc_id", "docno")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return document_lines(_docs(spark, sf))


def _pmi(spark: SparkSession, sf: str, max_tokens: int | None = None) -> DataFrame:
    return cooccurrence.pmi(_lines(spark, sf), 10, max_tokens)


def _pmi_rows(pmi: DataFrame) -> DataFrame:
    return _round(pmi.select("x", "y", "n", "pmi"), 9, "pmi")


def _text_lines(spark: SparkSession, sf: str) -> str:
    """The documents' lines as text files; their folder."""
    folder = Staging(spark, "lines").folder("text")
    _lines(spark, sf).select("text").write.text(folder)
    return folder


def _line_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of text files by length, written as tab-separated text and read back."""
    lines = read_lines(spark, _text_lines(spark, sf))
    folder = Staging(spark, "lengths").folder("tsv")
    write_table(lines.groupBy(F.length("text").alias("chars")).agg(F.count("*").alias("n")), folder, "tsv")
    return read_table(spark, folder, schema="chars int, n bigint", sep="\t")


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    """(n, numbers, first, last) of the numbers given to the lines of text files."""
    docs = number_lines(spark, _text_lines(spark, sf), Staging(spark, "numbered").folder("lines"))
    return docs.agg(
        F.count("*").alias("n"), F.count_distinct("docno").alias("numbers"),
        F.min("docno").alias("first"), F.max("docno").alias("last"),
    )


def _pmi_stripes(spark: SparkSession, sf: str) -> DataFrame:
    stripes = cooccurrence.pmi_stripes(_lines(spark, sf), width=1000)
    return _round(cooccurrence.flatten_stripes(stripes), 9, "pmi")


def _pmi_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs against stripes, two computations of their own: no row, as both hold the same."""
    rows = _pmi(spark, sf).withColumn("pmi", F.round("pmi", 9))
    return reconcile.reconcile(rows, _pmi_stripes(spark, sf), ["x", "y"], "pmi", store=True)


def _pmi_reconcile_first100(spark: SparkSession, sf: str) -> DataFrame:
    """Whole lines against their first 100 tokens."""
    whole, first = (_pmi(spark, sf, n).withColumn("pmi", F.round("pmi", 9)) for n in (None, 100))
    return reconcile.reconcile(whole, first, ["x", "y"], "pmi", store=True)


def _bigram_stripes(spark: SparkSession, sf: str) -> DataFrame:
    return bigrams.bigram_stripes(_lines(spark, sf), width=1000)


def _bigram_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    pairs = bigrams.bigram_freq(_lines(spark, sf))
    flat = _bigram_stripes(spark, sf).select("a", F.explode("stripe").alias("b", "f"))
    return reconcile.reconcile(pairs, flat, ["a", "b"], "f")


def _map_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Term counts of each document, as maps, summed per source of documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    words = docs.select("doc_id", "source", tokens("text").alias("words"))
    freq = explode_counts(words, "words", "term", "tf", "source", "doc_id")
    maps = freq.groupBy("source", "doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "tf"))).alias("stripe")
    )
    return counting.map_sum(maps, "source")


# --- index ---------------------------------------------------------------


def _postings(spark: SparkSession, sf: str) -> DataFrame:
    return inverted_index.term_freq(_docs(spark, sf))


# Indexes of this session that queries share, by application, kind and the files they are made of.
_INDEXES: dict[tuple, str] = {}


def _build(spark: SparkSession, sf: str, kind: str) -> str:
    path = Staging(spark, "index").folder(kind)
    postings = _postings(spark, sf)
    if kind == "bitmaps":
        return write_index(bitmap_search.bitmap_index(postings), path, key=("term", "range"))
    return write_index(postings, path)


def _index_key(spark: SparkSession, sf: str, kind: str) -> tuple:
    return (spark.sparkContext.applicationId, kind, *sorted(_docs(spark, sf).inputFiles()))


def _stored(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """The index of the documents, built by the first query that needs it."""
    key = _index_key(spark, sf, kind)
    if key not in _INDEXES:
        _INDEXES[key] = _build(spark, sf, kind)
    return read_index(spark, _INDEXES[key])


def _index_build(kind: str) -> Query:
    """(term, df) of an index built anew, which later queries use."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        _INDEXES[_index_key(spark, sf, kind)] = _build(spark, sf, kind)
        index = _stored(spark, sf, kind)
        return (bitmap_search if kind == "bitmaps" else inverted_index).document_frequency(index)

    return query


def _index_table(spark: SparkSession, sf: str) -> DataFrame:
    """(version, term, df): the index as a table, of the documents, then also of the benchmark's items.

    The first version's reader is resolved before the second is written, and
    read after it.
    """
    table = f"tallyline_index_{uuid.uuid4().hex}"
    postings = checkpointed(_postings(spark, sf))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select((-1 - F.col("item_id")).alias("docno"), "text")
    write_index(postings, table=table, versions=Staging(spark, "index").folder("versions"), stored=True)
    first = read_index(spark, table=table)
    write_index(postings.unionByName(inverted_index.term_freq(items)), table=table, stored=True)
    second = read_index(spark, table=table)
    both = first.select(F.lit(1).alias("version"), "term").unionAll(second.select(F.lit(2).alias("version"), "term"))
    spark.sql(f"DROP TABLE {table}")  # its files stay till the application ends
    return both.groupBy("version", "term").agg(F.count("*").alias("df"))


def _index_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """The postings, as gaps and back."""
    return inverted_index.decode_gaps(checkpointed(inverted_index.encode_gaps(_postings(spark, sf), INDEX_SPAN)))


def _index(spark: SparkSession, sf: str) -> DataFrame:
    blocks = inverted_index.build_index(_postings(spark, sf), INDEX_SPAN)
    return blocks.select("term", "df", "block", F.inline("postings"))


def _search(query: str) -> Query:
    return lambda spark, sf: bitmap_search.search(_stored(spark, sf, "bitmaps"), query)


def _search_batch(spark: SparkSession, sf: str) -> DataFrame:
    queries = spark.createDataFrame(list(SEARCH_BATCH), "query_id string, query string")
    return boolean_search.search_batch(_stored(spark, sf, "postings"), queries)


def _search_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """Documents holding all words of a benchmark passage, for every passage."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.array_distinct(tokens("text")).alias("words")
    )
    operators = F.repeat(F.lit(" AND"), F.size("words") - 1)
    queries = items.where(F.size("words") > 0).select(
        "query_id", F.concat(F.array_join("words", " "), operators).alias("query")
    )
    return boolean_search.search_batch(_stored(spark, sf, "postings"), queries)


def _search_fetch(limit: int | None) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        hits = bitmap_search.search(_stored(spark, sf, "bitmaps"), "the of AND de OR")
        return boolean_search.result_lines(boolean_search.fetch(hits, _docs(spark, sf)), limit)

    return query


# --- graph ---------------------------------------------------------------


def supply_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers, parts and nations; one edge per shipped lineitem from supplier
    to part, one back per returned lineitem, one from supplier to nation.

    Nations have no out-edges.  Repeated lineitems are repeated edges.  Ids are
    4 * key plus 0 for suppliers, 1 for parts, 2 for nations.
    """
    t = load_tables(spark, sf, ("lineitem", "supplier", "nation"))
    supplier, part = F.col("l_suppkey") * 4, F.col("l_partkey") * 4 + 1
    nation = F.col("n_nationkey").cast("bigint") * 4 + 2
    nodes = _goods_nodes(spark, sf).union(t["nation"].select(nation))
    edges = (
        t["lineitem"].select(supplier.alias("src"), part.alias("dst"))
        .union(t["lineitem"].where("l_returnflag = 'R'").select(part, supplier))
        .union(t["supplier"].select(
            F.col("s_suppkey") * 4, F.col("s_nationkey").cast("bigint") * 4 + 2
        ))
    )
    return nodes, edges


def _goods_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers and parts only: edges to nations then lead to absent nodes."""
    t = load_tables(spark, sf, ("supplier", "part"))
    return t["supplier"].select((F.col("s_suppkey") * 4).alias("id")).union(
        t["part"].select(F.col("p_partkey") * 4 + 1)
    )


def _graph_validate(spark: SparkSession, sf: str) -> DataFrame:
    """A faulty node list: no nations, suppliers in debt listed twice."""
    in_debt = spark.read.parquet(f"{sf}/supplier.parquet").where("s_acctbal < 0")
    listed = _goods_nodes(spark, sf).union(in_debt.select(F.col("s_suppkey") * 4))
    return pagerank.validate_graph(listed, supply_graph(spark, sf)[1])


def _ppr(sources: list[int], iterations: int) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        nodes, edges = supply_graph(spark, sf)
        ranks = pagerank.pagerank(nodes, edges, sources, iterations)
        return _round(pagerank.dense_ranks(ranks, nodes, sources), 10, "p")

    return query


def _ppr_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Two iterations stored as snapshots, then resumed for a third."""
    nodes, edges = supply_graph(spark, sf)
    sources = [SUPPLIER_1, SUPPLIER_2, PART_3]
    base = Staging(spark, "ranks").folder("snapshots")
    pagerank.pagerank(nodes, edges, sources, 2, base=base)
    ranks = pagerank.pagerank(nodes, edges, sources, 3, start=2, base=base)
    return _round(pagerank.dense_ranks(ranks, nodes, sources), 10, "p")


def _ppr_top(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = supply_graph(spark, sf)
    ranks = pagerank.pagerank(nodes, edges, [SUPPLIER_1, PART_3], 3)
    return _round(pagerank.top_nodes(ranks, 20), 10, "p")


def _ppr_mass(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = supply_graph(spark, sf)
    ranks = pagerank.pagerank(nodes, edges, [SUPPLIER_1, PART_3], 2)
    return _round(pagerank.mass_balance(ranks, nodes, edges), 10, "mass", "missing")


def _ppr_adjacency(spark: SparkSession, sf: str) -> DataFrame:
    """The graph written as adjacency lists, read back, then ranked."""
    nodes, edges = supply_graph(spark, sf)
    out = edges.groupBy(F.col("src").alias("id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("dst")), lambda d: d.cast("string")), " ").alias("to")
    )
    line = F.concat_ws(" ", F.col("id").cast("string"), "to")
    folder = Staging(spark, "adjacency").folder("lists")
    nodes.join(out, "id", "left").select(line.alias("value")).write.text(folder)
    nodes, edges = read_adjacency(spark, folder)
    ranks = pagerank.pagerank(nodes, edges, [SUPPLIER_1], 3)
    return _round(pagerank.dense_ranks(ranks, nodes, [SUPPLIER_1]), 10, "p")


# --- classifier ----------------------------------------------------------


def every_document(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, label, features, model_id): low quality is spam, one model per language.

    The label is null where no one has judged the document.
    """
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    judged = F.when(F.col("quality") == 0, "spam").when(F.col("quality").isNotNull(), "ham")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", judged.alias("label"), tokens("text").alias("features"), F.col("lang").alias("model_id"),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The judged documents, to train on and to evaluate with."""
    return every_document(spark, sf).where("label IS NOT NULL")


def _one_model(docs: DataFrame) -> DataFrame:
    return docs.withColumn("model_id", F.lit("all"))


def _comparable(score: str) -> Column:
    """A score in 12 significant digits: the order of a sum's terms does not tell equal scores apart."""
    return F.format_string("%.11e", score).cast("double").alias("score")


def _train_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _round(linear_classifier.train_batch(labelled(spark, sf), epochs=2), 9, "weight")


def _train_sgd(spark: SparkSession, sf: str) -> DataFrame:
    return _round(linear_classifier.train_sgd(labelled(spark, sf)), 9, "weight")


def _train_sgd_sharded(spark: SparkSession, sf: str) -> DataFrame:
    docs = labelled(spark, sf).drop("model_id")
    return _round(linear_classifier.train_sgd_sharded(docs, shard_docs=SHARD_DOCS), 9, "weight")


def _shuffled_order(spark: SparkSession, sf: str) -> DataFrame:
    return linear_classifier.shuffled_order(spark.read.parquet(f"{sf}/documents.parquet"), range(2))


def _train_runs(spark: SparkSession, sf: str) -> DataFrame:
    """1-ROCA over models trained in different random orders."""
    docs = labelled(spark, sf)
    models = checkpointed(linear_classifier.train_runs(docs, range(RUNS)))
    preds = linear_classifier.score_models(docs, models)
    rocas = evaluation.one_minus_roca(
        checkpointed(preds.select("model_id", "label", _comparable("score"))), by=["model_id"]
    )
    return _round(evaluation.run_summary(rocas), 6, "low", "high", "mean")


def _score_unrounded(spark: SparkSession, sf: str) -> DataFrame:
    model = linear_classifier.train_batch(_one_model(labelled(spark, sf)))
    return linear_classifier.score(every_document(spark, sf), model)


def _score(spark: SparkSession, sf: str) -> DataFrame:
    return _round(_score_unrounded(spark, sf), 6, "score")


def _ensemble(method: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        models = linear_classifier.train_batch(labelled(spark, sf))
        scored = linear_classifier.score_ensemble(every_document(spark, sf), models, method)
        return _round(scored, 6, *(["score", "mean"] if method == "average" else []))

    return query


def _labelled_text(spark: SparkSession, sf: str) -> DataFrame:
    """Judged documents written as lines of id, label and features, read back, then one model."""
    line = F.concat_ws(" ", F.col("doc_id").cast("string"), "label", "features")
    folder = Staging(spark, "labelled").folder("text")
    labelled(spark, sf).select(line.alias("value")).write.text(folder)
    docs = read_labeled(read_lines(spark, folder), "string")
    return _round(linear_classifier.train_batch(_one_model(docs)), 9, "weight")


def _model_text(spark: SparkSession, sf: str) -> DataFrame:
    """Models written as tuple lines, read back, then the vote on every document."""
    models = checkpointed(linear_classifier.train_batch(labelled(spark, sf)))
    folder = Staging(spark, "models").folder("text")
    write_model(models, folder, "text")
    names = [r[0] for r in models.select("model_id").distinct().collect()]  # a handful of models
    read = read_models(spark, {m: f"{folder}/model_id={m}" for m in names})
    return linear_classifier.score_ensemble(every_document(spark, sf), read, "vote")


# --- evaluation ----------------------------------------------------------


def by_length(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions from document length: shorter than 1,000 characters is spam."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    score = F.floor((F.lit(1000) - F.col("n_chars")) / 50).cast("double")
    return docs.join(labels, "doc_id").select(
        "doc_id", "lang", F.when(F.col("quality") == 0, "spam").otherwise("ham").alias("label"),
        score.alias("score"), F.when(score > 0, "spam").otherwise("ham").alias("pred"),
    )


def _lam_text(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions written as tuple lines, read back, then LAM."""
    line = F.concat(F.lit("("), F.concat_ws(",", F.col("doc_id").cast("string"), "label", F.col("score").cast("string"), "pred"), F.lit(")"))
    folder = Staging(spark, "predictions").folder("text")
    by_length(spark, sf).select(line.alias("value")).write.text(folder)
    return _round(evaluation.lam(read_predictions(read_lines(spark, folder))), 9, "lam")


def _roca_model(spark: SparkSession, sf: str) -> DataFrame:
    judged = _score_unrounded(spark, sf).where("label IS NOT NULL").select("label", _comparable("score"))
    return _round(evaluation.one_minus_roca(checkpointed(judged)), 6, "one_minus_roca")


QUERIES: dict[str, Query] = {
    "q1_ship_count": lambda s, d: star.ship_count(_star(s, d), "1998-03"),
    "q1_ship_count_year": lambda s, d: star.ship_count(_star(s, d), "1998"),
    "q1_ship_count_day": lambda s, d: star.ship_count(_star(s, d), "1998-03-15"),
    "q2_orders_shipped": lambda s, d: star.orders_shipped(_star(s, d), "1998-03", "o_orderpriority"),
    "q3_part_supplier": lambda s, d: star.parts_and_suppliers(_star(s, d), "1998-03-15"),
    "q4_orders_by_nation": lambda s, d: star.orders_by_nation(_star(s, d), "1998-03"),
    "q5_monthly_shipments": lambda s, d: star.monthly_shipments(_star(s, d)),
    "q5_relabelled": lambda s, d: star.monthly_shipments(
        _star(s, d), (3, 24), {3: "CANADA", 24: "UNITED STATES"}),
    "q5_pivot": lambda s, d: star.monthly_shipments_pivot(_star(s, d), LABELS),
    "q6_pricing": _q6,
    "q3_delimited": _q3_delimited,
    "q7_top_revenue": _q7("1998-03-15"),
    "q7_top_revenue_month": _q7("1998-03"),
    "word_count": lambda s, d: counting.word_count(_docs(s, d)),
    "prefix_count": lambda s, d: counting.prefix_count(_docs(s, d)),
    "prefix_lookup": lambda s, d: counting.lookup(counting.prefix_count(_docs(s, d)), "prefix", "li"),
    "top_prefixes": lambda s, d: counting.top_counts(counting.prefix_count(_docs(s, d)), "prefix"),
    "line_df": lambda s, d: counting.line_df(_lines(s, d)),
    "line_df_first100": lambda s, d: counting.line_df(_lines(s, d), 100),
    "line_lengths": _line_lengths,
    "line_numbers": _numbered,
    "line_count": lambda s, d: counting.line_count(_lines(s, d)),
    "map_sum": _map_sum,
    "bigram_pairs": lambda s, d: bigrams.bigram_freq(_lines(s, d)),
    "bigram_stripes": lambda s, d: _bigram_stripes(s, d).select("a", F.explode("stripe").alias("b", "f")),
    "bigram_reconcile": _bigram_reconcile,
    "cooccur": lambda s, d: cooccurrence.cooccur(_lines(s, d), 5),
    "pmi_pairs": lambda s, d: _pmi_rows(_pmi(s, d)),
    "pmi_pairs_first100": lambda s, d: _pmi_rows(_pmi(s, d, 100)),
    "pmi_stripes": _pmi_stripes,
    "pmi_top": lambda s, d: _pmi_rows(cooccurrence.top_pairs(_pmi(s, d))),
    "pmi_neighbors": lambda s, d: _pmi_rows(cooccurrence.neighbors(_pmi(s, d), "the", k=20)),
    "pmi_neighbors_right": lambda s, d: _pmi_rows(
        cooccurrence.neighbors(_pmi(s, d), "of", "right", k=20)),
    "pair_stats": lambda s, d: cooccurrence.pair_stats(_pmi(s, d)),
    "pmi_reconcile": _pmi_reconcile,
    "pmi_reconcile_first100": _pmi_reconcile_first100,
    "term_freq": _postings,
    "postings": _index,
    "posting_gaps": lambda s, d: inverted_index.encode_gaps(_postings(s, d), INDEX_SPAN),
    "posting_gaps_decoded": _index_decoded,
    "index_build": _index_build("bitmaps"),
    "index_build_postings": _index_build("postings"),
    "index_table": _index_table,
    "bool_flat": lambda s, d: boolean_search.search(_stored(s, d, "postings"), "the of AND de OR"),
    "bool_term": _search("the"),
    "bool_and": _search("the of AND"),
    "bool_or": _search("the de OR"),
    "bool_nested": _search("the of AND de OR"),
    "bool_batch": _search_batch,
    "bool_batch_passages": _search_benchmark,
    "bool_fetch": _search_fetch(80),
    "bool_fetch_whole": _search_fetch(None),
    "graph_stats": lambda s, d: pagerank.graph_stats(*supply_graph(s, d)),
    "graph_validate": _graph_validate,
    "ppr_start": _ppr([SUPPLIER_1, PART_3], 0),
    "ppr_resume": _ppr_resume,
    "ppr_single": _ppr([SUPPLIER_1], 3),
    "ppr_multi": _ppr([SUPPLIER_1, SUPPLIER_2, PART_3], 3),
    "ppr_adjacency": _ppr_adjacency,
    "ppr_top": _ppr_top,
    "ppr_mass": _ppr_mass,
    "train_batch": _train_batch,
    "train_sgd": _train_sgd,
    "train_sgd_sharded": _train_sgd_sharded,
    "train_runs": _train_runs,
    "shuffled_order": _shuffled_order,
    "train_batch_text": _labelled_text,
    "score": _score,
    "ensemble_average": _ensemble("average"),
    "ensemble_vote": _ensemble("vote"),
    "ensemble_vote_text": _model_text,
    "one_minus_roca": lambda s, d: _round(
        evaluation.one_minus_roca(by_length(s, d)), 9, "one_minus_roca"),
    "one_minus_roca_by_language": lambda s, d: _round(
        evaluation.one_minus_roca(by_length(s, d), by=["lang"]), 9, "one_minus_roca"),
    "one_minus_roca_model": _roca_model,
    "lam_text": _lam_text,
    "lam": lambda s, d: _round(evaluation.lam(by_length(s, d)), 9, "lam"),
    "operating_points": lambda s, d: _round(evaluation.operating_points(by_length(s, d)), 9, "rate"),
    "roca_ci": lambda s, d: _round(
        evaluation.roca_ci(checkpointed(by_length(s, d)), reps=100, doc="doc_id"), 6, "estimate", "low", "high"),
    "resampled_points": lambda s, d: _round(evaluation.resampled_points(by_length(s, d), reps=100), 9, "rate"),
}
