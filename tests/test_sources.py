import pytest
from pyspark.sql import functions as F

from tallyline import sources
from tallyline.operators import inverted_index


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "text string")


def test_adjacency(spark):
    nodes, edges = sources.parse_adjacency(lines(spark, "1 2 3", " 2\t3  3 ", "4", ""))
    assert sorted(r.id for r in nodes.collect()) == [1, 2, 4]
    assert sorted((r.src, r.dst) for r in edges.collect()) == [(1, 2), (1, 3), (2, 3), (2, 3)]
    assert sources.read_sources("17,7") == [17, 7]


def test_labelled_documents(spark):
    got = [tuple(r) for r in sources.read_labeled(lines(spark, "d1 spam 5 5 7", "d2 ham")).collect()]
    assert got == [("d1", "spam", [5, 5, 7]), ("d2", "ham", [])]


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_models_round_trip(spark, tmp_path, fmt):
    rows = [("a", "1", 0.5), ("a", "x,y", -1.5e-7), ("b", "1", 2.0)]
    model = spark.createDataFrame(rows, "model_id string, feature string, weight double")
    path = str(tmp_path / "models")
    for _ in range(2):  # a second write replaces the first
        sources.write_model(model, path, fmt)
    if fmt == "text":
        back = sources.read_models(spark, {m: f"{path}/model_id={m}" for m in "ab"})
    else:
        back = spark.read.parquet(path).select("model_id", "feature", "weight")
        assert sources.read_model(spark, path, "b", "parquet").count() == 1
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_predictions(spark):
    got = sources.read_predictions(lines(spark, "(spam-ham-7,ham,-1.5E-3,spam)")).first()
    assert tuple(got) == ("spam-ham-7", "ham", -0.0015, "spam")


def test_numbered_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in "ab":
        (tmp_path / "in" / name).write_text("one\n\ntwo\n")
    docs = sources.number_lines(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = docs.collect()
    assert sorted((r.docno, r.text) for r in rows) == list(enumerate(["one", "", "two"] * 2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4b")
    try:
        again = sources.number_lines(spark, str(tmp_path / "in"), str(tmp_path / "out2")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(rows) == sorted(again)
    assert inverted_index.term_freq(docs).where("term = 'two'").count() == 2


def test_document_lines_keep_empty_lines(spark):
    docs = spark.createDataFrame([(7, "a\n\nb\n")], "docno long, text string")
    got = [(r.docno, r.line_no, r.text) for r in sources.document_lines(docs).collect()]
    assert got == [(7, 0, "a"), (7, 1, ""), (7, 2, "b"), (7, 3, "")]


def test_index_is_replaced_and_sorted(spark, tmp_path):
    path = str(tmp_path / "index")
    for word in ("old", "new"):
        docs = spark.createDataFrame([(i, f"{word} common") for i in range(50)], "docno long, text string")
        sources.write_index(inverted_index.term_freq(docs), path)
    index = sources.read_index(spark, path)
    assert {r.term for r in index.select("term").distinct().collect()} == {"new", "common"}
    rows = [(r.term, r.docno) for r in index.where(F.col("term") == "common").collect()]
    assert sorted(rows) == [("common", i) for i in range(50)]


def test_tsv_sink_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    for n in (3, 2):
        sources.write_table(spark.range(n).withColumn("w", F.lit("x")), path, "tsv")
    assert sorted(r.text for r in sources.read_lines(spark, path).collect()) == ["0\tx", "1\tx"]


def test_versions_of_an_index_table(spark, tmp_path):
    """A reader keeps its files while, and after, the next version is written."""
    table = "tallyline_test_versions"
    made = lambda word: spark.createDataFrame([(word, 1, 1), ("common", 2, 1)], "term string, docno long, tf int")
    one = sources.write_index(made("one"), table=table, versions=f"{tmp_path}/versions")
    try:
        reader = sources.read_index(spark, table=table)
        two = sources.write_index(made("two"), table=table)
        assert one != two and {r.term for r in reader.collect()} == {"one", "common"}
        assert {r.term for r in sources.read_index(spark, table=table).collect()} == {"two", "common"}
        assert {r.term for r in spark.table(table).collect()} == {"two", "common"}
        assert sources.drop_versions(spark, table) == 1
        assert {r.term for r in sources.read_index(spark, table=table).collect()} == {"two", "common"}
        assert sources.drop_versions(spark, table) == 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_index_files_have_bloom_filters(spark, tmp_path):
    import pyarrow.parquet as pq

    path = sources.write_index(spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], "term string, docno long, tf int"), str(tmp_path / "index"))
    files = [str(f) for f in (tmp_path / "index").glob("*.parquet")]
    sizes = [pq.ParquetFile(f).metadata.serialized_size for f in files if pq.ParquetFile(f).metadata.num_rows]
    plain = tmp_path / "plain"
    sources.read_index(spark, path).write.parquet(str(plain))
    assert sizes and sum(f.stat().st_size for f in (tmp_path / "index").glob("*.parquet")) > sum(f.stat().st_size for f in plain.glob("*.parquet"))
