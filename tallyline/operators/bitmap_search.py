"""Boolean retrieval on bitmaps of document numbers.

The index has a row per (term, range of document numbers).  Where a term is in
many documents of a range the row has a bitmap of the range, else their places
in it.  A query reads the rows of its terms only; AND and OR are aggregations
of the operands' bitmaps by range, so a term in every document costs as many
rows as there are ranges, whatever the number of its postings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boolean_search import evaluate, query_terms

DENSE = 128  # documents of a range from which on a bitmap is kept
BYTES = 4096  # of a bitmap; Spark's functions fix the size of a range
SPAN = 8 * BYTES


def bitmap_index(postings: DataFrame, dense: int = DENSE) -> DataFrame:
    """(term, range, n, places array<bigint>, bits binary) from postings (term, docno, ...).

    A range has at most SPAN documents, so its list is bounded.  Either
    ``places`` or ``bits`` is null.
    """
    placed = postings.where("docno IS NOT NULL").select(
        "term", F.bitmap_bucket_number("docno").alias("range"), F.bitmap_bit_position("docno").alias("place")
    )
    lists = placed.groupBy("term", "range").agg(F.collect_set("place").alias("places"))
    n = F.size("places").cast("bigint")
    sparse = lists.where(n < dense).select("term", "range", n.alias("n"), "places", F.lit(None).cast("binary").alias("bits"))
    bits = lists.where(n >= dense).select("term", "range", F.explode("places").alias("place")).groupBy("term", "range").agg(
        F.count("*").alias("n"), F.bitmap_construct_agg("place").alias("bits")
    )
    return sparse.unionByName(bits.withColumn("places", F.lit(None).cast("array<bigint>")))


def _bitmaps(rows: DataFrame) -> DataFrame:
    """(range, bits) of one term's rows."""
    dense = rows.where("bits IS NOT NULL").select("range", "bits")
    sparse = rows.where("bits IS NULL").select("range", F.explode("places").alias("place"))
    return dense.unionAll(sparse.groupBy("range").agg(F.bitmap_construct_agg("place").alias("bits")))


def _both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ranges that both have; the bits are in neither plan until their ranges met."""
    other = right.select(F.col("range"), F.col("bits").alias("_bits"))
    pairs = left.join(other, "range").select("range", F.explode(F.array("bits", "_bits")).alias("bits"))
    return pairs.groupBy("range").agg(F.bitmap_and_agg("bits").alias("bits"))


def _either(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionAll(right).groupBy("range").agg(F.bitmap_or_agg("bits").alias("bits"))


def _numbers(bits: DataFrame) -> DataFrame:
    """(docno) of the bits that are set: first the bytes that are not 0, then their bits."""
    hexed = bits.select("range", F.hex("bits").alias("_hex"))
    byte = lambda i: F.conv(F.substr("_hex", i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    whole = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(BYTES - 1)), lambda i: F.struct(i.alias("at"), byte(i).alias("byte"))),
        lambda x: x["byte"] > 0,
    )
    rows = hexed.select("range", F.explode(whole).alias("_x"))
    each = rows.select("range", "_x", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit")).where(
        F.expr("shiftright(_x.byte, _bit) & 1 = 1")
    )
    place = F.col("_x")["at"].cast("bigint") * 8 + F.col("_bit")
    # the inverse of bitmap_bucket_number and bitmap_bit_position
    first = F.col("range") > 0
    above, below = (F.col("range") - 1) * SPAN + place + 1, F.col("range") * SPAN - place
    return each.select(F.when(first, above).otherwise(below).alias("docno"))


def search(index: DataFrame, query: str) -> DataFrame:
    """(docno) of the documents that satisfy one postfix query."""
    terms = query_terms(query)
    rows = index.where(F.col("term").isin(terms))
    return _numbers(evaluate(query, {t: _bitmaps(rows.where(F.col("term") == t)) for t in terms}, _both, _either))


def document_frequency(index: DataFrame) -> DataFrame:
    """(term, df)."""
    return index.groupBy("term").agg(F.sum("n").alias("df"))
