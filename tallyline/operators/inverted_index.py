"""Term frequencies, postings and document-number gaps.

Postings are flat rows (term, docno, tf).  Lists are kept in blocks of
document numbers, so the list of a term found in most documents is many rows
of bounded size and never one.

Lists are made and stored once; document frequencies and gaps come from the
stored lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..plans.durable import checkpointed
from ..plans.prefix import running_before

BLOCK_SPAN = 65_536


def _counted_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, docno, tf) of each row, whose numbers of words are coded with the row's place."""
    for batch in batches:
        words = batch.column("words")
        # no word of a null array
        coded = words.flatten().dictionary_encode()
        row = np.repeat(np.arange(len(words)), pc.list_value_length(words).fill_null(0).to_numpy())
        size = max(len(coded.dictionary), 1)
        keys, counts = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([
            coded.dictionary.take(pa.array(keys % size)), batch.column("docno").take(pa.array(keys // size)), pa.array(counts.astype(np.int32)),
        ], names=["term", "docno", "tf"])


def term_freq(docs: DataFrame, docno: str = "docno", text: str = "text") -> DataFrame:
    """(term, docno, tf): token counts of every document, one row of ``docs`` each.

    The terms of a document are counted beside its row, without a shuffle.
    """
    words = docs.select(F.col(docno).alias("docno"), tokens(text).alias("words"))
    kind = words.schema["docno"].dataType.simpleString()
    return words.mapInArrow(_counted_terms, f"term string, docno {kind}, tf int")


def document_frequency(postings: DataFrame) -> DataFrame:
    """(term, df)."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def _blocks(postings: DataFrame, span: int) -> DataFrame:
    """(term, block, postings sorted by docno), stored; blocks by whole-number division."""
    block = F.expr(f"(docno - pmod(docno, {int(span)})) div {int(span)}")
    lists = postings.withColumn("block", block).groupBy("term", "block").agg(
        F.array_sort(F.collect_list(F.struct("docno", "tf"))).alias("postings")
    )
    return checkpointed(lists)


def build_index(postings: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """(term, df, block, postings array<struct<docno, tf>> sorted by docno).

    A block covers ``span`` document numbers, so no list exceeds ``span``
    entries; the lists of a term in block order are its whole postings list.
    The postings are read and shuffled once.
    """
    lists = _blocks(postings, span)
    frequency = lists.groupBy("term").agg(F.sum(F.size("postings").cast("bigint")).alias("df"))
    return lists.join(frequency, "term").select("term", "df", "block", "postings")


def _in_ranges(rows: DataFrame, *order: str) -> DataFrame:
    """Rows in ranges of (term, block), sorted by term, block and ``order``, with the range's number ``_range``.

    The range partitioner samples the rows, so they are read twice.  A block
    lies in one range, a term with many blocks in several.
    """
    dealt = rows.repartitionByRange("term", "block").sortWithinPartitions("term", "block", *order)
    return dealt.withColumn("_range", F.spark_partition_id())


def _changes(values: pa.Array, last) -> np.ndarray:
    """Whether a value differs from the one before it, the first one from ``last``; nulls are alike."""
    here, before = values.slice(1), values.slice(0, len(values) - 1)
    differ = pc.not_equal(here, before)
    if values.null_count:
        differ = pc.if_else(differ.is_null(), pc.xor(here.is_null(), before.is_null()), differ)
    return np.concatenate([[values[0].as_py() != last], differ.to_numpy(zero_copy_only=False)])


def _gaps_of_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range with pos and gap; the first one, ``_edge``, as if no list went on from an earlier range."""
    last, pos, docno, edge = [None, None], 0, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        term, block, docnos = (batch.column(c) for c in ("term", "block", "docno"))
        n = batch.num_rows
        new_term = _changes(term, last[0])
        new_list = new_term | _changes(block, last[1])
        places = np.arange(1, n + 1)
        heads = np.maximum.accumulate(np.where(new_list, places, 0))
        positions = np.where(heads > 0, places - heads + 1, places + pos)
        before = pa.concat_arrays([pa.array([docno], pa.int64()), docnos.slice(0, n - 1)])
        gaps = pc.subtract(docnos, pc.if_else(pa.array(new_term), pa.scalar(0, pa.int64()), before))
        edges = np.zeros(n, bool)
        edges[0], edge = edge, False
        yield pa.RecordBatch.from_arrays([
            term, block, pa.array(positions.astype(np.int32)), gaps, batch.column("tf"), docnos, batch.column("_range"), pa.array(edges),
        ], names=["term", "block", "pos", "gap", "tf", "docno", "_range", "_edge"])
        last, pos, docno = [term[n - 1].as_py(), block[n - 1].as_py()], int(positions[-1]), docnos[n - 1].as_py()


def encode_gaps(postings: DataFrame, span: int = BLOCK_SPAN) -> DataFrame:
    """(term, block, pos, gap, tf): gaps between document numbers of a term.

    The first gap of a term is its first document number; the first posting of
    a block continues from the last document number of the term's previous
    block.  Postings are shuffled once, into sorted ranges of lists, and gaps
    are taken from row to row; only the first row of each range continues from
    another range, whose last posting is looked up in a table of the ranges.
    Postings without document number are left out.
    """
    kind, tf = (postings.schema[c].dataType.simpleString() for c in ("docno", "tf"))
    block = F.expr(f"(docno - pmod(docno, {int(span)})) div {int(span)}")
    stored = checkpointed(postings.select("term", block.alias("block"), F.col("docno").cast("bigint"), "tf"))
    rows = _in_ranges(stored, "docno", "tf")
    made = checkpointed(rows.mapInArrow(
        _gaps_of_range, f"term string, block long, pos int, gap long, tf {tf}, docno long, _range int, _edge boolean"
    ))
    ranges = made.groupBy("_range").agg(
        F.min("term").alias("first"), F.max(F.struct("term", F.col("block"), F.col("pos"), "docno")).alias("last")
    )
    in_order = Window.orderBy("_range")  # a row per range
    before = F.lag("last").over(in_order)
    starts = ranges.select("_range", (before["term"] == F.col("first")).alias("_on"), before["docno"].alias("_start"))
    start = F.when(F.col("_edge") & F.col("_on"), F.col("_start")).otherwise(0)
    return made.join(F.broadcast(starts), "_range").where("block IS NOT NULL").select(
        "term", "block", "pos", (F.col("gap") - start).cast(kind).alias("gap"), "tf"
    )


def decode_gaps(encoded: DataFrame) -> DataFrame:
    """(term, docno, tf): the postings the gaps stand for."""
    placed = running_before(encoded, ["gap"], "block", "pos", group=["term"])
    return placed.select("term", (F.col("gap_before") + F.col("gap")).alias("docno"), "tf")
