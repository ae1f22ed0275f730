"""Boolean retrieval with postfix queries such as ``a b AND c OR``.

Terms are matched as written.  ``AND`` and ``OR`` are operators only in upper
case.  The answer is the top of the stack; further operands are ignored; an
operator without two operands is an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def query_terms(query: str) -> list[str]:
    return list(dict.fromkeys(w for w in query.split() if w not in ("AND", "OR")))


def evaluate(query: str, operands: dict, both: Callable, either: Callable):
    """The top of the stack after a postfix query over any kind of operands."""
    stack: list = []
    for word in query.split():
        if word in ("AND", "OR"):
            if len(stack) < 2:
                raise ValueError(f"{word} needs two operands: {query!r}")
            right, left = stack.pop(), stack.pop()
            stack.append(both(left, right) if word == "AND" else either(left, right))
        else:
            stack.append(operands[word])
    if not stack:
        raise ValueError("empty query")
    return stack[-1]


def search(postings: DataFrame, query: str) -> DataFrame:
    """(docno) of the documents that satisfy one query.

    One pass: only postings of the query's terms are read, each document
    becomes one row of term flags, and the query is a filter on those flags.
    """
    terms = query_terms(query)
    flags = [f"t{i}" for i in range(len(terms))]
    condition = evaluate(query, {t: F.col(f) for t, f in zip(terms, flags)}, lambda a, b: a & b, lambda a, b: a | b)
    hits = postings.where(F.col("term").isin(terms)).groupBy("docno").agg(
        *[F.bool_or(F.col("term") == t).alias(f) for t, f in zip(terms, flags)]
    )
    return hits.where(condition).select("docno")


def _top_of_stack(
    query: Column, kind: str, operand: Callable[[Column], Column],
    both: Callable[[Column, Column], Column], either: Callable[[Column, Column], Column],
) -> Column:
    """The value a postfix query leaves, for values of type ``kind``."""
    size = F.size

    def push(stack: Column, word: Column) -> Column:
        kept = F.slice(stack, 1, F.greatest(size(stack) - 2, F.lit(0)))
        left, right = F.get(stack, size(stack) - 2), F.get(stack, size(stack) - 1)
        applied = F.when(word == "AND", both(left, right)).otherwise(either(left, right))
        short = F.raise_error(F.concat(word, F.lit(" needs two operands")))
        operated = F.when(size(stack) < 2, short.cast(f"array<{kind}>")).otherwise(
            F.concat(kept, F.array(applied))
        )
        pushed = F.concat(stack, F.array(operand(word).cast(kind)))
        return F.when(word.isin("AND", "OR"), operated).otherwise(pushed)

    empty = F.array().cast(f"array<{kind}>")
    return F.aggregate(_words(query), empty, push, lambda s: F.get(s, size(s) - 1))


def _words(query: Column) -> Column:
    return F.split(F.trim(query), r"\s+")


def _holds(query: Column, present: Column) -> Column:
    """Whether a document with the ``present`` terms satisfies the query."""
    return _top_of_stack(
        query, "boolean", lambda word: F.array_contains(present, word),
        lambda a, b: a & b, lambda a, b: a | b,
    )


def _anchors(query: Column, sizes: Column) -> Column:
    """Terms of which every answer holds at least one: for AND those of the
    side with fewer postings, for OR those of both sides."""
    top = _top_of_stack(
        query, "struct<n:bigint,terms:array<string>>",
        lambda word: F.struct(F.coalesce(sizes[word], F.lit(0)).alias("n"), F.array(word).alias("terms")),
        lambda a, b: F.when(a["n"] <= b["n"], a).otherwise(b),
        lambda a, b: F.struct(
            (a["n"] + b["n"]).alias("n"), F.array_union(a["terms"], b["terms"]).alias("terms")
        ),
    )
    return top["terms"]


def search_batch(postings: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, docno) for a table of queries (query_id, query), in one job.

    A query's candidates come from the postings of its anchor terms; the other
    terms are looked up for candidates only, by (term, document).  A word found
    everywhere is thus not multiplied by the queries that AND it with a rare
    one.  Candidates carry their query's text, and nothing is joined or grouped
    by query alone, so a broad query is spread over all its documents.  The
    postings are read three times: pass stored ones.
    """
    operators = F.array(F.lit("AND"), F.lit("OR"))
    words = F.array_except(_words(F.col("query")), operators)
    wanted = queries.select("query_id", F.explode(words).alias("term"))
    entries = postings.select("term", "docno")
    frequency = (
        entries.join(wanted.select("term").distinct(), "term", "left_semi")
        .groupBy("term").agg(F.count("*").alias("n"))
    )
    sizes = wanted.join(frequency, "term").groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "n"))).alias("sizes")
    )
    anchors = queries.join(sizes, "query_id", "left").select(
        "query_id", "query", F.explode(_anchors(F.col("query"), F.col("sizes"))).alias("term")
    )
    candidates = entries.hint("merge").join(anchors, "term").select("docno", "query_id", "query").distinct()
    looked_up = candidates.select("docno", "query_id", "query", F.explode(words).alias("term"))
    hits = (
        looked_up.join(entries.hint("merge"), ["docno", "term"], "left_semi")
        .groupBy("docno", "query_id", "query").agg(F.collect_set("term").alias("present"))
    )
    return hits.where(_holds(F.col("query"), F.col("present"))).select("query_id", "docno")


def fetch(hits: DataFrame, docs: DataFrame, docno: str = "docno", text: str = "text") -> DataFrame:
    """The hits with their text."""
    return hits.join(docs.select(F.col(docno).alias("docno"), F.col(text).alias("text")), "docno")


def shortened(text: Column | str, limit: int = 80) -> Column:
    """Text of more than ``limit`` characters, cut there and marked with dots."""
    text = F.col(text) if isinstance(text, str) else text
    cut = F.concat(F.substring(text, 1, limit), F.lit("..."))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def result_lines(fetched: DataFrame, limit: int | None = None) -> DataFrame:
    """(line): ``docno TAB text``, the text shortened where a limit is given."""
    text = shortened("text", limit) if limit else F.col("text")
    return fetched.select(F.concat(F.col("docno").cast("string"), F.lit("\t"), text).alias("line"))
