"""Line dedup by winnowing, in DataFrame operations only.

Lines are compared without blanks at their ends; lines that are empty then
take no part and always stay.  The rule: of all appearances of a line of at
least ``single_words`` words, the first stays (in the order of document id,
then line) and the later ones go; shorter lines go with the repeated runs that
hold them.  With ``single_words`` 1, the default, no line stays twice.

Winnowing.  Of every ``WINDOW`` lines on end, the one with the smallest hash,
the last such on ties, is a fingerprint: equal windows choose the same line,
and a position is taken once however many windows choose it.  A text of fewer
lines is one window.  A fingerprint's positions are joined with its first
position only, and every match is extended both ways, as long as lines are
equal, by up to ``WINDOW`` - 1 lines: all windows that chose the position lie
in there, so a repeated run of ``WINDOW`` lines or more is covered as a whole.
A position carries the hashes of the lines around it, so that extending needs
no other row.  All covered lines go.  Copies of documents and passages are
deleted so, by about 2 / (WINDOW + 1) of their lines.

Lines that are left and long enough are windows of their own: they are
joined with their first appearance, which is never covered.

Hot hashes are spread over tasks by ``plans.skew``; only one row per hash, the
first, is copied.

Nulls and edges: a null text is empty; null ids come first; identical rows are
one document that is repeated and stay or go alike; equal ids with other texts
are ordered by a hash of the text.  Lines are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import Staging, explode_once, salted_join
from .rows import WORD, join_null_safe, keyed

WINDOW = 4
SINGLE_WORDS = 1

_HASH = "h"
_PLACE = ("doc_id", "version", "k")


def _items(docs: DataFrame, single_words: int) -> DataFrame:
    """(doc_id, version, items): at, h and whether it is long enough, of each line that is not blank."""
    trimmed = F.transform("_lines", lambda line, i: F.struct(i.alias("at"), F.btrim(line, F.lit(" \t\r\x0b\f")).alias("line")))

    def item(x: Column) -> Column:
        # a line that is not blank has a word
        long_enough = F.lit(True) if single_words <= 1 else F.size(F.regexp_extract_all(x["line"], F.lit(f"({WORD})"))) >= single_words
        return F.struct(x["at"].alias("at"), F.xxhash64(x["line"]).alias(_HASH), long_enough.alias("long"))

    return docs.select("doc_id", "version", F.split("text", "\n").alias("_lines")).select(
        "doc_id", "version", F.transform(F.filter(trimmed, lambda x: x["line"] != ""), item).alias("items")
    )


def _fingerprints(items: DataFrame) -> DataFrame:
    """(doc_id, version, k, h, around): the distinct window minima, with the hashes of the lines around each."""
    hashed = items.where(F.size("items") > 0).select(
        "doc_id", "version", F.transform("items", lambda x: x[_HASH]).alias("_hashes")
    )
    n, side = F.size("_hashes"), WINDOW - 1

    def chosen(i: Column) -> Column:
        window = F.slice("_hashes", i + 1, F.lit(WINDOW))
        size = F.size(window)
        # counted from the window's end, for the last one on ties
        return i + size - F.array_position(F.reverse(window), F.array_min(window)).cast("int")

    starts = F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0)))
    minima = hashed.select("doc_id", "version", "_hashes", F.array_distinct(F.transform(starts, chosen)).alias("_ks"))
    around = F.transform(F.sequence(F.lit(-side), F.lit(side)), lambda j: F.get("_hashes", F.col("_k") + j))
    rows = minima.select("doc_id", "version", "_hashes", F.explode_outer("_ks").alias("_k")).where("_k IS NOT NULL")
    return rows.select(
        "doc_id", "version", F.col("_k").alias("k"), F.get("_hashes", F.col("_k")).alias(_HASH), around.alias("around")
    )


def _later(staging: Staging, places: DataFrame, carried: list[str]) -> DataFrame:
    """Places whose hash has an earlier one, with what the first carries as ``first_...``."""
    first = places.groupBy(_HASH).agg(F.min(F.struct(*_PLACE, *carried)).alias("_first"), F.count("*").alias("n"))
    first = staging.keep(first.where("n > 1"), "first")
    joined = salted_join(places, first.drop("n"), [_HASH], list(_PLACE), first.select(_HASH, "n"))
    own, least = F.struct(*_PLACE), F.struct(*[F.col("_first")[c] for c in _PLACE])
    return joined.where(own > least).select(
        *_PLACE, *carried, *[F.col("_first")[c].alias(f"first_{c}") for c in carried]
    )


def _reach(own: Column, other: Column) -> Column:
    """How many lines from a match on are equal; both arrays begin with the match."""
    unlike = F.transform(F.arrays_zip(own.alias("a"), other.alias("b")), lambda x: x["a"].isNull() | x["b"].isNull() | (x["a"] != x["b"]))
    place = F.array_position(unlike, F.lit(True)).cast("int")
    return F.when(place > 0, place - 1).otherwise(F.lit(WINDOW))


def repeated_lines(docs: DataFrame, single_words: int = SINGLE_WORDS, staging: Staging | None = None) -> DataFrame:
    """(doc_id, version, removed): numbers of the lines to delete, for documents that have such."""
    staging = staging or Staging(docs.sparkSession, "lines")
    items = staging.keep(_items(docs, single_words).distinct(), "items")
    prints = staging.keep(_fingerprints(items), "prints")
    matches = _later(staging, prints, ["around"])

    def half(column: str, forward: bool) -> Column:
        part = F.slice(column, F.lit(WINDOW), F.lit(WINDOW)) if forward else F.reverse(F.slice(column, F.lit(1), F.lit(WINDOW)))
        return part

    ahead = _reach(half("around", True), half("first_around", True))
    behind = _reach(half("around", False), half("first_around", False))
    covered = matches.select("doc_id", "version", F.explode(F.sequence(F.col("k") - behind + 1, F.col("k") + ahead - 1)).alias("k"))
    runs = covered.groupBy("doc_id", "version").agg(F.collect_set("k").alias("covered"))  # at most a text's lines
    runs = staging.keep(runs, "runs")
    numbered = join_null_safe(items, runs, ["doc_id", "version"], "left").select(
        "doc_id", "version", F.coalesce("covered", F.array().cast("array<int>")).alias("covered"),
        F.transform("items", lambda x, k: F.struct(k.alias("k"), x[_HASH].alias(_HASH), x["long"].alias("long"))).alias("_all"),
    )
    left = F.filter("_all", lambda x: x["long"] & ~F.array_contains(F.col("covered"), x["k"]))
    rest = explode_once(numbered.select("doc_id", "version", left.alias("_left")), "_left", "_x", "doc_id", "version")
    rest = staging.keep(rest.select("doc_id", "version", F.col("_x")["k"].alias("k"), F.col("_x")[_HASH].alias(_HASH)), "rest")
    alone = _later(staging, rest, []).select("doc_id", "version", "k")
    gone = runs.select("doc_id", "version", F.explode("covered").alias("k")).unionAll(alone)
    ks = gone.groupBy("doc_id", "version").agg(F.collect_set("k").alias("_ks"))
    lines = F.transform("_ks", lambda k: F.get("items", k)["at"])
    return join_null_safe(items, ks, ["doc_id", "version"]).select("doc_id", "version", lines.alias("removed"))


def line_dedup(docs: DataFrame, single_words: int = SINGLE_WORDS) -> DataFrame:
    """(doc_id, text, n_lines, n_removed): each document without its repeated lines.

    ``n_lines`` counts lines that are not blank.
    """
    rows = keyed(docs)
    gone = repeated_lines(rows, single_words)
    return _without(rows, gone).select("doc_id", "text", "n_lines", "n_removed")


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    joined = join_null_safe(rows, gone, ["doc_id", "version"], "left")
    lines = F.split("text", "\n")
    kept = F.filter(F.col("_lines"), lambda line, i: ~F.array_contains(F.col("removed"), i))
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    count = F.size(F.filter("_lines", lambda line: F.btrim(line, F.lit(" \t\r\x0b\f")) != "")).cast("long")
    return joined.withColumn("_lines", lines).select(
        *[c for c in rows.columns if c != "text"], text.alias("text"), count.alias("n_lines"),
        F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed")).cast("long").alias("n_removed"),
    )


def dedup_documents(docs: DataFrame, single_words: int = SINGLE_WORDS) -> DataFrame:
    """The documents with all their columns, repeated lines cut from the text.

    ``n_chars`` follows the text.  A document of which every line is a repeat
    goes: nothing is left of it.
    """
    gone = repeated_lines(keyed(docs), single_words)
    named = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"], F.xxhash64(text).alias("version"), text.alias("text"),
        F.col("text").isNull().alias("_null"), *[docs[c].alias(n) for c, n in named.items()],
    )
    out = _without(rows, gone).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))

    def column(c: str):
        if c == "text":
            return F.when(F.col("_null"), F.lit(None).cast("string")).otherwise(F.col("text")).alias("text")
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(named[c])).alias(c)
        return F.col(named.get(c, c)).alias(c)

    return out.select(*[column(c) for c in docs.columns])
