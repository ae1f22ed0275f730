"""Relative frequency of adjacent words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import bigrams, tokens
from ..plans.durable import checkpointed
from ..plans.stripes import STRIPE_WIDTH, to_stripes

MARGINAL = "*"


def bigram_counts(lines: DataFrame, min_tokens: int = 3, text: str = "text") -> DataFrame:
    """(a, b, n) over lines with at least ``min_tokens`` tokens.

    Short lines give an empty array instead of being filtered: a filter would
    move below the projection and tokenise every line twice.  Words are never
    null; saying so keeps this plan identical wherever it is joined, so Spark
    shuffles the counts once for all their uses.
    """
    enough = F.when(F.size("t") >= min_tokens, F.col("t")).otherwise(F.array())
    token_rows = lines.select(tokens(text).alias("t")).select(enough.alias("t"))
    pairs = token_rows.select(F.inline(bigrams("t")).alias("a", "b")).where("a is not null")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def bigram_freq(
    lines: DataFrame, min_tokens: int = 3, with_marginal: bool = True, text: str = "text"
) -> DataFrame:
    """(a, b, f) with f = n(a, b) / n(a, .); marginal rows (a, "*", n(a, .)).

    min_tokens 3 with marginals is the pairs form, which leaves out lines of
    two tokens; 2 without marginals is the stripes form.  Marginals are summed
    and joined back rather than windowed: a word that starts a third of all
    bigrams is then split by the skew join instead of sorted by one task.
    """
    counts = bigram_counts(lines, min_tokens, text)
    marginals = counts.groupBy("a").agg(F.sum("n").alias("total"))
    ratios = counts.join(marginals, "a").select("a", "b", (F.col("n") / F.col("total")).alias("f"))
    if not with_marginal:
        return ratios
    rows = marginals.select("a", F.lit(MARGINAL).alias("b"), F.col("total").cast("double").alias("f"))
    return ratios.unionByName(rows)


def bigram_stripes(
    lines: DataFrame, min_tokens: int = 2, width: int = STRIPE_WIDTH, text: str = "text"
) -> DataFrame:
    """(a, part, stripe map<b, f>)."""
    rows = checkpointed(bigram_freq(lines, min_tokens, with_marginal=False, text=text))
    return to_stripes(rows, "a", "b", "f", width=width)
