"""Tokenising as Column expressions (no Python runs on the executors).

A raw token is a run of non-whitespace.  A token is what is left of it, in
lower case, after dropping everything outside a-z from both ends; a raw token
without any letter leaves no token.  Interior characters stay.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five whitespace characters, and the pattern of one token
# (first letter of a raw token up to its last letter).
WHITESPACE = r" \t\n\r\f"
TOKEN = rf"[a-z](?:[^{WHITESPACE}]*[a-z])?"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """All tokens of a text, in order, as ``array<string>``.

    One regex pass over the whole text; no split, no lambda, no empties to drop.
    """
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN), F.lit(0))


def first_distinct_tokens(text: Column | str, max_tokens: int | None = None) -> Column:
    """The distinct tokens of a text, or among its first ``max_tokens`` raw tokens.

    With a limit, raw tokens are counted before stripping, and the raw token that reaches
    the limit only ends the scan if it yields a token.  The set is therefore:
    tokens at raw positions 1 .. max_tokens-1, plus the first token found at
    position max_tokens or later.  At most ``max_tokens`` elements.
    """
    if max_tokens is None:
        return F.array_distinct(tokens(text))
    if max_tokens < 1:
        raise ValueError("max_tokens must be at least 1")
    low = F.lower(_col(text))
    head = F.regexp_extract(
        low, rf"^(?:[{WHITESPACE}]*+[^{WHITESPACE}]++){{0,{max_tokens - 1}}}+", 0
    )
    rest = F.substr(low, F.length(head) + 1)
    found = F.concat(
        F.regexp_extract_all(head, F.lit(TOKEN), F.lit(0)),
        F.array(F.regexp_extract(rest, TOKEN, 0)),
    )
    return F.array_remove(F.array_distinct(found), "")


def bigrams(token_array: Column | str) -> Column:
    """Adjacent pairs of an array, as an array of two-field structs."""
    arr = _col(token_array)
    n = F.greatest(F.size(arr) - 1, F.lit(0))
    return F.arrays_zip(F.slice(arr, 1, n), F.slice(arr, 2, n))


def prefix(word: Column | str, k: int = 2) -> Column:
    return F.substring(_col(word), 1, k)
