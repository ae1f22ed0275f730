"""The operators, by subject."""

from . import (
    bigrams, bitmap_search, boolean_search, cooccurrence, counting, evaluation, inverted_index,
    linear_classifier, pagerank, reconcile, star,
)

__all__ = [
    "bigrams", "bitmap_search", "boolean_search", "cooccurrence", "counting", "evaluation",
    "inverted_index", "linear_classifier", "pagerank", "reconcile", "star",
]
