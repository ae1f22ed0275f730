"""Column expressions: tokenising, date arguments and small numeric rules."""

from .dates import date_after, date_before, date_matches, year_month
from .numeric import floor_hundredths, guarded_rate, logit, rate_bucket, sigmoid, sign_vote
from .text import bigrams, first_distinct_tokens, prefix, tokens

__all__ = [
    "bigrams", "date_after", "date_before", "date_matches", "first_distinct_tokens",
    "floor_hundredths", "guarded_rate", "logit", "prefix", "rate_bucket", "sigmoid",
    "sign_vote", "tokens", "year_month",
]
