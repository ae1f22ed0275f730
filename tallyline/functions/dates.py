"""Date arguments ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` as range predicates.

Ranges on the bare column reach the parquet scan as pushed filters; formatting
the column to text and comparing strings would not.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_ARGUMENT = re.compile(r"(\d{4})(?:-(\d{2})(?:-(\d{2}))?)?")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_bounds(arg: str) -> tuple[dt.date, dt.date]:
    """First day covered by the argument and first day after it."""
    m = _ARGUMENT.fullmatch(arg)
    if m is None:
        raise ValueError(f"date must be YYYY, YYYY-MM or YYYY-MM-DD, not {arg!r}")
    year, month, day = m.groups()
    lo = dt.date(int(year), int(month or 1), int(day or 1))
    if day:
        return lo, lo + dt.timedelta(days=1)
    if month:
        return lo, dt.date(lo.year + lo.month // 12, lo.month % 12 + 1, 1)
    return lo, dt.date(lo.year + 1, 1, 1)


def date_matches(col: Column | str, arg: str) -> Column:
    """True where the date falls in the year, month or day given."""
    lo, hi = date_bounds(arg)
    return (_col(col) >= F.lit(lo)) & (_col(col) < F.lit(hi))


def date_before(col: Column | str, arg: str) -> Column:
    """Strictly before the argument; a partial date stands for its first day."""
    return _col(col) < F.lit(date_bounds(arg)[0])


def date_after(col: Column | str, arg: str) -> Column:
    """Strictly after the argument.

    A partial date sorts before every full date that extends it, so a year or
    month argument includes its own days; a full date excludes itself.
    """
    lo, hi = date_bounds(arg)
    return _col(col) >= F.lit(hi if len(arg) == 10 else lo)


def year_month(col: Column | str) -> Column:
    return F.date_format(_col(col), "yyyy-MM")
