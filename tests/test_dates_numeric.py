import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyline.functions import (
    date_after, date_before, date_matches, floor_hundredths, guarded_rate, logit, rate_bucket,
    sigmoid, sign_vote, year_month,
)
from tallyline.functions.numeric import RATE_EDGES

DAYS = ["1997-12-31", "1998-01-01", "1998-02-28", "1998-03-01", "1998-03-14", "1998-03-15",
        "1998-03-16", "1998-03-31", "1998-04-01", "1998-12-31", "1999-01-01"]


@pytest.fixture(scope="module")
def days(spark):
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in DAYS], "d date")
    return df.select("d", F.col("d").cast("timestamp_ntz").alias("t"))


@pytest.mark.parametrize("column", ["d", "t"])
@pytest.mark.parametrize("arg", ["1998", "1998-03", "1998-03-15", "1998-12"])
def test_against_string_comparison(days, column, arg):
    def chosen(condition):
        return sorted(str(r.d) for r in days.where(condition).collect())

    assert chosen(date_matches(column, arg)) == [
        d for d in DAYS if d.split("-")[: len(arg.split("-"))] == arg.split("-")
    ]
    assert chosen(date_before(column, arg)) == [d for d in DAYS if arg > d]
    assert chosen(date_after(column, arg)) == [d for d in DAYS if arg < d]


@pytest.mark.parametrize("arg", ["1998-3", "x", "98", "1998-03-15-01", "1998-13", "1998-02-30", ""])
def test_bad_date(arg):
    with pytest.raises(ValueError):
        date_matches(F.lit(None), arg)


def test_date_range_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where(date_matches("l_shipdate", "1998-03"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01" in plan
    assert "LessThan(l_shipdate,1998-04-01" in plan


def test_year_month(days):
    assert days.select(year_month("t")).first()[0] == "1997-12"


def test_numeric_rules(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (3.5,)], "v double")
    assert [r[0] for r in df.select(sign_vote("v")).collect()] == [-1, 0, 1]
    back = df.select(logit(sigmoid("v"))).collect()
    assert [round(r[0], 9) for r in back] == [-2.0, 0.0, 3.5]
    v = spark.createDataFrame([(1.239,), (-1.231,), (2.0,)], "v double")
    assert [r[0] for r in v.select(floor_hundredths("v")).collect()] == [1.23, -1.24, 2.0]


def test_rate_buckets_include_their_upper_edge(spark):
    rates = [0.0, *RATE_EDGES, 0.00011, 0.3, 0.51]
    df = spark.createDataFrame([(r,) for r in rates], "r double")
    want = [next(i for i, e in enumerate(RATE_EDGES) if r <= e) for r in rates]
    assert [r[0] for r in df.select(rate_bucket("r")).collect()] == want


def test_guarded_rate(spark):
    df = spark.createDataFrame([(0, 4), (4, 4), (1, 4), (0, 0)], "k long, n long")
    assert [r[0] for r in df.select(guarded_rate("k", "n")).collect()] == [0.125, 0.875, 0.25, None]
