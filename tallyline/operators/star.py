"""Seven reporting queries over a star schema, and the monthly pivot.

Each takes a mapping of table name to DataFrame.  Which side is broadcast is
left to the size Spark knows or measures; no table is assumed small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_after, date_before, date_matches, year_month

Tables = Mapping[str, DataFrame]


def ship_count(t: Tables, date: str) -> DataFrame:
    """Q1 (n): lineitems shipped on the date."""
    return t["lineitem"].where(date_matches("l_shipdate", date)).agg(F.count("*").alias("n"))


def _orders_shipped_on(t: Tables, date: str) -> DataFrame:
    """Orders with a lineitem shipped on the date, one row per order.

    Order keys are made distinct before they travel, so an order with very
    many lineitems costs one row per task.
    """
    shipped = (
        t["lineitem"].where(date_matches("l_shipdate", date))
        .select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    )
    return t["orders"].join(shipped, "o_orderkey", "left_semi")


def orders_shipped(t: Tables, date: str, clerk: str = "o_clerk", k: int = 20) -> DataFrame:
    """Q2 (clerk, o_orderkey): the first ``k`` orders shipped on the date."""
    return _orders_shipped_on(t, date).select(clerk, "o_orderkey").orderBy("o_orderkey").limit(k)


def parts_and_suppliers(t: Tables, date: str, k: int = 20) -> DataFrame:
    """Q3 (l_orderkey, p_name, s_name): first ``k`` lineitems, ties by the names."""
    shipped = t["lineitem"].where(date_matches("l_shipdate", date))
    named = (
        shipped.join(t["part"], shipped["l_partkey"] == t["part"]["p_partkey"])
        .join(t["supplier"], shipped["l_suppkey"] == t["supplier"]["s_suppkey"])
        .select("l_orderkey", "p_name", "s_name")
    )
    return named.orderBy("l_orderkey", "p_name", "s_name").limit(k)


def orders_by_nation(t: Tables, date: str) -> DataFrame:
    """Q4 (n_nationkey, n_name, n): orders shipped on the date, by nation.

    Orders are counted per customer first: the customer join then carries one
    row per customer, however many orders a customer has.
    """
    per_customer = (
        _orders_shipped_on(t, date).groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"))
    )
    per_nation = (
        per_customer.join(t["customer"].select("c_custkey", "c_nationkey"), "c_custkey")
        .groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("n").alias("n"))
    )
    named = per_nation.join(t["nation"].select("n_nationkey", "n_name"), "n_nationkey")
    return named.select("n_nationkey", "n_name", "n").orderBy("n_nationkey")


def _monthly(t: Tables, nations: Sequence[int]) -> DataFrame:
    """(month, n_nationkey, n): lineitems shipped per month and nation.

    Customers of the nations shrink the orders before lineitem is joined.
    """
    customers = (
        t["customer"].where(F.col("c_nationkey").isin(list(nations)))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    )
    orders = (
        t["orders"].select("o_orderkey", "o_custkey").join(customers, "o_custkey")
        .select(F.col("o_orderkey").alias("l_orderkey"), "n_nationkey")
    )
    lines = t["lineitem"].select("l_orderkey", year_month("l_shipdate").alias("month"))
    joined = lines.join(orders, "l_orderkey")
    return joined.groupBy("month", "n_nationkey").agg(F.count("*").alias("n"))


def _label(rows: DataFrame, t: Tables, labels: Mapping[int, str] | None) -> DataFrame:
    if labels is None:
        names = t["nation"].select("n_nationkey", F.col("n_name").alias("nation"))
        return rows.join(names, "n_nationkey")
    name = F.coalesce(*[F.when(F.col("n_nationkey") == k, F.lit(v)) for k, v in labels.items()])
    return rows.withColumn("nation", name)


def monthly_shipments(
    t: Tables, nations: Sequence[int] = (3, 24), labels: Mapping[int, str] | None = None
) -> DataFrame:
    """Q5 (month, n, nation) by month; names from the nation table or ``labels``."""
    named = _label(_monthly(t, nations), t, labels)
    return named.select("month", "n", "nation").orderBy("month", "nation")


def monthly_shipments_pivot(t: Tables, labels: Mapping[int, str]) -> DataFrame:
    """(month, one count column per nation): Q5 as a table, 0 where nothing shipped.

    The columns are given, so the pivot needs no extra pass to find them.
    """
    wide = _monthly(t, list(labels)).groupBy("month").pivot("n_nationkey", list(labels)).sum("n")
    counts = [F.coalesce(F.col(str(k)), F.lit(0)).alias(v) for k, v in labels.items()]
    return wide.select("month", *counts).orderBy("month")


def pricing_summary(t: Tables, date: str) -> DataFrame:
    """Q6: sums, averages and count by return flag and line status."""
    discounted = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    charged = discounted * (F.lit(1.0) + F.col("l_tax"))
    return (
        t["lineitem"].where(date_matches("l_shipdate", date))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_base_price"),
            F.sum(discounted).alias("sum_disc_price"),
            F.sum(charged).alias("sum_charge"),
            F.avg("l_quantity").alias("avg_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
            F.avg("l_discount").alias("avg_disc"),
            F.count("*").alias("count_order"),
        )
    )


def top_revenue(
    t: Tables, date: str, priority: str = "o_shippriority", k: int = 10
) -> DataFrame:
    """Q7 (c_name, o_orderkey, revenue, o_orderdate, priority): top unshipped orders.

    Revenue is summed per order key before the join with orders, which uses
    the same partitioning; an order with very many lineitems arrives as
    partial sums.
    """
    revenue = F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))
    late = (
        t["lineitem"].where(date_after("l_shipdate", date))
        .groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(revenue.alias("revenue"))
    )
    open_orders = (
        t["orders"].where(date_before("o_orderdate", date))
        .select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate", priority)
    )
    rows = late.join(open_orders, "o_orderkey").join(
        t["customer"].select("c_custkey", "c_name"), "c_custkey"
    )
    return (
        rows.select("c_name", "o_orderkey", "revenue", "o_orderdate", priority)
        .orderBy(F.desc("revenue"), "o_orderkey").limit(k)
    )
