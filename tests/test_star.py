import datetime as dt

import pytest

from tallyline.operators import star
from tallyline.sources import SCHEMAS, load_tables

DAY = dt.date(1998, 3, 15)


@pytest.fixture(scope="module")
def tables(spark):
    """Order 1 has two matching lineitems, 2 has none, 3 one; lineitem of order 9 has no order."""
    lineitem = [
        (1, 10, 20, 1.0, 100.0, 0.1, 0.0, "A", "F", DAY),
        (1, 11, 20, 2.0, 50.0, 0.0, 0.1, "A", "F", DAY),
        (2, 10, 21, 3.0, 10.0, 0.0, 0.0, "R", "O", dt.date(1998, 4, 1)),
        (3, 10, 21, 4.0, 30.0, 0.5, 0.2, "R", "O", DAY),
        (9, 10, 21, 5.0, 70.0, 0.0, 0.0, "N", "O", DAY),
        (3, 99, 21, 6.0, 70.0, 0.0, 0.0, "N", "O", DAY),
    ]
    orders = [(1, 5, dt.date(1998, 3, 1), "clerk1", 0), (2, 6, dt.date(1998, 3, 14), "clerk2", 1),
              (3, 5, dt.date(1998, 3, 15), "clerk3", 2)]
    made = {
        "lineitem": (lineitem, "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate date"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date, o_clerk string, o_shippriority int"),
        "customer": ([(5, "five", 3), (6, "six", 24)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(10, "bolt"), (11, "nut")], "p_partkey long, p_name string"),
        "supplier": ([(20, "s20"), (21, "s21")], "s_suppkey long, s_name string"),
        "nation": ([(3, "CANADA"), (24, "UNITED STATES")], "n_nationkey int, n_name string"),
    }
    return {k: spark.createDataFrame(rows, schema) for k, (rows, schema) in made.items()}


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_q1_counts_lineitems(tables):
    assert rows(star.ship_count(tables, "1998-03-15")) == [(5,)]
    assert rows(star.ship_count(tables, "1998")) == [(6,)]


def test_q2_lists_each_order_once(tables):
    assert rows(star.orders_shipped(tables, "1998-03-15")) == [("clerk1", 1), ("clerk3", 3)]
    assert rows(star.orders_shipped(tables, "1998-03", k=1)) == [("clerk1", 1)]


def test_q3_lists_lineitems_with_known_part_and_supplier(tables):
    assert rows(star.parts_and_suppliers(tables, "1998-03-15")) == [
        (1, "bolt", "s20"), (1, "nut", "s20"), (3, "bolt", "s21"), (9, "bolt", "s21")]


def test_q4_counts_orders(tables):
    assert rows(star.orders_by_nation(tables, "1998-03-15")) == [(3, "CANADA", 2)]
    assert rows(star.orders_by_nation(tables, "1998")) == [(3, "CANADA", 2), (24, "UNITED STATES", 1)]


def test_q5_counts_lineitems_and_pivot_fills_gaps(tables):
    want = [("1998-03", 4, "CANADA"), ("1998-04", 1, "UNITED STATES")]
    assert rows(star.monthly_shipments(tables)) == want
    labels = {3: "ca", 24: "us"}
    assert rows(star.monthly_shipments(tables, [3, 24], labels)) == [(m, n, labels[3] if x == "CANADA" else "us")
                                                                    for m, n, x in want]
    pivot = star.monthly_shipments_pivot(tables, labels)
    assert pivot.columns == ["month", "ca", "us"]
    assert rows(pivot) == [("1998-03", 4, 0), ("1998-04", 0, 1)]


def test_q6_by_hand(tables):
    got = {r.l_returnflag: r for r in star.pricing_summary(tables, "1998-03-15").collect()}
    a = got["A"]
    assert (a.sum_qty, a.sum_base_price, a.count_order) == (3.0, 150.0, 2)
    assert a.sum_disc_price == pytest.approx(140.0) and a.sum_charge == pytest.approx(145.0)
    assert (a.avg_qty, a.avg_price, a.avg_disc) == (1.5, 75.0, pytest.approx(0.05))


def test_q7_orders_before_and_lineitems_after(tables):
    got = rows(star.top_revenue(tables, "1998-03-15"))
    assert got == [("six", 2, 10.0, dt.date(1998, 3, 14), 1)]
    earlier = rows(star.top_revenue(tables, "1998-03-14"))
    assert [(r[1], r[2]) for r in earlier] == [(1, pytest.approx(140.0))]


def test_delimited_files(spark, tmp_path):
    (tmp_path / "nation.tbl").write_text("3|CANADA|1|note|\n24|UNITED STATES|1|note|\n")
    fields = ["1", "10", "20", "1", "5", "100.5", "0.1", "0.02", "N", "O", "1998-03-15", "1998-03-16",
              "1998-03-17", "NONE", "AIR", "words", ""]
    (tmp_path / "lineitem.tbl").write_text("|".join(fields) + "\n")
    t = load_tables(spark, str(tmp_path), ("lineitem", "nation"), fmt="tbl")
    assert rows(t["nation"].select("n_nationkey", "n_name")) == [(3, "CANADA"), (24, "UNITED STATES")]
    line = t["lineitem"].first()
    assert (line.l_orderkey, line.l_extendedprice, line.l_shipdate) == (1, 100.5, DAY)
    assert rows(star.ship_count(t, "1998-03")) == [(1,)]
    assert len(SCHEMAS) == 6
