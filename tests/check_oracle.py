"""Compare registered queries with their oracles: check_oracle.py SF_DIR [key ...]."""

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return "" if v is None else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    """(rows, problem or None)."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return len(got), f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from conftest import session

    import __spark_entry__ as entry

    spark, con = session(), database(sys.argv[1])
    queries, oracles = entry.queries(), entry.oracle_sql()
    for key in sys.argv[2:] or queries:
        start = time.time()
        try:
            if key in oracles:
                n, problem = compare(spark, con, sys.argv[1], queries[key], oracles[key])
            else:
                n, problem = len(queries[key](spark, sys.argv[1]).collect()), "no oracle"
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{key:28} {n:8} rows {time.time() - start:7.2f} s  {problem or 'equal'}", flush=True)
