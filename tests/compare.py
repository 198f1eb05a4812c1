"""Compare queries with their DuckDB SQL: python tests/compare.py [--sf DIR] [NAME...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    if hasattr(v, "as_integer_ratio") and not isinstance(v, (int, bool)):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got = bag(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = bag(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    return [f"only Spark {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}; rows {got.total()} {want.total()}"] if got != want else []


if __name__ == "__main__":
    import __spark_entry__ as e
    from tests.conftest import session

    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    spark, con, found, sql = session(), connect(sf), e.queries(), e.oracle_sql()
    for name in args or found:
        start = time.time()
        try:
            wrong = differences(found[name](spark, sf), con, sql[name]) if name in sql else [f"no SQL; {found[name](spark, sf).count()} rows"]
        except Exception as x:  # noqa: BLE001
            wrong = [f"{type(x).__name__}: {str(x)[:600]}"]
        print(f"{name}: {'same' if not wrong else wrong[0]} ({time.time() - start:.1f} s)", flush=True)
