"""Run registered queries against their SQL in DuckDB.

usage: python tools/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from tallywatch.queries import ORACLES, QUERIES
from tallywatch.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns):
    """Rows with columns in name order, sorted; floats as they are."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(row[i] for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        return None if got else "no rows"
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in cursor.description}
    odd = {
        c: (t, types[c]) for c, t in df.dtypes if SQL_TYPES.get(t, t).lower() != types[c].lower()
    }
    if odd:
        return f"types {odd}"
    want = canonical(cursor.fetchall(), columns)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if not all(map(same, g, w))]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare",
        spark_master="local[8]",
        spark_sql_shuffle_partitions="8",
        spark_driver_memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} failed")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
