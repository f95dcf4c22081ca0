"""Run registered queries and their SQL side by side: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names, expected = _sorted([d[0] for d in result.description], result.fetchall())
    got_names, got = _sorted(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != got_names:
        return f"columns {got_names} != {names}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a!r} != {b!r}"[:600]
    return None


if __name__ == "__main__":
    from shelfmark.session import build_session
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                found = difference(query(spark, folder), con, oracles[name])
            else:
                found = f"(no SQL) {query(spark, folder).count()} rows"
        except Exception as error:
            found = f"{type(error).__name__}: {error}"[:1500]
        bad += found is not None and not found.startswith("(no")
        print(f"{time.time() - start:6.2f}s {name}: {found or 'equal'}", flush=True)
    print("failed:", bad)
