"""Run registered queries against DuckDB and compare exactly."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    return type(value).__name__


def norm(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = Counter()
    kinds = {columns[i]: set() for i in order}
    for row in rows:
        for i in order:
            if row[i] is not None:
                kinds[columns[i]].add(kind(row[i]))
        out[tuple(norm(row[i]) for i in order)] += 1
    return [columns[i] for i in order], out, kinds


def compare(spark, con, sf_dir, name, fn, sql):
    """Empty string when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[2] != want[2]:
        return f"types { {k: (v, want[2][k]) for k, v in got[2].items() if v != want[2][k]} }"
    if got[1] != want[1]:
        extra, missing = got[1] - want[1], want[1] - got[1]
        return (
            f"rows {sum(got[1].values())} vs {sum(want[1].values())}; only spark {list(extra.items())[:2]}; "
            f"only sql {list(missing.items())[:2]}; {sum(extra.values())}/{sum(missing.values())} differ"
        )
    if not got[1]:
        return "no rows"
    return ""
