"""Side-by-side check of a Spark query and its DuckDB twin."""

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(dtype: str) -> str:
    d = dtype.lower()
    if d in ("tinyint", "smallint", "int", "integer", "bigint", "hugeint", "long"):
        return "int"
    if d in ("double", "float", "real"):
        return "float"
    if d in ("varchar", "string"):
        return "str"
    if d == "boolean":
        return "bool"
    return d


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        return (2, "nan") if math.isnan(v) else (2, repr(v + 0.0))
    if isinstance(v, int):
        return (2, repr(float(v)) if abs(v) < 2**53 else str(v))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> list[str]:
    """Differences, empty when both sides agree exactly."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    types = {c[0]: str(c[1]) for c in cur.description}
    want = cur.fetchall()
    out = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for c, t in df.dtypes:
        if kind(t) != kind(types[c]):
            out.append(f"type of {c}: {t} != {types[c]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out.append(f"values differ, columns {sorted(names)}: {diff}")
    if not got:
        out.append("empty result")
    return out
