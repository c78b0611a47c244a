"""Spark result against DuckDB result: names, types, row count, values in any order."""

import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def differences(df, con, sql, limit=3):
    """Empty when equal, else a few lines that say how they differ."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(df.columns)
    if sorted(names) != order:
        return [f"columns {order} != {sorted(names)}"]
    out = [
        f"type of {f.name}: {f.dataType.simpleString()} != {kinds[f.name]}"
        for f in df.schema if _TYPES.get(f.dataType.simpleString()) != kinds[f.name]
    ]
    at = [names.index(c) for c in order]
    want = sorted([tuple(_norm(r[i]) for i in at) for r in cursor.fetchall()], key=_sort_key)
    got = sorted([tuple(_norm(r[c]) for c in order) for r in df.collect()], key=_sort_key)
    if len(want) != len(got):
        out.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ")
        for g, w in bad[:limit]:
            out.append("; ".join(f"{c}: {a!r} != {b!r}" for c, a, b in zip(order, g, w) if a != b))
    return out
