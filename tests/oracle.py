"""Compare a registered query with its SQL on DuckDB, as sorted rows with columns in the order of names."""

from __future__ import annotations

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(canon, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{canon(x)}" for k, x in v.items()) + "}"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def rows(names: list[str], data) -> list[tuple[str, ...]]:
    at = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(canon(r[k]) for k in at) for r in data)


def differences(spark_df, con, sql: str) -> str:
    """Empty if both give the same rows; else what differs."""
    got = rows(spark_df.columns, [tuple(_plain(x) for x in r) for r in spark_df.collect()])
    rel = con.sql(sql)
    want = rows(rel.columns, rel.fetchall())
    if sorted(spark_df.columns) != sorted(rel.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(rel.columns)}"
    if got == want:
        return ""
    a, b = set(got), set(want)
    return f"{len(got)} and {len(want)} rows; only Spark {sorted(a - b)[:2]}; only SQL {sorted(b - a)[:2]}"


def _plain(v):
    from pyspark.sql import Row

    if isinstance(v, Row):
        return {k: _plain(x) for k, x in v.asDict().items()}
    return [_plain(x) for x in v] if isinstance(v, list) else v
