"""Compare a Spark result with the same SQL in DuckDB: columns, rows and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(d).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def _plain(v):  # noqa: ANN001, ANN202
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T00:00:00", "").replace(" 00:00:00", "")
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return f"{v:.7g}" if v != int(v) or abs(v) > 1e15 else str(int(v))
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows(names: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(_plain(r[k]) for k in order) for r in data), key=lambda r: tuple((x is None, x or "") for x in r))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:  # noqa: ANN001
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    want = rows(names, got.fetchall())
    have = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(have) != len(want):
        return f"{len(have)} rows against {len(want)}"
    bad = [(a, b) for a, b in zip(have, want) if a != b]
    return f"{len(bad)} of {len(want)} rows differ, first {bad[0]}" if bad else ""
