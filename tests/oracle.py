"""Compare a registered query with its DuckDB text, rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path
from typing import Any

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value: Any) -> Any:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "asDict"):
        return plain(value.asDict(recursive=True))
    return value


def rows(columns: list[str], data: list[Any]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(name: str, fn: Any, sql: str, spark: Any, sf_dir: str) -> None:
    df = fn(spark, sf_dir)
    got = rows(df.columns, df.collect())
    result = connect(sf_dir).execute(sql)
    columns = [d[0] for d in result.description]
    want = rows(columns, result.fetchall())
    assert sorted(columns) == sorted(df.columns), (name, columns, df.columns)
    assert got == want, (name, "only spark:", list((got - want).items())[:3], "only sql:", list((want - got).items())[:3])
