"""Compare a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


_SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def check(spark, con, query, sf_dir: str) -> tuple[int, list[str]]:
    """Number of rows and a list of problems."""
    frame = query(spark, sf_dir)
    result = con.execute(query.sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, frame.collect())
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
    kinds = {d[0]: str(d[1]) for d in result.description}
    for name, kind in frame.dtypes:
        if name in kinds and _SPARK_TYPES.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} vs {kinds[name]}")
    if sum(actual.values()) != sum(expected.values()):
        problems.append(f"rows {sum(actual.values())} != {sum(expected.values())}")
    if not problems and actual != expected:
        problems.append(f"only here {list((actual - expected).items())[:2]} only there {list((expected - actual).items())[:2]}")
    return sum(actual.values()), problems
