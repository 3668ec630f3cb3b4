"""Copies of the test tables in which one key holds a third of the rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

_HOT = {
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 77 ELSE l_orderkey END AS l_orderkey) FROM t",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_custkey END AS o_custkey) FROM t",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 9 ELSE user_id END AS user_id) FROM t",
    "documents": "SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'same text' ELSE text END AS text) FROM t",
}


def write(source: str, target: Path) -> str:
    target.mkdir(parents=True, exist_ok=True)
    con = duckdb.connect()
    for f in sorted(Path(source).glob("*.parquet")):
        con.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{f}')")
        con.execute(f"COPY ({_HOT.get(f.stem, 'SELECT * FROM t')}) TO '{target / f.name}' (FORMAT parquet)")
    return str(target)
