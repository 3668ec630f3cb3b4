"""The warehouse under SQL names: layers ``stg``, ``dw`` and ``mart``.

Views over the current files. Publishing again after a load moves them to the
new versions; queries see a consistent set between two calls. Versions that no
view shows any more are removed then.
"""

from __future__ import annotations

from matchmart.contracts import (
    DIM_DATE,
    DIM_PLAYER,
    DIM_TEAM,
    DIM_VENUE,
    Contract,
    create_layers,
)
from matchmart.plans.warehouse import STAGING, Warehouse
from matchmart.sources.sinks import BucketedTable

_DIMENSIONS = {"team": DIM_TEAM, "player": DIM_PLAYER, "venue": DIM_VENUE, "date": DIM_DATE}


#: the stored sums under the names the dimensions have
_SUMMARY_VIEW = """
CREATE OR REPLACE VIEW mart.batsman_summary_mv AS
SELECT s.player_id, lower(p.full_name) AS batsman_name, t.team_name, o.team_name AS opponent_team, s.match_id,
       m.event_name, m.match_type, m.event_date, m.season,
       s.runs_scored, s.extras, s.fours, s.sixes, s.balls_faced, s.times_out,
       CAST(CASE WHEN s.times_out > 0 THEN round(CAST(s.runs_scored AS DECIMAL(20, 4)) / s.times_out, 2) END AS DOUBLE) AS batting_average,
       CAST(CASE WHEN s.balls_faced > 0 THEN round(CAST(s.runs_scored * 100 AS DECIMAL(20, 4)) / s.balls_faced, 2) END AS DOUBLE) AS strike_rate
FROM mart.batsman_summary_sums s
JOIN dw.dim_player p ON p.player_id = s.player_id
JOIN dw.dim_team t ON t.team_id = p.team_id
JOIN dw.dim_match m ON m.match_id = s.match_id
JOIN dw.dim_team o ON o.team_id = s.bowling_team_id
"""


def _columns(contract: Contract | None) -> str:
    if contract is None:
        return "*"
    return ", ".join(f"CAST(t.`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in contract.read_schema)


def _view(warehouse: Warehouse, name: str, path: str, contract: Contract | None = None) -> None:
    warehouse.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {_columns(contract)} FROM parquet.`{path}` t")


def _bucketed_view(warehouse: Warehouse, name: str, table: BucketedTable) -> None:
    """The versions that count now, found by their folders."""
    warehouse.spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {_columns(table.contract)} FROM parquet.`{table.rows}` t"
        f" LEFT SEMI JOIN parquet.`{table.record.location()}` r ON t.version = r.version AND t.bucket <=> r.bucket"
    )


def publish(warehouse: Warehouse) -> list[str]:
    """Create or move the views; returns their names."""
    create_layers(warehouse.spark)
    views = {f"stg.{c.name}": (f"{warehouse.root}/stg_{n}", c) for n, (c, _) in STAGING.items()}
    views |= {f"dw.dim_{d}": (warehouse.snapshots[d].location(), c) for d, c in _DIMENSIONS.items()}
    tables = {"dw.dim_match": warehouse.match_table, "dw.fact_delivery": warehouse.fact_table}
    marts = warehouse.summary_table.exists()
    if marts:
        tables["mart.batsman_summary_sums"] = warehouse.summary_table
        views["mart.batsman_career_mv"] = (warehouse.career.location(), None)
        views["mart.batsman_career_ext_mv"] = (warehouse.career_ext.location(), None)
        views["mart.batsman_dismissal_mv"] = (warehouse.dismissal.location(), None)
    for name, (path, contract) in views.items():
        _view(warehouse, name, path, contract)
    for name, table in tables.items():
        _bucketed_view(warehouse, name, table)
    names = [*views, *tables]
    if marts:
        warehouse.spark.sql(_SUMMARY_VIEW)
        names.append("mart.batsman_summary_mv")
    warehouse.clean()
    return sorted(names)
