"""Schemas and table contracts (types, lengths, keys, references).

Fixed values: column names, types and lengths of the documents and tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- input documents -------------------------------------------------------

_WICKET = "STRUCT<player_out: STRING, kind: STRING, fielders: ARRAY<STRUCT<name: STRING>>>"
_DELIVERY = (
    "STRUCT<bowler: STRING, batter: STRING, non_striker: STRING,"
    " runs: STRUCT<batter: INT, extras: INT, total: INT>,"
    f" wickets: ARRAY<{_WICKET}>>"
)
_INNINGS = f"STRUCT<team: STRING, overs: ARRAY<STRUCT<over: INT, deliveries: ARRAY<{_DELIVERY}>>>>"
_INFO = (
    "STRUCT<match_type_number: BIGINT,"
    " event: STRUCT<name: STRING, match_number: STRING, stage: STRING>,"
    " dates: ARRAY<STRING>, match_type: STRING, season: STRING, team_type: STRING,"
    " overs: INT, city: STRING, venue: STRING, gender: STRING, teams: ARRAY<STRING>,"
    " outcome: STRUCT<winner: STRING, result: STRING>,"
    " toss: STRUCT<winner: STRING, decision: STRING>,"
    " players: MAP<STRING, ARRAY<STRING>>>"
)

CORRUPT_COLUMN = "_corrupt_record"
DOCUMENT_DDL = f"info {_INFO}, innings ARRAY<{_INNINGS}>, {CORRUPT_COLUMN} STRING"

# --- run manifests ---------------------------------------------------------

MANIFEST_COLUMNS = (
    "record_type", "object_key", "uri", "stg_file_name", "stg_file_hashkey",
    "ingested_at", "size_bytes", "source_url", "action",
)
MANIFEST_DDL = (
    "record_type STRING, object_key STRING, uri STRING, stg_file_name STRING,"
    " stg_file_hashkey STRING, ingested_at STRING, size_bytes BIGINT, source_url STRING,"
    " action STRING, ingest_date DATE, run_id STRING"
)

# --- tables ----------------------------------------------------------------

LINEAGE = (
    "stg_file_name", "stg_file_row_number", "stg_file_hashkey", "stg_modified_ts", "ingest_date",
)
#: the lineage columns plus the run that brought the document in
RUN_LINEAGE = LINEAGE + ("run_id",)

_LINEAGE_DDL = (
    "stg_file_name VARCHAR(512), stg_file_row_number INT, stg_file_hashkey VARCHAR(256),"
    " stg_modified_ts TIMESTAMP, ingest_date DATE, run_id STRING"
)


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "SMALLINT": T.ShortType(), "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
}


def _type(kind: str) -> T.DataType:
    return T.VarcharType(int(kind[len("VARCHAR("):-1])) if kind.startswith("VARCHAR(") else _TYPES[kind]


@dataclass(frozen=True)
class Contract:
    """One table: column DDL, primary key, further unique columns, foreign keys.

    ``sort`` is the order rows are clustered in when the table is written.
    ``references`` maps a column to ``(table, column)``.
    """

    name: str
    layer: str
    ddl: str
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """The column DDL as a schema; unlike ``fromDDL`` it needs no running session."""
        fields = []
        for column in self.ddl.split(","):
            name, kind, *rest = column.split()
            fields.append(T.StructField(name, _type(kind), nullable=rest != ["NOT", "NULL"]))
        return T.StructType(fields)

    @property
    def read_schema(self) -> T.StructType:
        """The schema files are read with: plain strings, everything nullable."""
        return T.StructType([T.StructField(f.name, _plain(f.dataType), True) for f in self.schema])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def lengths(self) -> dict[str, int]:
        """Declared length per character column."""
        return {f.name: f.dataType.length for f in self.schema if isinstance(f.dataType, T.VarcharType)}


def _plain(data_type: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(data_type, T.VarcharType) else data_type


STG_MATCH = Contract(
    "match_table", "stg",
    "match_type_number BIGINT NOT NULL, event_name VARCHAR(256), match_stage VARCHAR(64), event_date DATE,"
    " event_year INT, event_month INT, event_day INT, match_type VARCHAR(64), season VARCHAR(64),"
    " team_type VARCHAR(32), overs INT, city VARCHAR(128), venue VARCHAR(256), gender VARCHAR(16),"
    " first_team VARCHAR(128), second_team VARCHAR(128), match_result VARCHAR(64), winner VARCHAR(128),"
    f" toss_winner VARCHAR(128), toss_decision VARCHAR(16), {_LINEAGE_DDL}",
    key=("match_type_number",), sort=("event_date", "match_type_number"),
)
STG_PLAYER = Contract(
    "player_table", "stg",
    f"match_type_number BIGINT NOT NULL, country VARCHAR(128), player_name VARCHAR(256), {_LINEAGE_DDL}",
    key=("match_type_number", "country", "player_name"), sort=("match_type_number",),
)
STG_DELIVERY = Contract(
    "delivery_table", "stg",
    "match_type_number BIGINT NOT NULL, innings_number INT, country VARCHAR(128), over INT, ball_in_over INT,"
    " bowler VARCHAR(256), batter VARCHAR(256), non_striker VARCHAR(256), runs INT, extras INT, total INT,"
    " player_out VARCHAR(256), player_out_kind VARCHAR(64), player_out_fielders VARCHAR(512),"
    f" wicket_index INT, {_LINEAGE_DDL}",
    key=("match_type_number", "innings_number", "over", "ball_in_over"),
    sort=("match_type_number", "innings_number", "over", "ball_in_over"),
)
DIM_TEAM = Contract(
    "dim_team", "dw",
    "team_id BIGINT NOT NULL, team_key VARCHAR(256) NOT NULL, team_name VARCHAR(128) NOT NULL, created_at TIMESTAMP,"
    " named_at DATE",
    key=("team_id",), unique=("team_key",),
)
DIM_PLAYER = Contract(
    "dim_player", "dw",
    "player_id BIGINT NOT NULL, player_key VARCHAR(512) NOT NULL, full_name VARCHAR(256) NOT NULL,"
    " team_id BIGINT NOT NULL, created_at TIMESTAMP, named_at DATE",
    key=("player_id",), unique=("player_key",), references={"team_id": ("dim_team", "team_id")},
)
DIM_VENUE = Contract(
    "dim_venue", "dw",
    "venue_id BIGINT NOT NULL, venue_key VARCHAR(512) NOT NULL, venue_name VARCHAR(256), city VARCHAR(128),"
    " country VARCHAR(64), named_at DATE",
    key=("venue_id",), unique=("venue_key",),
)
DIM_DATE = Contract(
    "dim_date", "dw",
    "date_key INT NOT NULL, full_date DATE NOT NULL, year INT, month INT, day INT, week INT, quarter INT,"
    " season VARCHAR(16), weekday INT",
    key=("date_key",), unique=("full_date",),
)
DIM_MATCH = Contract(
    "dim_match", "dw",
    "match_id BIGINT NOT NULL, event_name VARCHAR(256), match_type VARCHAR(64), match_stage VARCHAR(64),"
    " date_key INT NOT NULL, event_date DATE NOT NULL, season VARCHAR(64), team_type VARCHAR(32), overs INT,"
    " venue_id BIGINT, gender VARCHAR(16), first_team_id BIGINT, second_team_id BIGINT, match_result VARCHAR(64),"
    " winner_team_id BIGINT, toss_winner_id BIGINT, toss_decision VARCHAR(16), stg_file_name VARCHAR(512),"
    " stg_file_hashkey VARCHAR(256), ingest_date DATE, stg_modified_ts TIMESTAMP",
    key=("match_id",), sort=("event_date", "match_id"),
    references={
        "date_key": ("dim_date", "date_key"),
        "venue_id": ("dim_venue", "venue_id"),
        "first_team_id": ("dim_team", "team_id"),
        "second_team_id": ("dim_team", "team_id"),
        "winner_team_id": ("dim_team", "team_id"),
        "toss_winner_id": ("dim_team", "team_id"),
    },
)
FACT_KEY = ("match_id", "innings_number", "over_number", "ball_in_over")
FACT_DELIVERY = Contract(
    "fact_delivery", "dw",
    "match_id BIGINT NOT NULL, innings_number INT NOT NULL, over_number INT NOT NULL, ball_in_over INT NOT NULL,"
    " striker_id BIGINT, non_striker_id BIGINT, bowler_id BIGINT, batting_team_id BIGINT, bowling_team_id BIGINT,"
    " runs_off_bat SMALLINT, extras SMALLINT, total_runs SMALLINT, is_boundary_4 BOOLEAN, is_boundary_6 BOOLEAN,"
    " is_wicket BOOLEAN, wicket_kind VARCHAR(64), fielder_names VARCHAR(512),"
    " stg_file_hashkey VARCHAR(256), ingest_date DATE, stg_modified_ts TIMESTAMP",
    key=FACT_KEY, sort=FACT_KEY,
    references={
        "match_id": ("dim_match", "match_id"),
        "striker_id": ("dim_player", "player_id"),
        "non_striker_id": ("dim_player", "player_id"),
        "bowler_id": ("dim_player", "player_id"),
        "batting_team_id": ("dim_team", "team_id"),
        "bowling_team_id": ("dim_team", "team_id"),
    },
)
#: staged rows that the fact refused
FACT_REJECTS = Contract(
    "fact_rejects", "dw",
    "match_id BIGINT, innings_number INT, over_number INT, ball_in_over INT, batting_key STRING, stg_file_name STRING,"
    " stg_file_hashkey STRING, ingest_date DATE, stg_modified_ts TIMESTAMP, broken_rules BIGINT, reasons STRING, run_id STRING",
    key=(),
)
#: what is stored of the summary: ids and sums; names are joined when it is read
MART_SUMMARY_SUMS = Contract(
    "batsman_summary_sums", "mart",
    "player_id BIGINT NOT NULL, match_id BIGINT NOT NULL, bowling_team_id BIGINT NOT NULL,"
    " runs_scored BIGINT, extras BIGINT, fours BIGINT, sixes BIGINT, balls_faced BIGINT, times_out BIGINT",
    key=("player_id", "match_id", "bowling_team_id"), sort=("match_id", "player_id"),
)
#: sums that add up to every mart: one row per match, batsman, opponent, innings and kind of wicket
MART_PARTIALS = Contract(
    "batting_partials", "mart",
    "match_id BIGINT NOT NULL, match_no BIGINT NOT NULL, player_id BIGINT, bowling_team_id BIGINT, innings_number INT,"
    " wicket_kind STRING, runs BIGINT, extras BIGINT, fours BIGINT, sixes BIGINT, balls BIGINT, outs BIGINT, last_over INT",
    key=("match_id", "player_id", "bowling_team_id", "innings_number", "wicket_kind"), sort=("match_id", "player_id"),
)
MATCH_NUMBERS = Contract("match_numbers", "mart", "match_id BIGINT NOT NULL, match_no BIGINT NOT NULL", key=("match_id",))
#: the matches of a batsman as bits, one row per 32 768 match numbers
MATCH_SETS = Contract(
    "match_sets", "mart", "match_set INT NOT NULL, player_id BIGINT NOT NULL, matches BINARY",
    key=("match_set", "player_id"), sort=("player_id",),
)
MART_SUMMARY = Contract(
    "batsman_summary", "mart",
    "player_id BIGINT NOT NULL, batsman_name STRING, team_name STRING, opponent_team STRING NOT NULL,"
    " match_id BIGINT NOT NULL, event_name STRING, match_type STRING, event_date DATE, season STRING,"
    " runs_scored BIGINT, extras BIGINT, fours BIGINT, sixes BIGINT, balls_faced BIGINT, times_out BIGINT,"
    " batting_average DOUBLE, strike_rate DOUBLE",
    key=("player_id", "match_id", "opponent_team"), sort=("match_id", "player_id"),
)

CONTRACTS = {
    c.name: c
    for c in (STG_MATCH, STG_PLAYER, STG_DELIVERY, DIM_TEAM, DIM_PLAYER, DIM_VENUE, DIM_DATE, DIM_MATCH, FACT_DELIVERY, MART_SUMMARY, MART_SUMMARY_SUMS)
}
LAYERS = ("stg", "dw", "mart")


def conform(frame: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns in order, cast to its types.

    Columns the frame lacks become NULL; ANSI casts raise on overflow.
    """
    present = set(frame.columns)

    def one(f: T.StructField) -> Column:
        value = F.col(f.name) if f.name in present else F.lit(None)
        return value.cast(_plain(f.dataType)).alias(f.name)

    return frame.select(*[one(f) for f in contract.schema])


def length_report(frame: DataFrame, contract: Contract) -> DataFrame:
    """Per character column: declared length, longest value, rows beyond it. One pass."""
    lengths = contract.lengths
    sums = frame.agg(
        *[F.coalesce(F.max(F.length(c)), F.lit(0)).alias(f"{c}__longest") for c in lengths],
        *[F.count_if(F.length(c) > n).alias(f"{c}__over") for c, n in lengths.items()],
    )
    rows = F.array(*[
        F.struct(
            F.lit(contract.name).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.lit(n).alias("max_length"),
            F.col(f"{c}__longest").alias("longest"),
            F.col(f"{c}__over").alias("rows_over"),
        )
        for c, n in lengths.items()
    ])
    return sums.select(F.inline(rows))


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def create_table(spark: SparkSession, contract: Contract, location: str, replace: bool = False) -> str:
    """Register the contract as an external Parquet table with enforced lengths."""
    name = f"{contract.layer}.{contract.name}"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({contract.ddl}) USING parquet LOCATION '{location}'")
    return name
