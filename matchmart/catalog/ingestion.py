"""Queries over sources, manifests, lineage and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.catalog import fixtures
from matchmart.catalog.lake import Lake
from matchmart.catalog.oracles import as_text, over_documents, over_manifest
from matchmart.catalog.registry import query
from matchmart.contracts import CONTRACTS, STG_DELIVERY, STG_MATCH, STG_PLAYER, length_report
from matchmart.sources import checksums, documents, manifests, sinks
from matchmart.sources.landed import LandedRuns

_RECORD = ("uri", "stg_file_name", "stg_file_hashkey", "ingested_at", "size_bytes", "action", "ingest_date", "run_id")
_RECORD_SQL = ", ".join(_RECORD)


def _file_records(lake: Lake) -> DataFrame:
    return lake.event_manifest().where(F.col("record_type") == manifests.FILE_RECORD)


@query("SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size_bytes, sha256(text) AS stg_file_hashkey FROM documents")
def checksum_scan(lake: Lake) -> DataFrame:
    rows = checksums.with_checksum(lake.table("documents"), "text")
    return rows.select("doc_id", F.octet_length("text").cast("bigint").alias("size_bytes"), "stg_file_hashkey")


@query("""
    WITH scan AS (SELECT doc_id, sha256(text) AS digest FROM documents),
    landed AS (SELECT doc_id, sha256(CASE WHEN doc_id % 5 = 0 THEN text || 'x' ELSE text END) AS digest
               FROM documents WHERE doc_id % 3 <> 0)
    SELECT s.doc_id, s.digest, CASE WHEN l.doc_id IS NULL THEN 'new' WHEN l.digest = s.digest THEN 'unchanged'
                                    ELSE 'changed' END AS status
    FROM scan s LEFT JOIN landed l USING (doc_id)""")
def change_detection(lake: Lake) -> DataFrame:
    scan = fixtures.document_scan(lake.spark, lake.sf_dir)
    landed = fixtures.landed_documents(lake.spark, lake.sf_dir)
    return checksums.detect_changes(scan, landed, "doc_id", "digest")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY 2")
def content_dedupe(lake: Lake) -> DataFrame:
    return checksums.first_per_content(fixtures.document_scan(lake.spark, lake.sf_dir), "doc_id", "digest")


@query(over_manifest("""
    SELECT record_type, object_key, uri, stg_file_name, stg_file_hashkey, ingested_at, size_bytes, source_url, action,
           ingest_date, run_id FROM manifest
    UNION ALL
    SELECT DISTINCT 'run', NULL, NULL, NULL, NULL, NULL, CAST(NULL AS BIGINT), NULL, NULL, ingest_date, run_id
    FROM manifest"""))
def manifest_roundtrip(lake: Lake) -> DataFrame:
    return lake.event_manifest().drop("manifest_path")


@query(over_manifest(f"SELECT {_RECORD_SQL} FROM manifest WHERE run_id = (SELECT max(run_id) FROM manifest)"))
def newest_run(lake: Lake) -> DataFrame:
    newest = manifests.newest_run(lake.event_manifest())
    return newest.where(F.col("record_type") == manifests.FILE_RECORD).select(*_RECORD)


@query(over_manifest(f"SELECT {_RECORD_SQL} FROM manifest WHERE ingest_date = '2024-01-15'"))
def run_for_date(lake: Lake) -> DataFrame:
    return manifests.run_for_date(_file_records(lake), "2024-01-15").select(*_RECORD)


@query(over_manifest(f"SELECT {_RECORD_SQL} FROM manifest WHERE action = 'uploaded'"))
def action_filter(lake: Lake) -> DataFrame:
    return manifests.with_action(_file_records(lake), manifests.UPLOADED).select(*_RECORD)


@query(over_manifest(f"""
    SELECT {_RECORD_SQL} FROM (
      SELECT *, row_number() OVER (PARTITION BY uri ORDER BY ingested_at DESC NULLS LAST,
                                   stg_file_hashkey DESC NULLS LAST) AS rn
      FROM manifest WHERE action = 'uploaded')
    WHERE rn = 1"""))
def latest_per_uri(lake: Lake) -> DataFrame:
    entries = manifests.select_entries(lake.event_manifest(), mode="all", action=manifests.UPLOADED)
    return entries.select(*_RECORD)


_LANDED_SQL = """
    SELECT uri, stg_file_hashkey FROM (
      SELECT uri, stg_file_hashkey, row_number() OVER (PARTITION BY uri ORDER BY ingested_at DESC NULLS LAST,
                                                       stg_file_hashkey DESC NULLS LAST) AS rn
      FROM manifest WHERE action = 'uploaded')
    WHERE rn = 1"""


def _landed(lake: Lake) -> LandedRuns:
    """The state of all runs of the event manifest, taken over in parts of a few days, the latest first."""
    def write(path: str) -> None:
        state, records = LandedRuns(lake.spark, path, 4), _file_records(lake)
        runs = sorted((r[0] for r in records.select("run_id").distinct().collect()), reverse=True)
        size = -(-len(runs) // 6)
        for at in range(0, len(runs), size):
            some = runs[at : at + size]
            state.add(records.where(F.col("run_id").isin(some)), some)

    return LandedRuns(lake.spark, lake.space.once("landed_runs", write), 4)


@query(over_manifest(f"""
    SELECT uri, stg_file_hashkey FROM ({_LANDED_SQL}) WHERE CAST(regexp_extract(uri, '([0-9]+)[.]json', 1) AS INTEGER) % 3 = 0"""))
def landed_state_lookup(lake: Lake) -> DataFrame:
    """The landed checksums of some scanned files, joined with the sorted runs in their buckets."""
    number = F.regexp_extract("uri", r"(\d+)[.]json", 1).cast("int")
    scan = _file_records(lake).where(number % 3 == 0).select("uri")
    return _landed(lake).of(scan)


@query(over_manifest(_LANDED_SQL))
def landed_state_runs(lake: Lake) -> DataFrame:
    """The whole state from compacted runs equals the latest upload of every file over all manifests."""
    return _landed(lake).state()


@query(over_manifest("""
    SELECT run_id, action, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM manifest GROUP BY 1, 2"""))
def run_audit(lake: Lake) -> DataFrame:
    return manifests.run_audit(_file_records(lake))


@query(over_documents("""
    SELECT l.stg_file_name, s.match_type_number, s.season, 2 AS teams, 20 AS squad_names,
           CASE WHEN b.balls IS NULL THEN NULL ELSE 2 END AS innings,
           coalesce(b.overs, 0) AS overs, coalesce(b.balls, 0) AS balls, coalesce(b.outs, 0) AS wickets
    FROM lineage l
    JOIN stg_match s USING (stg_file_name)
    LEFT JOIN (SELECT m, part, count(DISTINCT (innings, over_no)) AS overs, count(*) AS balls,
                      CAST(sum(outs) AS BIGINT) AS outs
               FROM fx_ball GROUP BY 1, 2) b USING (m, part)"""))
def scorecard_roundtrip(lake: Lake) -> DataFrame:
    """Every document listed by the manifest, read back from its JSON text and measured."""
    raw = lake.raw()
    entries = manifests.select_entries(fixtures.document_manifest(raw), mode="all")
    listed = documents.only_listed(raw, raw, documents.listed_keys(entries), lake.space)
    parsed = documents.well_formed(documents.parse(listed))
    overs = F.flatten(F.col("innings.overs"))
    balls = F.flatten(F.transform(overs, lambda o: o["deliveries"]))
    wickets = F.filter(F.transform(balls, lambda b: F.size(b["wickets"])), lambda n: n > 0)
    total = F.aggregate(wickets, F.lit(0).cast("bigint"), lambda a, n: a + n.cast("bigint"))

    def counted(c):
        return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))

    return parsed.select(
        "stg_file_name", F.col("info.match_type_number"), F.col("info.season"), F.size("info.teams").alias("teams"),
        F.size(F.flatten(F.map_values("info.players"))).alias("squad_names"),
        F.when(F.col("innings").isNotNull(), F.size("innings")).alias("innings"),
        counted(F.when(overs.isNotNull(), F.size(overs))).alias("overs"),
        counted(F.when(balls.isNotNull(), F.size(balls))).alias("balls"),
        F.ifnull(total, F.lit(0).cast("bigint")).alias("wickets"),
    )


def _partly_listed(lake: Lake) -> DataFrame:
    """Documents joined with a manifest that lacks some of them."""
    raw = lake.raw()
    number = F.regexp_extract("stg_file_name", r"^(\d+)", 1).cast("bigint")
    entries = fixtures.document_manifest(raw).where(number % 97 != 0)
    return documents.attach_manifest(raw.select("_source"), entries)


@query(over_documents("""
    SELECT 'file:/landing/' || stg_file_name AS _source, stg_file_name, 1 AS stg_file_row_number,
           CASE WHEN m % 97 <> 0 THEN stg_file_hashkey END AS stg_file_hashkey,
           CASE WHEN m % 97 <> 0 THEN ingest_date END AS ingest_date
    FROM lineage"""))
def lineage_columns(lake: Lake) -> DataFrame:
    rows = documents.with_lineage(_partly_listed(lake), "2024-01-06 00:00:00")
    return rows.select("_source", "stg_file_name", "stg_file_row_number", "stg_file_hashkey", "ingest_date")


@query(over_documents("SELECT 'file:/landing/' || stg_file_name AS _source FROM lineage WHERE m % 97 = 0"))
def unmatched_documents(lake: Lake) -> DataFrame:
    return documents.unmatched(_partly_listed(lake)).select("_source")


@query(over_documents("""
    SELECT match_type_number, event_name, ingest_date, run_id FROM stg_match"""))
def history_sink(lake: Lake) -> DataFrame:
    """Written twice under its partitions and read back: a rerun replaces, it does not append."""
    path, rows = lake.space.fresh("history"), lake.staged("match")
    sinks.write_history(rows, path, gather=True)
    sinks.write_history(rows, path, gather=True)
    return sinks.read_history(lake.spark, path, STG_MATCH).select(
        "match_type_number", "event_name", "ingest_date", "run_id"
    )


def _latest(lake: Lake, name: str) -> str:
    """The newest run's slice of a staging history, at a fixed sibling location."""
    history = lake.staged(name)
    path = lake.space.fresh(f"latest-{name}")
    run = history.agg(F.max("run_id")).first()[0]
    sinks.write_latest(history, path, run)
    return path


@query(over_documents("""
    SELECT match_type_number, stg_file_name, ingest_date, run_id FROM stg_match
    WHERE run_id = (SELECT max(run_id) FROM stg_match)"""))
def latest_slice(lake: Lake) -> DataFrame:
    rows = lake.spark.read.schema(STG_MATCH.read_schema).parquet(_latest(lake, "match"))
    return rows.select("match_type_number", "stg_file_name", "ingest_date", "run_id")


@query(over_documents(as_text("SELECT * FROM stg_match", "event_date")))
def csv_sink(lake: Lake) -> DataFrame:
    path = lake.space.fresh("csv")
    sinks.write_csv(lake.staged("match"), path)
    return lake.spark.read.schema(STG_MATCH.read_schema).option("header", True).csv(path)


@query(over_documents("""
    SELECT match_type_number, innings_number, over, ball_in_over, wicket_index, batter, total, stg_file_hashkey
    FROM stg_delivery WHERE run_id = (SELECT max(run_id) FROM stg_delivery)"""))
def staging_load(lake: Lake) -> DataFrame:
    loaded = sinks.load_staging(lake.spark, _latest(lake, "delivery"), STG_DELIVERY, lake.space.fresh("stg"))
    return loaded.select(
        "match_type_number", "innings_number", "over", "ball_in_over", "wicket_index", "batter", "total",
        "stg_file_hashkey",
    )


def _length_sql(table: str, contract: str) -> list[str]:
    return [
        f"SELECT '{contract}' AS table_name, '{column}' AS column_name, {n} AS max_length,"
        f" CAST(coalesce(max(length({column})), 0) AS INTEGER) AS longest,"
        f" count(*) FILTER (length({column}) > {n}) AS rows_over FROM {table}"
        for column, n in CONTRACTS[contract].lengths.items()
    ]


@query(over_documents(" UNION ALL ".join(
    _length_sql("stg_match", "match_table") + _length_sql("stg_player", "player_table")
    + _length_sql("stg_delivery", "delivery_table"))))
def contract_check(lake: Lake) -> DataFrame:
    parts = [
        length_report(lake.staged(name), contract)
        for name, contract in (("match", STG_MATCH), ("player", STG_PLAYER), ("delivery", STG_DELIVERY))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
