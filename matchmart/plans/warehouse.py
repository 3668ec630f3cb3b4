"""The pipeline: parsed documents, staging history, dimensions, fact.

One folder per table below the root. Every step reads files the step before
wrote, so each input is parsed or derived once.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import FACT_REJECTS, STG_DELIVERY, STG_MATCH, STG_PLAYER, conform
from matchmart.functions.keys import OVERS_PER_BUCKET, match_bucket
from matchmart.operators import flatten
from matchmart.operators.layout import by_folder
from matchmart.plans import dims, marts
from matchmart.plans.fact import fact_delivery, fact_table, split_deliveries
from matchmart.plans.ledger import Ledger
from matchmart.plans.mart_store import MartStore, summary_of
from matchmart.sources import documents as docs
from matchmart.sources.sinks import Snapshots, read_history, write_history
from matchmart.workspace import Workspace, exists, together

STAGING = {
    "match": (STG_MATCH, flatten.match_table),
    "player": (STG_PLAYER, flatten.player_table),
    "delivery": (STG_DELIVERY, flatten.delivery_table),
}
#: dimensions that stay small next to the documents and are rewritten whole
SMALL_DIMENSIONS = ("team", "venue", "player", "date")


class Warehouse:
    """``buckets`` is fixed for the life of the tables; choose it so that a fact bucket holds a few gigabytes."""

    def __init__(self, space: Workspace, root: str | None = None, buckets: int = 64):
        self.space, self.spark = space, space.spark
        self.root = root or space.path("warehouse")
        self.snapshots = {d: Snapshots(self.spark, f"{self.root}/dim_{d}") for d in SMALL_DIMENSIONS}
        self.match_table = dims.match_dimension(space, f"{self.root}/dim_match", max(1, buckets // 8))
        self.fact_table = fact_table(space, f"{self.root}/fact_delivery", buckets)
        self.summary_table = marts.summary_table(space, f"{self.root}/batsman_summary_sums", max(1, buckets // 4))
        self.mart_store = MartStore(space, f"{self.root}/mart_store", max(1, buckets // 8))
        self.ledger = Ledger(space, f"{self.root}/ledger")
        self.career = Snapshots(self.spark, f"{self.root}/batsman_career")
        self.career_ext = Snapshots(self.spark, f"{self.root}/batsman_career_ext")
        self.dismissal = Snapshots(self.spark, f"{self.root}/batsman_dismissal")

    # --- documents ---------------------------------------------------------

    def land(self, raw: DataFrame, loaded_at: datetime | Column | str) -> None:
        """Parse raw bundles once into typed nested Parquet, replacing the runs they belong to."""
        parsed = docs.with_lineage(docs.parse(raw), loaded_at)
        by_folder(parsed, "run_id").parquet(f"{self.root}/documents")

    def _landed(self) -> DataFrame:
        ddl = (
            f"{docs.DOCUMENT_DDL}, _source STRING, stg_file_name STRING, stg_file_hashkey STRING,"
            " stg_file_row_number INT, stg_modified_ts TIMESTAMP, ingest_date DATE, run_id STRING"
        )
        return self.spark.read.schema(ddl).parquet(f"{self.root}/documents")

    def documents(self, runs: list[str] | None = None) -> DataFrame:
        return docs.well_formed(_of_runs(self._landed(), runs))

    def rejected_documents(self) -> DataFrame:
        return docs.rejects(self._landed())

    # --- staging -----------------------------------------------------------

    def stage(self, name: str, runs: list[str] | None = None) -> None:
        """Flatten the runs' documents into one staging history table; no exchange."""
        contract, build = STAGING[name]
        write_history(conform(build(self.documents(runs)), contract), f"{self.root}/stg_{name}")

    def staged(self, name: str, runs: list[str] | None = None) -> DataFrame:
        contract, _ = STAGING[name]
        return _of_runs(read_history(self.spark, f"{self.root}/stg_{name}", contract), runs)

    # --- dimensions and fact -----------------------------------------------

    def dim(self, name: str) -> DataFrame:
        if name == "match":
            return self.match_table.read()
        current = self.snapshots[name].current()
        if current is None:
            raise LookupError(f"dimension {name} has not been loaded")
        return current

    def refresh_dimensions(self, runs: list[str] | None = None, created_at: Column | None = None) -> None:
        """Merge the runs' members: teams, then venues and players, dates, matches."""
        matches, players = self.staged("match", runs), self.staged("player", runs)
        created_at = F.current_timestamp() if created_at is None else created_at
        now = {d: s.current() for d, s in self.snapshots.items()}
        put = {d: s.replace for d, s in self.snapshots.items()}
        teams, venues, _ = together(
            lambda: put["team"](dims.dim_team(matches, self.space, now["team"], created_at)),
            lambda: put["venue"](dims.dim_venue(matches, self.space, now["venue"])),
            lambda: put["date"](dims.dim_date(matches, now["date"])),
        )
        together(
            lambda: put["player"](dims.dim_player(players, teams, self.space, now["player"], created_at)),
            lambda: self.match_table.merge(dims.dim_match(matches, teams, venues, space=self.space), unique_source=True, version=("stg_modified_ts",)),
        )

    def build_fact(self, runs: list[str] | None = None) -> DataFrame:
        return fact_delivery(self.staged("delivery", runs), self.dim("match"), self.dim("team"), self.dim("player"), self.space)

    def merge_fact(self, runs: list[str] | None = None) -> dict[str, int]:
        """Upsert the runs' balls; a stored ball of a newer version stays. Returns the counts of the split.

        Rows that break the fact's contract are kept with their reasons, below the run they came with.
        """
        path = self.space.fresh("split")
        parts = split_deliveries(self.staged("delivery", runs), self.dim("match"), self.dim("team"), self.dim("player"), self.space, path)
        self.fact_table.merge(parts.accepted, unique_source=True, version=("stg_modified_ts", "stg_file_hashkey"), written=True)
        if parts.counts["rejected"]:
            rejects = conform(parts.rejected, FACT_REJECTS)
            by_folder(rejects, "run_id").parquet(f"{self.root}/fact_rejects")
        self.space.release(path)
        return parts.counts

    def fact_rejects(self) -> DataFrame:
        """Staged rows that are not in the fact, with what is wrong with them."""
        path = f"{self.root}/fact_rejects"
        return self.spark.read.schema(FACT_REJECTS.read_schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], FACT_REJECTS.read_schema)

    def fact(self) -> DataFrame:
        return self.fact_table.read()

    # --- marts -------------------------------------------------------------

    def refresh_marts(self, runs: list[str] | None = None) -> None:
        """Bring the marts up to date with the runs' matches (all without ``runs``).

        Only the balls of touched matches are read; totals take the difference
        between what is stored of these matches and what they are now.
        """
        players, teams = self.dim("player"), self.dim("team")
        touched = self.space.freeze(self.staged("match", runs).select(F.col("match_type_number").alias("match_id")).distinct(), "touched")
        fact = self.fact() if runs is None else self.balls_of(touched, runs)
        store = self.mart_store
        store.refresh(fact, touched)
        now = store.of_matches(store.numbers.read().join(touched, "match_id", "left_semi"))
        self.summary_table.replace_groups(summary_of(now), "match_id", touched)
        career = marts.named_career(store.career(), players, teams)
        together(
            lambda: self.career.replace(career.drop("innings", "total_balls")),
            lambda: self.career_ext.replace(career),
            lambda: self.dismissal.replace(marts.named_dismissals(store.kinds.current().withColumnRenamed("outs", "dismissals"), players)),
        )

    def balls_of(self, touched: DataFrame, runs: list[str]) -> DataFrame:
        """All balls of the matches that the runs touched; only their buckets of the fact are opened.

        The blocks a match has come from its stored partials and from the runs' deliveries.
        """
        store = self.mart_store
        known = store.of_matches(store.numbers.read().join(touched, "match_id", "left_semi")).select("match_id", "last_over")
        staged = self.staged("delivery", runs).select(F.col("match_type_number").alias("match_id"), F.col("over").alias("last_over"))
        ends = known.unionByName(staged).where("last_over IS NOT NULL").groupBy("match_id").agg(F.max("last_over").alias("last_over"))
        blocks = ends.select("match_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("last_over") / OVERS_PER_BUCKET).cast("int"))).alias("block"))
        placed = blocks.select(match_bucket("match_id", F.col("block") * OVERS_PER_BUCKET, self.fact_table.buckets).alias("bucket"))
        # at most as many as the table has buckets
        buckets = [r["bucket"] for r in placed.distinct().collect()]
        return self.fact_table.read(buckets).join(touched, "match_id", "left_semi")

    def summary(self) -> DataFrame:
        """The stored sums with the names the dimensions have now."""
        return marts.named_summary(self.summary_table.read(), self.dim("player"), self.dim("team"), self.dim("match"))

    def clean(self) -> None:
        """Remove versions of buckets that do not count any more; no job may be reading or writing them."""
        store = self.mart_store
        for table in (self.match_table, self.fact_table, self.summary_table, store.numbers, store.partials, store.sets):
            table.clean()

    # --- one batch ---------------------------------------------------------

    def load(self, raw: DataFrame | Callable[[], DataFrame], runs: list[str], loaded_at: datetime | Column | str, batch: str | None = None) -> None:
        """Everything from raw bundles to the fact for the given runs.

        Repeating it changes nothing, and neither does the order in which runs
        come, as long as ``loaded_at`` is a property of the documents. Steps that
        the ledger has of the ``batch`` are not done again; ``raw`` as a function
        is called if the bundles have to be landed.
        """
        def step(name: str, work) -> None:
            self.ledger.once(batch, runs, name, work)

        step("land", lambda: self.land(raw() if callable(raw) else raw, loaded_at))
        together(*[lambda name=name: step(f"stage_{name}", lambda: self.stage(name, runs)) for name in STAGING])
        step("dimensions", lambda: self.refresh_dimensions(runs))
        step("fact", lambda: self.merge_fact(runs))


def _of_runs(frame: DataFrame, runs: list[str] | None) -> DataFrame:
    return frame if runs is None else frame.where(F.col("run_id").isin(runs))
