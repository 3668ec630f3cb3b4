"""Marts kept current by differences.

Per match the store holds partial sums from which every mart adds up. When
matches change, their stored partials are subtracted from the totals and the
new ones added; nothing else is read again. Distinct matches are bits: matches
get dense numbers in the order they arrive, 32 768 of them share a folder of
partials, and a batsman's matches of a folder are one bitmap. New matches come
last, so a batch touches the newest folders; only bitmaps of touched folders are
built anew, and counts of a batsman, a team or any other group are population
counts of bitmaps that are merged, not recounted.

A refresh first writes what it is about to do. A refresh that was interrupted is
completed by the next one before anything else, so no difference is applied twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.contracts import MART_PARTIALS, MATCH_NUMBERS, MATCH_SETS, conform
from matchmart.operators.layout import CODEC
from matchmart.operators.lookups import moved_if_many
from matchmart.operators.numbering import dense_ids
from matchmart.operators.upsert import insert_only
from matchmart.plans.marts import by_match
from matchmart.sources.sinks import BucketedTable, Snapshots
from matchmart.workspace import Workspace, exists, remove

SUMS = ("runs", "extras", "fours", "sixes", "balls", "outs")
TOTALS = ("innings", *SUMS)
_PARTIAL_KEY = ("match_id", "striker_id", "bowling_team_id", "innings_number", "wicket_kind")


def partial_sums(fact: DataFrame) -> DataFrame:
    """One row per match, batsman, opponent, innings and kind of wicket; balls of unknown batsmen have no batsman."""
    sums = by_match(fact, lambda balls: balls.groupBy(*_PARTIAL_KEY).agg(
        F.sum(F.col("runs_off_bat").cast("long")).alias("runs"),
        F.sum(F.col("extras").cast("long")).alias("extras"),
        F.count_if("is_boundary_4").alias("fours"),
        F.count_if("is_boundary_6").alias("sixes"),
        F.count("*").alias("balls"),
        F.count_if("is_wicket").alias("outs"),
        F.max("over_number").alias("last_over"),
    ))
    return sums.withColumnRenamed("striker_id", "player_id")


def _added(*columns: str) -> list:
    return [F.sum(c).alias(c) for c in columns]


def summary_of(partials: DataFrame) -> DataFrame:
    """The sums of the summary mart; a match has few partials, which are moved together to where its names are joined."""
    known = partials.where("player_id IS NOT NULL").repartition("match_id").groupBy("player_id", "match_id", "bowling_team_id").agg(*_added(*SUMS))
    return known.withColumnsRenamed({"runs": "runs_scored", "balls": "balls_faced", "outs": "times_out"})


def player_totals(partials: DataFrame) -> DataFrame:
    """Totals per batsman; innings are counted after each is one row."""
    known = partials.where("player_id IS NOT NULL").groupBy("player_id", "match_id", "innings_number").agg(*_added(*SUMS))
    return known.groupBy("player_id").agg(F.count("*").alias("innings"), *_added(*SUMS))


def kind_totals(partials: DataFrame) -> DataFrame:
    """Wickets per batsman and kind."""
    return partials.where("player_id IS NOT NULL AND outs > 0").groupBy("player_id", "wicket_kind").agg(*_added("outs"))


def difference(new: DataFrame, old: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What has to be added to totals over ``old`` rows to get those over ``new`` ones."""
    taken = old.select(*keys, *[(-F.col(c)).alias(c) for c in values])
    changed = new.select(*keys, *values).unionByName(taken).groupBy(*keys).agg(*_added(*values))
    return changed.where(" OR ".join(f"{c} <> 0" for c in values))


def added(current: DataFrame | None, delta: DataFrame, keys: Sequence[str], values: Sequence[str], count: str) -> DataFrame:
    """Totals with a difference added; groups without rows (``count`` is 0) go."""
    rows = delta.select(*keys, *values) if current is None else current.select(*keys, *values).unionByName(delta.select(*keys, *values))
    return rows.groupBy(*keys).agg(*_added(*values)).where(F.col(count) != 0)


class MartStore:
    """Partials, bitmaps and totals below one folder."""

    def __init__(self, space: Workspace, root: str, buckets: int = 8):
        self.space, self.spark, self.root = space, space.spark, root
        self.numbers = BucketedTable(space, f"{root}/match_numbers", MATCH_NUMBERS, lambda n: F.pmod(F.xxhash64("match_id"), F.lit(n)).cast("int"), buckets)
        self.partials = BucketedTable(space, f"{root}/partials", MART_PARTIALS, lambda _: F.bitmap_bucket_number("match_no").cast("int"), None)
        self.sets = BucketedTable(space, f"{root}/match_sets", MATCH_SETS, lambda _: F.col("match_set"), None)
        self.totals = Snapshots(self.spark, f"{root}/totals")
        self.kinds = Snapshots(self.spark, f"{root}/kinds")
        self._pending = f"{root}/pending"

    # --- refresh -----------------------------------------------------------

    def refresh(self, fact: DataFrame, touched: DataFrame) -> None:
        """Bring the marts up to date: ``fact`` has all balls that the ``touched`` matches (match_id) have now."""
        self.recover()
        matches = self._write("matches", self._numbered(touched.select("match_id").distinct()))
        # a match has one number: the few of a partition are looked up there, and the sums are not sorted
        new = partial_sums(fact).join(matches.hint("shuffle_hash"), "match_id")
        new = self._write("new", conform(new, MART_PARTIALS))
        old = self.space.freeze(self.of_matches(moved_if_many(matches)), "old")
        self._write("totals", difference(player_totals(new), player_totals(old), ["player_id"], TOTALS))
        self._write("kinds", difference(kind_totals(new), kind_totals(old), ["player_id", "wicket_kind"], ["outs"]))
        # the intent is complete from here on
        base = [F.lit(s.location()).cast("string").alias(n) for n, s in (("totals", self.totals), ("kinds", self.kinds))]
        self._write("ready", self.spark.range(1).select(*base))
        self._apply()

    def recover(self) -> None:
        """Complete a refresh that was interrupted after its intent was written; forget one that was not."""
        if exists(self.spark, f"{self._pending}/ready/_SUCCESS"):
            self._apply()
        remove(self.spark, self._pending)

    def _write(self, name: str, frame: DataFrame) -> DataFrame:
        frame.write.mode("overwrite").option("compression", CODEC).parquet(f"{self._pending}/{name}")
        return self._read(name)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._pending}/{name}")

    def _apply(self) -> None:
        base = self._read("ready").first()
        if self.totals.location() == base["totals"]:
            self.totals.replace(added(self.totals.current(), self._read("totals"), ["player_id"], TOTALS, "balls"))
        if self.kinds.location() == base["kinds"]:
            self.kinds.replace(added(self.kinds.current(), self._read("kinds"), ["player_id", "wicket_kind"], ["outs"], "outs"))
        matches = moved_if_many(self._read("matches"))
        self.partials.replace_groups(self._read("new"), "match_id", matches)
        folders = matches.select(F.bitmap_bucket_number("match_no").cast("int").alias("match_set")).distinct()
        self.sets.replace_groups(self._bits(matches), "match_set", folders)
        remove(self.spark, self._pending)

    def _numbered(self, touched: DataFrame) -> DataFrame:
        """The matches with their numbers; unseen ones get the next."""
        touched = moved_if_many(self.space.freeze(touched, "touched"))
        known = moved_if_many(self.numbers.read())
        unseen = self.space.freeze(insert_only(known.select("match_id"), touched, ["match_id"]), "unseen")
        if not unseen.isEmpty():
            start = known.agg(F.max("match_no")).first()[0] or 0
            self.numbers.merge(dense_ids(unseen, ["match_id"], "match_no", self.space, start), unique_source=True)
        return self.numbers.read().join(touched, "match_id", "left_semi")

    def of_matches(self, matches: DataFrame) -> DataFrame:
        """Stored partials of some matches (match_id, match_no); only their folders are opened."""
        folders = [r[0] for r in matches.select(F.bitmap_bucket_number("match_no").cast("int")).distinct().collect()]
        return self.partials.read(folders).join(matches.select("match_id"), "match_id", "left_semi")

    def _bits(self, matches: DataFrame) -> DataFrame:
        """The bitmaps of the folders that the matches are in."""
        folders = [r[0] for r in matches.select(F.bitmap_bucket_number("match_no").cast("int")).distinct().collect()]
        rows = self.partials.read(folders).where("player_id IS NOT NULL").select(F.bitmap_bucket_number("match_no").cast("int").alias("match_set"), "player_id", "match_no")
        return rows.groupBy("match_set", "player_id").agg(F.bitmap_construct_agg(F.bitmap_bit_position("match_no")).alias("matches"))

    # --- reading -----------------------------------------------------------

    def matches_by(self, groups: DataFrame, *keys: str) -> DataFrame:
        """Exact number of matches per group of batsmen: ``groups`` maps player_id to the ``keys``.

        Bitmaps of the same match numbers are merged, those of different ones add up.
        """
        placed = self.sets.read().join(groups.select("player_id", *[k for k in keys if k != "player_id"]), "player_id")
        merged = placed.groupBy(*keys, "match_set").agg(F.bitmap_or_agg("matches").alias("bits"))
        return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("matches"))

    def career(self) -> DataFrame:
        """Totals per batsman with the number of matches."""
        totals = self.totals.current()
        return totals.join(self.matches_by(totals, "player_id"), "player_id")
