"""Line dedup: levelled sorted runs of line hashes, built batch by batch.

The corpus is taken in batches of documents. A batch is reduced to one row per
line key; it is merge-anti-joined with the runs of all earlier batches, and the
keys seen for the first time become a new run of level 0. Keys that an earlier
run holds are stored as repeats of that batch. As soon as a level has ``FANOUT``
runs they are compacted to one run of the next level, so a batch meets a number
of runs that grows with the logarithm of the batches. Runs, batches and repeats
are bucketed and sorted by the hash, so these joins merge sorted files without
a shuffle.

Everything on this path is DataFrame functions.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm.common import BLANKS, NO_ID, ascii_lower, text_or_empty
from matchmart.workspace import Workspace

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """The keys of all batches added so far: each key once in the runs, its later sightings in the repeats.

    Rows are (h1, h2, n_docs, top_doc): the key's 128-bit hash, the documents
    of that batch holding it and the largest of their ids.
    """

    def __init__(self, spark: SparkSession, space: Workspace, buckets: int | None = None):
        self.spark, self.space = spark, space
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, list[str]] = defaultdict(list)
        self.repeats: list[str] = []
        self.tables: list[str] = []

    def _store(self, rows: DataFrame, kind: str) -> str:
        name = f"lines_{kind}_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
            .option("path", self.space.path(name)).saveAsTable(name)
        )
        self.tables.append(name)
        return name

    def _runs(self) -> list[DataFrame]:
        return [self.spark.table(n) for level in sorted(self.levels) for n in self.levels[level]]

    def _plain(self, names: list[str]) -> DataFrame:
        """Rows of several tables, read as plain files.

        A union of bucketed tables is planned as if it were bucketed itself, but
        its partitions do not line up: an aggregate above it splits keys.
        """
        return self.spark.read.schema(self.spark.table(names[0]).schema).parquet(*[self.space.path(n) for n in names])

    def add(self, batch: DataFrame) -> None:
        """Take one batch of ``(h1, h2, n_docs, top_doc)`` rows, one per key."""
        rows = self.spark.table(self._store(batch, "batch"))
        runs = self._runs()
        fresh = rows
        for run in runs:
            fresh = fresh.join(run.select(*KEY), KEY, "left_anti")
        first = self._store(fresh, "run")
        if runs:
            again = rows.join(self.spark.table(first).select(*KEY), KEY, "left_anti")
            self.repeats.append(self._store(again, "repeat"))
        self.levels[0].append(first)
        self._compact(0)

    def _compact(self, level: int) -> None:
        names = self.levels[level]
        if len(names) < FANOUT:
            return
        self.levels[level] = []
        self.levels[level + 1].append(self._store(self._plain(names), "run"))
        self._compact(level + 1)

    def totals(self) -> DataFrame:
        """(h1, h2, n_docs, top_doc) over all batches."""
        rows = self._plain([n for names in self.levels.values() for n in names] + self.repeats)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc"))

    def drop(self) -> None:
        """Forget the tables in the catalog and remove their files."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.space.release(self.space.path(name))


def dedup_lines(
    docs: DataFrame, space: Workspace, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES
) -> DataFrame:
    """All rows and columns of ``docs`` and ``__kept`` (the text that stays), ``__n_lines``, ``__n_dropped``.

    Lines whose key has ``min_chars`` code points and is found in ``min_docs``
    documents stay only in the document of the largest id that holds the key,
    there in all their places. A null or empty text is one empty line. Rows
    with the same id count as one document; a null id counts as one document
    below all others. Repeated rows are treated alike and all returned. An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    identity = [F.coalesce("doc_id", F.lit(NO_ID)).alias("__doc"), F.xxhash64(text_or_empty()).alias("__text")]
    lines = (
        docs.select(*identity, F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("at", "line"))
        .select("__doc", "__text", "at", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select(
            "__doc", "__text", "at",
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2"),
            F.pmod(F.xxhash64("__doc"), F.lit(batches)).cast("int").alias("batch"),
        )
    )
    path = space.fresh("lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, space)
    for batch in range(batches):
        own = lines.where(F.col("batch") == batch)
        runs.add(own.groupBy(*KEY).agg(F.count_distinct("__doc").alias("n_docs"), F.max("__doc").alias("top_doc")))
    frequent = space.freeze(runs.totals().where(F.col("n_docs") >= min_docs).drop("n_docs"), "frequent")
    runs.drop()
    gone = (
        lines.join(frequent, KEY)
        .where(F.col("__doc") < F.col("top_doc"))
        .groupBy("__doc", "__text").agg(F.collect_set("at").alias("__gone"))
    )
    gone = space.freeze(gone, "gone")
    space.release(path)
    marked = docs.select("*", *identity).join(gone, ["__doc", "__text"], "left").drop("__doc", "__text")
    split = F.split(text_or_empty(), "\n", -1)

    def without_gone(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
        return F.array_join(F.transform(places, lambda at: F.get(lines, at)), "\n")

    # the lines are an argument, so a text is split once and not for every line that stays
    kept = F.get(F.transform(F.array(split), without_gone), F.lit(0))
    return marked.withColumns({
        "__kept": F.when(F.col("__gone").isNull(), text_or_empty()).otherwise(kept),
        "__n_lines": F.size(split).cast("long"),
        "__n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long"),
    }).drop("__gone")


def line_dedup_digest(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs.select("doc_id", "text"), space).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256"),
    )


#: DuckDB counterpart of ``line_dedup_digest``
LINE_DEDUP_SQL = r"""
WITH l AS (
  SELECT d.doc_id, u.pos, u.line,
         translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents d, LATERAL (
    SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) u
), f AS (
  SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT l.doc_id, l.pos, l.line, f.k IS NOT NULL AND l.doc_id < f.top AS gone FROM l LEFT JOIN f ON l.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
