"""Mixing sources to target weights by Pareto order sampling.

Inside a source longer documents are due more: the expected copies of a document
grow with the binary digits of its size, up to a most, and are scaled so that
the source's words meet its target. Their whole part is certain, the fraction is
the inclusion probability of one more copy. For that copy documents are ranked
by random odds divided by inclusion odds, and a sample of fixed size - the words
still missing to the source's target - is taken from the front of the ranking.

The end of the front is found by two rounds of bucket sums and a window over
the documents of one last bucket, so no task sorts a whole source. Equal rows are
numbered, so that each has a draw of its own. Everything on this path is
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchmart.llm.common import text_or_empty, unit_draw, word_count
from matchmart.operators.numbering import dense_ids, number_within
from matchmart.workspace import Workspace

#: sources in code point order, null last, weigh these, repeating
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = 20
#: buckets of one round; two rounds leave one bucket in about 16.7 million of a source's documents
BUCKETS = 4096
#: equal rows that one task numbers together (as a power of two)
_BLOCK_BITS = 13


def source_targets(sizes: DataFrame, space: Workspace, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from rows ``(source, size)``.

    All sizes are shared by weight; a target stops at ``max_copies`` times its
    source's size, and what is over is shared by weight among the rest, again
    until none is above. Sources of size 0 have target 0.
    """
    sources = space.freeze(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    sources = sources.withColumns({"__none": F.col("source").isNull(), "__name": F.coalesce("source", F.lit(""))})
    numbered = dense_ids(sources, ["__none", "__name"], "__place", space)
    weight = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("__place") - 1) % len(WEIGHTS)).cast("int"))
    numbered = space.freeze(
        numbered.select("source", "source_size", weight.cast("double").alias("weight"),
                        (F.col("source_size") * max_copies).cast("double").alias("most")), "weights",
    )
    total = float(numbered.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = F.col("weight") * level > F.col("most")
        found = numbered.agg(
            F.count_if(capped).alias("full"),
            F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("used"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if found["full"] == full or not found["open"]:
            break
        full = found["full"]
        level = (total - found["used"]) / found["open"]
    return numbered.select("source", "source_size", F.least(F.col("weight") * level, F.col("most")).alias("target"))


def length_weight(size: Column) -> Column:
    """How much a document is due beside others of its source: the binary digits of its size."""
    return F.length(F.bin(size)).cast("long")


def due_copies(words: DataFrame, targets: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target, weight, words, due): expected copies of a source's documents by weight.

    ``words`` has one row per source and weight, ``(source, weight, words)``; in
    Spark it is as long as sources times the digits of a size. Copies are
    proportional to the weight; weights that would be above ``max_copies`` stop
    there, and what is over goes to the smaller ones. A source without words is
    due nothing.
    """
    joined = words.join(targets, words["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    heavier = Window.partitionBy("source").orderBy(F.col("weight").desc())
    before = F.coalesce(F.sum("words").over(heavier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    score = F.sum(F.col("weight") * F.col("words")).over(heavier.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # the level if all heavier ones, and only these, stop at the most
    level = F.try_divide(F.col("target") - before * F.lit(max_copies), score.cast("double"))
    levels = joined.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= max_copies, F.col("weight"))
    chosen = F.max_by("level", fits).over(Window.partitionBy("source"))
    due = F.least(F.coalesce(chosen * F.col("weight"), F.lit(float(max_copies))), F.lit(float(max_copies)))
    return levels.withColumn("due", F.when(F.col("source_size") > 0, F.round(due, 9)).otherwise(F.lit(0.0))).drop("level")


def _rank(draw: Column, chance: Column) -> Column:
    """Pareto rank q = odds(draw) / odds(chance), mapped to (0, 1) by q / (1 + q)."""
    odds = draw / (F.lit(1.0) - draw)
    due = chance / (F.lit(1.0) - chance)
    return odds / (odds + due)


def _front(items: DataFrame, space: Workspace) -> DataFrame:
    """(source, cut, end): ranks up to ``cut`` fit into the missing words of a source.

    The last place of the sample goes to the document that fills what is still
    open best, the one of rank ``end``; there is none if leaving it open is
    nearer. ``items`` has (source, size, rank, missing).
    """
    def crossing(rows: DataFrame, bucket: Column) -> DataFrame:
        sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
        before = F.coalesce(
            F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
        sums = sums.withColumn("before", before)
        inside = (F.col("before") < F.col("missing")) & (F.col("before") + F.col("words") >= F.col("missing"))
        return space.freeze(
            sums.where(inside).select("source", "bucket", (F.col("missing") - F.col("before")).alias("missing")), "crossing"
        )

    coarse = F.floor(F.col("rank") * BUCKETS)
    fine = F.floor(F.col("rank") * BUCKETS * BUCKETS)
    first = crossing(items, coarse)
    rest = items.drop("missing").withColumn("bucket", coarse).join(first, ["source", "bucket"]).drop("bucket")
    second = crossing(rest, fine)
    last = rest.drop("missing").withColumn("bucket", fine).join(second, ["source", "bucket"])
    upto = Window.partitionBy("source").orderBy("rank").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("upto", F.sum("size").over(upto))
    within = F.col("upto") <= F.col("missing")
    start = F.min("bucket") / F.lit(float(BUCKETS * BUCKETS))
    cuts = last.groupBy("source").agg(
        F.coalesce(F.max(F.when(within, F.col("rank"))), start).alias("cut"),
        (F.first("missing") - F.coalesce(F.max(F.when(within, F.col("upto"))), F.lit(0))).alias("open"),
    )
    cuts = space.freeze(cuts, "cuts")
    off = F.abs(F.col("size") - F.col("open"))
    ends = (
        items.select("source", "size", "rank").join(cuts, "source")
        .where((F.col("rank") > F.col("cut")) & (off < F.col("open")))
        .groupBy("source").agg(F.min_by("rank", F.struct(off, F.col("rank"))).alias("end"))
    )
    return cuts.drop("open").join(ends, "source", "left")


def _numbered(rows: DataFrame, repeats: DataFrame, space: Workspace) -> DataFrame:
    """The rows whose print is in ``repeats``, with ``__number`` from 1 among those of one print.

    They are written once with their places, then numbered in blocks of places,
    so a print that many rows share is spread over tasks.
    """
    found = rows.join(repeats, "__print", "left_semi").withColumn("__at", F.monotonically_increasing_id())
    placed = space.freeze(found, "repeated").withColumn("__block", F.shiftright("__at", _BLOCK_BITS))
    numbered = number_within(placed, ["__print"], ["__block"], ["__at"], "__number")
    return space.freeze(numbered.drop("__at", "__block"), "numbered")


def draw_of(print_: Column, number: Column, seed: int = SEED) -> Column:
    """The random number of the ``number``-th row of a print."""
    return unit_draw(print_, number.cast("int"), seed=seed)


def mix_sources(docs: DataFrame, space: Workspace, seed: int = SEED, max_copies: int = MAX_COPIES) -> DataFrame:
    """All rows and columns of ``docs`` and ``__size``, ``__source_size``, ``__target``, ``__copies``.

    A document is drawn by hash of its id, source and text, so reruns agree;
    rows that repeat are numbered and drawn one by one, and reruns agree on how
    many of them are taken. A null or empty text has size 0 and gets the certain
    copies of its source's shortest documents only. A null source is a source of
    its own, the last one. An empty table gives an empty result.
    """
    source = F.col("source").cast("string")
    sized = docs.select(
        F.struct("*").alias("__row"), word_count().alias("__size"), source.isNull().alias("__none"),
        F.coalesce(source, F.lit("")).alias("__name"), F.xxhash64("doc_id", source, text_or_empty()).alias("__print"),
    )
    # one narrow row per document, rows that repeat counted where they are read
    classes = space.freeze(
        sized.groupBy("__none", "__name", F.col("__size").alias("size"), F.col("__print").alias("print")).agg(F.count("*").alias("n")), "classes"
    )
    name = F.when(~F.col("__none"), F.col("__name"))
    targets = source_targets(classes.select(name.alias("source"), (F.col("size") * F.col("n")).alias("size")), space, max_copies)
    words = classes.groupBy(name.alias("source"), length_weight(F.col("size")).alias("weight")).agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    chance = F.col("due") - F.floor("due")
    shares = due_copies(words, targets, max_copies).withColumns({"whole": F.floor("due"), "chance": chance})
    shares = space.freeze(shares.select(
        F.col("source").isNull().alias("__none"), F.coalesce("source", F.lit("")).alias("__name"), "source_size", "target", "weight", "whole", "chance",
        F.sum(F.col("chance") * F.col("words")).over(Window.partitionBy("source")).alias("missing"),
    ), "shares")

    repeats = space.freeze(classes.where(F.col("n") > 1).select(F.col("print").alias("__print")).distinct(), "repeats")
    once = sized.withColumn("__number", F.lit(1))
    items = classes.where(F.col("n") == 1).select("__none", "__name", "size", "print", F.lit(1).alias("number"))
    if not repeats.isEmpty():
        again = _numbered(sized, repeats, space)
        once = once.join(repeats, "__print", "left_anti").unionByName(again)
        alone = items.join(repeats.withColumnRenamed("__print", "print"), "print", "left_anti")
        items = alone.unionByName(again.select(
            "__none", "__name", F.col("__size").alias("size"), F.col("__print").alias("print"), F.col("__number").alias("number")
        ))
    keyed = items.where(F.col("size") > 0).withColumn("weight", length_weight(F.col("size")))
    ranked = keyed.join(shares.where(F.col("chance") > 0), ["__none", "__name", "weight"]).select(
        F.struct("__none", "__name").alias("source"), "size", "missing", _rank(draw_of(F.col("print"), F.col("number"), seed), F.col("chance")).alias("rank")
    )
    cuts = _front(space.freeze(ranked, "items"), space).select("source.__none", "source.__name", "cut", "end")
    decided = space.freeze(shares.join(cuts, ["__none", "__name"], "left").select(
        "__none", "__name", F.col("weight").alias("__weight"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
        "whole", "chance", "cut", "end",
    ), "decided")
    rank = _rank(draw_of(F.col("__print"), F.col("__number"), seed), F.col("chance"))
    drawn = (F.col("chance") > 0) & ((rank <= F.col("cut")) | F.coalesce(rank == F.col("end"), F.lit(False)))
    more = F.coalesce(drawn & (F.col("__size") > 0), F.lit(False))
    weighed = once.withColumn("__weight", length_weight(F.col("__size")))
    return weighed.join(decided, ["__none", "__name", "__weight"]).select(
        "__row.*", "__size", "__source_size", "__target", (F.col("whole") + more.cast("long")).alias("__copies")
    )


def mixing_digest(docs: DataFrame, space: Workspace) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken; also copies."""
    mixed = mix_sources(docs.select("doc_id", "text", "source"), space)
    return mixed.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.col("__copies")).alias("taken"),
        F.col("__copies").alias("copies"),
    )
