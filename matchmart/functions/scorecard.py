"""Rules that turn document fields into table columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wordings written to the tables.
NOT_AVAILABLE = "NA"
RESULT_DECLARED = "Result Declared"
RESULT_WORDINGS = {"tie": "Tie", "no result": "No Result"}


def first_match_date(dates: Column | str) -> Column:
    """First listed date; NULL when the list is empty or the text is no date."""
    return F.try_to_date(F.try_element_at(dates if isinstance(dates, Column) else F.col(dates), F.lit(1)), "yyyy-MM-dd")


def match_stage(number: Column, stage: Column) -> Column:
    return F.coalesce(number.cast("string"), stage, F.lit(NOT_AVAILABLE))


def match_result(winner: Column, result: Column) -> Column:
    wording = F.coalesce(
        *[F.when(result == raw, F.lit(shown)) for raw, shown in RESULT_WORDINGS.items()],
        result,
    )
    return F.when(winner.isNull(), wording).otherwise(F.lit(RESULT_DECLARED))


def winner_name(winner: Column) -> Column:
    return F.ifnull(winner, F.lit(NOT_AVAILABLE))


def toss_decision(decision: Column) -> Column:
    return F.initcap(decision)


def fielder_names(fielders: Column) -> Column:
    """Names in order, comma separated; NULL without a list, unnamed fielders left out."""
    return F.array_join(fielders.getField("name"), ", ")


def runs_off_bat(total: Column, extras: Column) -> Column:
    return total - extras


def scored(runs: Column, value: int) -> Column:
    """True when exactly ``value`` came off the bat, false otherwise and for NULL."""
    return runs.eqNullSafe(F.lit(value))


def date_parts(d: Column) -> dict[str, Column]:
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}
