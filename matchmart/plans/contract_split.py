"""Rows that keep their contract and rows that break it, with the reasons.

Every rule of a contract is one bit. A row gets the mask of the rules it breaks
in the same pass that makes it; accepted rows and rejects are written by one
job into two folders, and the counts are observed while it runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from matchmart.contracts import Contract
from matchmart.operators.layout import by_folder
from matchmart.workspace import Workspace

#: names the rules a row breaks, one bit each
BROKEN = "broken_rules"
_ACCEPTED = "accepted"


def required_rules(contract: Contract) -> dict[str, Column]:
    return {f"{c} is missing": F.col(c).isNull() for c in contract.required}


def length_rules(contract: Contract) -> dict[str, Column]:
    return {f"{c} is longer than {n}": F.length(c) > n for c, n in contract.lengths.items()}


def reference_rules(contract: Contract) -> dict[str, Column]:
    """For frames that ``with_references`` has looked up: a key that is there but has no parent."""
    return {f"{c} is not in {table}": F.col(c).isNotNull() & F.col(f"__no_{c}") for c, (table, _) in contract.references.items()}


def with_references(frame: DataFrame, contract: Contract, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The rows with one flag per declared foreign key; parents are projected to their key, so most are broadcast."""
    for column, (table, key) in contract.references.items():
        known = parents[table].select(F.col(key).alias("__key"), F.lit(False).alias("__missing"))
        frame = frame.join(known, frame[column] == F.col("__key"), "left").withColumn(f"__no_{column}", F.coalesce("__missing", F.lit(True))).drop("__key", "__missing")
    return frame


def marked(frame: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows with the mask of the rules they break; a rule that is unknown for a row is not broken."""
    if len(rules) > 63:
        raise ValueError("a mask has room for 63 rules")
    bits = [F.when(broken, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, broken in enumerate(rules.values())]
    return frame.withColumn(BROKEN, reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def reasons(rules: Mapping[str, Column], mask: str = BROKEN) -> Column:
    """The names of the rules in a mask, in their order, as text."""
    named = [F.when(F.col(mask).bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(rules)]
    return F.concat_ws("; ", *named)


@dataclass(frozen=True)
class Split:
    """The two parts as written, and the counts observed on the way."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def split(frame: DataFrame, rules: Mapping[str, Column], space: Workspace, path: str | None = None) -> Split:
    """Write accepted rows and rejects apart, in one pass without a shuffle.

    ``rejected`` has the mask and ``reasons``. ``counts`` has ``rows``,
    ``accepted``, ``rejected`` and one entry per rule.
    """
    path = path or space.fresh("split")
    seen = Observation("contract")
    checked = marked(frame, rules)
    clean = F.col(BROKEN) == 0
    per_rule = [F.count_if(F.col(BROKEN).bitwiseAND(F.lit(1 << i)) != 0).alias(f"rule_{i}") for i in range(len(rules))]
    observed = checked.observe(seen, F.count("*").alias("rows"), F.count_if(clean).alias(_ACCEPTED), *per_rule)
    by_folder(observed.withColumn(_ACCEPTED, clean), _ACCEPTED).option("partitionOverwriteMode", "static").parquet(path)
    found = seen.get
    written = space.spark.read.schema(checked.schema.add(_ACCEPTED, "boolean")).parquet(path)
    counts = {"rows": found["rows"], _ACCEPTED: found[_ACCEPTED], "rejected": found["rows"] - found[_ACCEPTED]}
    counts |= {name: found[f"rule_{i}"] for i, name in enumerate(rules)}
    return Split(
        written.where(F.col(_ACCEPTED)).drop(_ACCEPTED, BROKEN),
        written.where(~F.col(_ACCEPTED)).drop(_ACCEPTED).withColumn("reasons", reasons(rules)),
        counts,
    )
