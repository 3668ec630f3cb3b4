"""File paths as join keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_uri(c: Column | str) -> Column:
    """One spelling per object: percent-decoded, one slash after ``file:``.

    Readers report local files as ``file:/x`` or ``file:///x`` and blanks as
    ``%20`` or as blanks; both sides of a path join go through this. Text that
    is no valid percent encoding is left alone.
    """
    # url_decode reads '+' as a blank, while a path means it literally
    plus_kept = F.replace(_col(c), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.coalesce(F.try_url_decode(plus_kept), _col(c)), r"^file:/+", "file:/")


def basename(c: Column | str) -> Column:
    """Last path segment, for either kind of slash."""
    return F.element_at(F.split(F.replace(_col(c), F.lit("\\"), F.lit("/")), "/"), -1)
