"""Natural keys, composite keys and storage buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: overs that share one storage bucket of a match
OVERS_PER_BUCKET = 50


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def natural_key(c: Column | str) -> Column:
    """Trimmed lower-case form that names are matched on."""
    return F.lower(F.trim(_col(c)))


def composite_key(*parts: Column | str) -> Column:
    """Normalised parts joined by a bar; NULL as soon as one part is NULL."""
    joined = natural_key(parts[0])
    for p in parts[1:]:
        joined = F.concat(joined, F.lit("|"), natural_key(p))
    return joined


def padded_key(*parts: Column | str) -> Column:
    """Normalised parts joined by a bar, a NULL part counting as empty text."""
    return F.concat_ws("|", *[F.coalesce(natural_key(p), F.lit("")) for p in parts])


def venue_key(venue: Column | str, city: Column | str, strict: bool = False) -> Column:
    """Venue lookup key; ``strict`` gives NULL when the venue or the city is NULL."""
    return composite_key(venue, city) if strict else padded_key(venue, city)


def date_key(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def match_bucket(match: Column | str, over: Column | str, buckets: int) -> Column:
    """Storage bucket of a ball.

    A match of ordinary length lives in one bucket, so a small batch touches
    few; a match with very many overs is spread over all of them.
    """
    block = F.floor(_col(over) / F.lit(OVERS_PER_BUCKET))
    return F.pmod(F.xxhash64(_col(match), block), F.lit(buckets)).cast("int")
