"""Words of whole texts as column expressions: runs without ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[ \t-\r]+"


def words(text: Column) -> Column:
    """Array of words; a null or blank text has none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def windows(hashes: Column, width: int) -> Column:
    """Hash of every window of ``width`` neighbours in an array of hashes, in order; none when it is shorter."""
    starts = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))


def fold_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, v: total + v)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body (or a lambda in it) names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
