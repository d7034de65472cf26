"""Postal addresses, states and coordinates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelattice.functions.identity import dimension_key
from carelattice.functions.refs import strip
from carelattice.functions.text import present


def first_state(addresses: Column) -> Column:
    """First non-blank state of an address array, trimmed and upper-cased."""
    states = F.transform(addresses, lambda a: F.upper(strip(a["state"])))
    return F.get(F.filter(states, lambda s: s.isNotNull() & (s != "")), F.lit(0))


def normalize_states(states: Iterable[str]) -> tuple[list[str], str]:
    """Parameter list trimmed, upper-cased, without repeats, in order; and its ``WY-RI-CA`` key."""
    kept = list(dict.fromkeys(s.strip().upper() for s in states if s.strip()))
    if not kept:
        raise ValueError("at least one state is needed")
    return kept, "-".join(kept)


def valid_state(state: Column, codes: Iterable[str]) -> Column:
    return F.coalesce(F.upper(strip(state)).isin(*codes), F.lit(False))


def joined_lines(line: Column) -> Column:
    return F.array_join(line, ", ")


def flat_address(a: Column) -> Column:
    """First two lines and the other parts of one address, empty text as NULL."""

    def part(c: Column) -> Column:
        return F.when(c != "", c)

    return F.struct(
        F.get(a["line"], F.lit(0)).alias("line1"),
        F.get(a["line"], F.lit(1)).alias("line2"),
        part(a["city"]).alias("city"),
        part(a["state"]).alias("state"),
        part(a["postalCode"]).alias("postal_code"),
        part(a["country"]).alias("country"),
    )


ADDRESS_PARTS = ("line1", "line2", "city", "state", "postal_code", "country")


def address_key(a: Column) -> Column:
    return dimension_key(*[a[p] for p in ADDRESS_PARTS])


def is_complete(a: Column) -> Column:
    return (
        present(F.get(a["line"], F.lit(0)))
        & present(a["city"])
        & present(a["state"])
        & present(a["postalCode"])
    )


def within_box(lat: Column, lon: Column, south: float, north: float, west: float, east: float) -> Column:
    lat, lon = lat.try_cast("double"), lon.try_cast("double")
    return F.coalesce((lat > south) & (lat < north) & (lon > west) & (lon < east), F.lit(False))
