"""Predicates on names, addresses of endpoints and plain presence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelattice.constants import (
    EMAIL_PATTERN,
    NAME_ILLEGAL_CHARS,
    PLACEHOLDER_NAMES,
    PLACEHOLDER_URL_PATTERNS,
)
from carelattice.functions.refs import strip


def present(c: Column) -> Column:
    """Neither NULL nor blank; never NULL itself."""
    return c.isNotNull() & (strip(c) != "")


def is_email(address: Column) -> Column:
    return F.coalesce(strip(address).rlike(EMAIL_PATTERN), F.lit(False))


def is_placeholder_name(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(*PLACEHOLDER_NAMES), F.lit(False))


def is_short_name(c: Column, min_length: int = 2) -> Column:
    trimmed = F.trim(c)
    return F.coalesce((trimmed != "") & (F.length(trimmed) < min_length), F.lit(False))


def is_all_caps(c: Column, min_length: int = 4) -> Column:
    trimmed = F.trim(c)
    return F.coalesce(
        (F.length(trimmed) >= min_length) & (trimmed == F.upper(trimmed)), F.lit(False)
    )


def has_illegal_chars(c: Column) -> Column:
    return F.coalesce(c.rlike(NAME_ILLEGAL_CHARS), F.lit(False))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(strip(url), r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1))


def is_well_formed_url(url: Column) -> Column:
    """http and https need a host; any other scheme needs a host or a path."""
    scheme = url_scheme(url)
    rest = F.regexp_replace(strip(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*:", "")
    host = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    path = F.regexp_extract(F.regexp_replace(rest, r"^//[^/?#]*", ""), r"^[^?#]*", 0)
    brackets_match = host.contains("[") == host.contains("]")
    good = (scheme != "") & brackets_match & (
        F.when(scheme.isin("http", "https"), host != "").otherwise((host != "") | (path != ""))
    )
    return F.coalesce(good, F.lit(False))


def is_placeholder_url(url: Column) -> Column:
    return F.coalesce(
        F.lower(strip(url)).rlike("|".join(f"(?:{p})" for p in PLACEHOLDER_URL_PATTERNS)),
        F.lit(False),
    )


def is_http(url: Column) -> Column:
    lowered = F.lower(url)
    return F.coalesce(lowered.startswith("http://") | lowered.startswith("https://"), F.lit(False))


def is_https(url: Column) -> Column:
    return F.coalesce(F.lower(url).startswith("https://"), F.lit(False))
