"""Identifiers and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelattice.constants import NPI_SYSTEM
from carelattice.functions.refs import blank_to_null

# fixed value: the URL namespace of name-based UUIDs (RFC 4122, appendix C)
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def npis(identifier: Column) -> Column:
    """All non-empty values under exactly the NPI system."""
    hits = F.filter(
        identifier,
        lambda i: (i["system"] == NPI_SYSTEM) & i["value"].isNotNull() & (i["value"] != ""),
    )
    return F.transform(hits, lambda i: i["value"])


def npi(identifier: Column) -> Column:
    return F.get(npis(identifier), F.lit(0))


def npis_lenient(identifier: Column) -> Column:
    """Values whose system mentions ``npi`` in any case, where both parts are present."""
    hits = F.filter(
        identifier,
        lambda i: F.lower(i["system"]).contains("npi") & i["value"].isNotNull() & (i["value"] != ""),
    )
    return F.transform(hits, lambda i: i["value"])


def has_npi(value: Column, identifier: Column, wanted: str) -> Column:
    """True where a resource carries the NPI; the text test spares other lines the array walk."""
    return F.lower(value).contains(wanted.lower()) & F.coalesce(
        F.exists(npis(identifier), lambda v: F.lower(v) == wanted.lower()), F.lit(False)
    )


def stable_uuid(id_text: Column) -> Column:
    """A UUID stays itself (lower case); any other id becomes its name-based (version 5) UUID."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(id_text, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    named = F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
    lowered = F.lower(id_text)
    return F.when(lowered.rlike(UUID_PATTERN), lowered).otherwise(named)


def dimension_key(*parts: Column) -> Column:
    """128-bit key of a natural key: trimmed parts, NULL as empty, joined by U+001F."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.btrim(p, F.lit(" \t\r\n")), F.lit("")) for p in parts])
    return F.left(F.sha2(text, 256), F.lit(32))


def fit_bigint(c: Column) -> tuple[Column, Column]:
    """An unsigned 64-bit number as (BIGINT or NULL, text kept where it does not fit)."""
    number = c.try_cast("bigint")
    return number, F.when(number.isNull(), blank_to_null(c))
