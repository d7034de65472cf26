"""References: ``Type/id`` text, in every shape the directory files use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def ref_id(ref: Column) -> Column:
    """Last ``/`` part; a bare id passes through; blank gives NULL."""
    return blank_to_null(F.element_at(F.split(strip(ref), "/"), -1))


def ref_type(ref: Column) -> Column:
    """Part before the id, NULL for a bare id."""
    parts = F.split(strip(ref), "/")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2))


def parse_ref(ref: Column, want_type: str | None = None) -> Column:
    """Id of a typed reference, NULL when it is contained (``#x``), untyped or of another type.

    One pattern per value: the last two ``/`` parts before any ``?`` or ``#``, the first of them
    equal to the wanted type in any case.
    """
    wanted = f"(?i:{want_type})" if want_type else "[^/?#]*"
    return blank_to_null(
        F.regexp_extract(strip(ref), rf"(?s)^(?:[^?#]*/)?{wanted}/([^/?#]+)(?:[?#].*)?$", 1)
    )


def ref_texts(raw: Column) -> Column:
    """Reference strings of a field given as JSON text: an object, an array of either, or a string."""
    text = strip(raw)
    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(
        F.array(text)
    )
    refs = F.transform(
        items, lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.reference")).otherwise(x)
    )
    return F.filter(F.coalesce(refs, F.array().cast("array<string>")), lambda x: x.isNotNull())


def typed_ids(raw: Column, want_type: str) -> Column:
    """Ids of all references of ``want_type`` in a field given as JSON text."""
    return F.filter(
        F.transform(ref_texts(raw), lambda x: parse_ref(x, want_type)), lambda x: x.isNotNull()
    )


# a member named reference with a text value, the name possibly spelled with escapes, in a line without escaped quotes
REFERENCE_MEMBER = r'"(?:reference|[^"\\]*\\u[^"]*)"\s*:\s*"[^"]*"'
# stand for a backslash and a quote inside a text; JSON holds no raw control characters
BACKSLASH_MARK, QUOTE_MARK = "\x01b", "\x01q"


def all_refs(value: Column) -> Column:
    """Distinct ``Type/id`` references of a whole resource line, at any depth, escapes decoded.

    Once escaped backslashes and quotes are replaced, every quote of the line begins or ends a text, and outside of texts
    there are neither letters of a name nor backslashes. So the pattern can only match members, at whatever depth; the name inside
    another text, and references that are no text, do not match. Each match is decoded as JSON of its own.
    """
    bare = F.replace(F.replace(value, F.lit("\\\\"), F.lit(BACKSLASH_MARK)), F.lit('\\"'), F.lit(QUOTE_MARK))
    members = F.regexp_extract_all(bare, F.lit(REFERENCE_MEMBER), F.lit(0))

    def decoded(member: Column) -> Column:
        text = F.replace(F.replace(member, F.lit(QUOTE_MARK), F.lit('\\"')), F.lit(BACKSLASH_MARK), F.lit("\\\\"))
        return F.from_json(F.concat(F.lit("{"), text, F.lit("}")), "map<string,string>")["reference"]

    found = F.filter(F.transform(members, decoded), lambda r: F.coalesce(r.rlike(r"(?s)^[^/]+/."), F.lit(False)))
    return F.array_distinct(found)


def issuer_state(ref: Column) -> Column:
    """State code ending an issuer reference such as ``Organization/Organization-State-WY``."""
    return blank_to_null(F.regexp_extract(ref, r"-([A-Z]{2})$", 1))
