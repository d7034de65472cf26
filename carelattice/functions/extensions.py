"""Typed values out of extension arrays, and codes out of concepts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelattice.functions.refs import ref_id


def with_url(extension: Column, urls: Sequence[str]) -> Column:
    return F.filter(extension, lambda e: e["url"].isin(*urls))


def first_ext(extension: Column, urls: Sequence[str], field: str) -> Column:
    """First present ``field`` among the extensions with one of the URLs."""
    values = F.transform(with_url(extension, urls), lambda e: e[field])
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def last_ext(extension: Column, urls: Sequence[str], field: str) -> Column:
    """Value of the last extension with one of the URLs, NULL if that one has no such value."""
    return F.try_element_at(with_url(extension, urls), F.lit(-1))[field]


def int_of(ext: Column, *text_fields: str) -> Column:
    """valueInteger, else the first text field that is set, read as an integer."""
    text = F.coalesce(*[ext[f] for f in text_fields]) if text_fields else F.lit(None).cast("string")
    return F.coalesce(ext["valueInteger"], text.try_cast("bigint"))


def ext_int(extension: Column, urls: Sequence[str], *text_fields: str) -> Column:
    numbers = F.transform(with_url(extension, urls), lambda e: int_of(e, *text_fields))
    return F.try_element_at(F.filter(numbers, lambda n: n.isNotNull()), F.lit(-1))


def us_core_code(extension: Column, urls: Sequence[str], default: str | None = None) -> Column:
    """ombCategory, detailed or text of a race or ethnicity extension, whichever comes first."""

    def code(sub: Column) -> Column:
        return F.when(
            sub["url"].isin("ombCategory", "detailed"), sub["valueCoding"]["code"]
        ).when(sub["url"] == "text", sub["valueString"])

    per_ext = F.transform(
        with_url(extension, urls),
        lambda e: F.get(
            F.filter(F.transform(e["extension"], code), lambda v: v.isNotNull()), F.lit(0)
        ),
    )
    found = F.get(F.filter(per_ext, lambda v: v.isNotNull()), F.lit(0))
    return found if default is None else F.coalesce(found, F.lit(default))


def concept_code(concept: Column) -> Column:
    """coding[0].code, else the text."""
    return F.coalesce(F.get(concept["coding"], F.lit(0))["code"], concept["text"])


def concept_text_first(concept: Column) -> Column:
    """The text, else coding[0].code; empty counts as missing."""
    code = F.get(concept["coding"], F.lit(0))["code"]
    return F.coalesce(
        F.when(concept["text"] != "", concept["text"]), F.when(code != "", code)
    )


def attachment_text(attachment: Column) -> Column:
    """Decoded base64 data as text, else ``url:<address>``; undecodable data gives NULL."""
    decoded = F.try_to_binary(attachment["data"], F.lit("base64")).cast("string")
    return F.when(attachment["data"].isNotNull(), decoded).when(
        attachment["url"].isNotNull(), F.concat(F.lit("url:"), attachment["url"])
    )


def language(comm: Column, proficiency_urls: Sequence[str]) -> Column:
    """(language code, proficiency) of one communication entry."""
    levels = F.transform(
        with_url(comm["extension"], proficiency_urls),
        lambda e: F.coalesce(F.when(e["valueCode"] != "", e["valueCode"]), e["valueString"]),
    )
    return F.struct(
        concept_text_or_code(comm["language"]).alias("language_code"),
        F.try_element_at(levels, F.lit(-1)).alias("proficiency_level"),
    )


def concept_text_or_code(concept: Column) -> Column:
    code = F.get(concept["coding"], F.lit(0))["code"]
    return F.coalesce(F.when(code != "", code), F.when(concept["text"] != "", concept["text"]))


def endpoint_refs(extension: Column, urls: Sequence[str]) -> Column:
    """(endpoint id, rank) of endpoint-reference extensions, flat or nested."""

    def one(e: Column) -> Column:
        nested = F.transform(
            F.filter(e["extension"], lambda s: s["url"] == "endpoint"),
            lambda s: s["valueReference"]["reference"],
        )
        ranks = F.transform(
            F.filter(e["extension"], lambda s: s["url"] == "rank"), lambda s: s["valuePositiveInt"]
        )
        return F.struct(
            ref_id(
                F.coalesce(e["valueReference"]["reference"], F.try_element_at(nested, F.lit(-1)))
            ).alias("endpoint_id"),
            F.try_element_at(ranks, F.lit(-1)).alias("rank"),
        )

    return F.filter(
        F.transform(with_url(extension, urls), one), lambda r: r["endpoint_id"].isNotNull()
    )
