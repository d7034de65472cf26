"""Referentially connected subsets of a directory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelattice.functions.address import first_state, normalize_states
from carelattice.functions.identity import npis
from carelattice.functions.refs import all_refs, typed_ids
from carelattice.runtime import cut_lineage, salted_lookup
from carelattice.schemas import ADDRESSES
from carelattice.sources.export import once_per_id
from carelattice.sources.ndjson import parse_resources

# per type: the reference fields of a subset and the type each must name
LINK_FIELDS = {
    "Organization": {"location": "Location", "endpoint": "Endpoint"},
    "PractitionerRole": {
        "practitioner": "Practitioner",
        "organization": "Organization",
        "location": "Location",
        "endpoint": "Endpoint",
    },
    "OrganizationAffiliation": {
        "organization": "Organization",
        "participatingOrganization": "Organization",
        "location": "Location",
    },
    "Endpoint": {"managingOrganization": "Organization"},
}
#: Targets up to which the list of them is broadcast, some 100 bytes each.
BROADCAST_REFS = 2_000_000
ADDRESSED_TYPES = ("Location", "Organization", "Practitioner")


def _read(df: DataFrame, rtype: str) -> DataFrame:
    """(id, state, refs) of every resource with an id, in one parse.

    Fields are read as JSON text, which keeps every shape they may have; ``refs`` holds the
    ``Type/id`` targets of the type's reference fields.
    """
    links = LINK_FIELDS.get(rtype, {})
    fields = [*links, *(["address"] if rtype in ADDRESSED_TYPES else [])]
    ddl = ", ".join(f"{f} STRING" for f in ["id", *fields])
    rows = df.select(F.from_json("value", ddl).alias("r")).select("r.*")
    targets = [
        F.transform(typed_ids(F.col(f), t), _prefixed(t)) for f, t in links.items()
    ]
    state = first_state(F.from_json("address", ADDRESSES)) if "address" in fields else F.lit(None)
    return rows.select(
        "id",
        state.cast("string").alias("state"),
        (F.concat(*targets) if targets else F.array().cast("array<string>")).alias("refs"),
    )


def _prefixed(rtype: str):
    return lambda i: F.concat(F.lit(f"{rtype}/"), i)


def _refs_of(ids: DataFrame, rtype: str) -> DataFrame:
    return ids.select(F.concat(F.lit(f"{rtype}/"), "id").alias("ref"))


def _touching(links: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ids with a link into ``wanted``. Few targets are broadcast; else a target that very many ids share is salted."""
    wanted = cut_lineage(wanted.distinct(), "wanted")
    if wanted.count() <= BROADCAST_REFS:
        return links.join(F.broadcast(wanted), "ref", "left_semi").select("id").distinct()
    return salted_lookup(links.distinct(), wanted, "ref").select("id").distinct()


def state_subset_ids(
    resources: dict[str, DataFrame], states: Iterable[str], expand: bool = False
) -> DataFrame:
    """(resource_type, id) of the subset of some states.

    Seeds are locations, organizations and practitioners with an address there. Then, in this
    order and once each: organizations at a kept location; roles touching a kept practitioner,
    organization or location; affiliations touching a kept organization or location; endpoints of
    kept roles and of organizations added by location, or managed by a kept organization.
    ``expand`` adds what the plain subset leaves out: practitioners of kept roles and endpoints of
    every kept organization.

    Each type is parsed once and its ids and links are written to the shared folder; the steps
    after that are joins of those narrow tables.
    """
    wanted, _ = normalize_states(states)
    types = ("Location", "Organization", "Practitioner", "PractitionerRole", "OrganizationAffiliation", "Endpoint")
    every = None
    for t in types:
        part = _read(resources[t], t).where(F.coalesce("id", F.lit("")) != "").withColumn("resource_type", F.lit(t))
        every = part if every is None else every.unionByName(part)
    every = cut_lineage(every, "subset-rows", "resource_type")
    linked = every.select("resource_type", "id", F.explode("refs").alias("ref"))
    rows = {t: every.where(F.col("resource_type") == t).select("id", "state") for t in types}
    links = {t: linked.where(F.col("resource_type") == t).select("id", "ref") for t in LINK_FIELDS}

    def seeds(rtype: str) -> DataFrame:
        return rows[rtype].where(F.col("state").isin(*wanted)).select("id").distinct()

    locations, org_seeds, practitioners = (seeds(t) for t in ADDRESSED_TYPES)
    places = _refs_of(locations, "Location")
    added = cut_lineage(_touching(links["Organization"], places).join(org_seeds, "id", "left_anti"))
    organizations = org_seeds.unionByName(added)
    owners = _refs_of(organizations, "Organization")

    roles = cut_lineage(
        _touching(
            links["PractitionerRole"],
            places.unionByName(owners).unionByName(_refs_of(practitioners, "Practitioner")),
        )
    )
    affiliations = _touching(links["OrganizationAffiliation"], places.unionByName(owners))

    asked = ("Endpoint", "Practitioner") if expand else ("Endpoint",)
    needed = F.substring_index("ref", "/", 1).isin(*asked)
    referenced = links["PractitionerRole"].where(needed).join(roles, "id", "left_semi").select("ref")
    from_owners = links["Organization"].join(organizations if expand else added, "id", "left_semi").select("ref")
    all_refs_kept = cut_lineage(referenced.unionByName(from_owners).distinct())

    def existing(rtype: str) -> DataFrame:
        named = _ids_of(all_refs_kept, rtype)
        return rows[rtype].select("id").distinct().join(named, "id", "left_semi")

    endpoints = existing("Endpoint").unionByName(_touching(links["Endpoint"], owners)).distinct()
    if expand:
        of_roles = _ids_of(referenced.distinct(), "Practitioner")
        known = rows["Practitioner"].select("id").distinct().join(of_roles, "id", "left_semi")
        practitioners = known.unionByName(practitioners).distinct()
    return _tagged(
        {
            "Location": locations,
            "Organization": organizations,
            "Practitioner": practitioners,
            "PractitionerRole": roles,
            "OrganizationAffiliation": affiliations,
            "Endpoint": endpoints,
        }
    )


def _ids_of(refs: DataFrame, rtype: str) -> DataFrame:
    start = len(rtype) + 2
    return refs.where(F.col("ref").startswith(f"{rtype}/")).select(
        F.substr("ref", F.lit(start)).alias("id")
    )


def _tagged(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for rtype, ids in parts.items():
        part = ids.select(F.lit(rtype).alias("resource_type"), "id")
        out = part if out is None else out.unionByName(part)
    return out


def lines_of(bronze: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole lines of the chosen (resource_type, id), once each, text unchanged."""
    ids = cut_lineage(ids, "subset-ids")
    return once_per_id(cut_lineage(bronze.join(ids, ["resource_type", "id"], "left_semi"), "subset-text"))


def state_subset(resources: dict[str, DataFrame], bronze: DataFrame, states: Iterable[str]) -> DataFrame:
    return lines_of(bronze, state_subset_ids(resources, states))


def find_npi(resources: DataFrame, npi: str, resource_type: str = "Practitioner") -> DataFrame:
    """Lines that carry the NPI; other lines are discarded on their text, before any parse."""
    near = resources.where(F.lower("value").contains(npi.lower()))
    parsed = parse_resources(near, resource_type, ("identifier",), keep=tuple(near.columns))
    hit = F.exists(npis(F.col("r.identifier")), lambda v: F.lower(v) == npi.lower())
    return parsed.where(hit).select(*resources.columns)


SECOND_HOP_FROM = ("Organization", "Location", "HealthcareService", "OrganizationAffiliation")


def practitioner_network(bronze: DataFrame, npi: str) -> DataFrame:
    """(resource_type, id, value) of one practitioner's network.

    The practitioner with the NPI (smallest id of several), roles with exactly its reference,
    everything those roles refer to, then everything the organizations, locations, services and
    affiliations found so far refer to. ``bronze`` holds all types.
    """
    people = bronze.where(F.col("resource_type") == "Practitioner")
    person = cut_lineage(
        find_npi(people, npi)
        .groupBy("resource_type")
        .agg(F.min("id").alias("id"))
        .select("resource_type", "id")
    )
    role_lines = bronze.where(F.col("resource_type") == "PractitionerRole")
    wanted = person.select(F.concat(F.lit("Practitioner/"), "id").alias("_ref"))
    roles = (
        role_lines.withColumn("_ref", F.get_json_object("value", "$.practitioner.reference"))
        .join(wanted, "_ref", "left_semi")
        .select("resource_type", "id", "value")
    )
    roles = cut_lineage(roles)
    first = cut_lineage(_referenced(roles))
    middle = bronze.where(F.col("resource_type").isin(*SECOND_HOP_FROM))
    second = _referenced(middle.join(first, ["resource_type", "id"], "left_semi"))
    ids = (
        person.unionByName(roles.select("resource_type", "id")).unionByName(first).unionByName(second).distinct()
    )
    return lines_of(bronze, cut_lineage(ids))


def _referenced(lines: DataFrame) -> DataFrame:
    return (
        lines.select(F.explode(all_refs(F.col("value"))).alias("ref"))
        .select(
            F.substring_index("ref", "/", 1).alias("resource_type"),
            F.expr("substr(ref, instr(ref, '/') + 1)").alias("id"),
        )
        .distinct()
    )
