"""The directory as a property graph: node tables, edges and the queries on them.

Nodes are keyed by ``Type/id`` text. Edges exist only where both ends do, and only once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.functions.address import joined_lines
from carelattice.functions.extensions import endpoint_refs, with_url
from carelattice.functions.identity import npis_lenient
from carelattice.functions.refs import issuer_state, ref_id, strip
from carelattice.functions.text import is_email
from carelattice.runtime import cut_lineage, salted_lookup
from carelattice.sources.ndjson import parse_resources
from carelattice.sources.tables import keep_one

Resources = dict[str, DataFrame]


def _with_id(lines: DataFrame) -> DataFrame:
    """Bronze rows carry the id already; bare lines get it from their text."""
    return lines if "id" in lines.columns else lines.withColumn("id", F.get_json_object("value", "$.id"))


def _records(resources: Resources, rtype: str, *fields: str) -> DataFrame:
    """One parsed record per non-empty id; of repeated lines the greatest text makes the node."""
    unique = keep_one(_with_id(resources[rtype]).where("id <> ''").select("id", "value"), "id")
    return parse_resources(unique, rtype, fields, keep=("id",))


def _texts(items: Column) -> Column:
    return F.filter(items, lambda v: v.isNotNull() & (v != ""))


def _labels(concepts: Column) -> Column:
    """display, else code, of every coding of every concept."""
    codings = F.flatten(F.filter(F.transform(concepts, lambda c: c["coding"]), lambda c: c.isNotNull()))
    return F.transform(codings, lambda c: F.coalesce(c["display"], c["code"], F.lit("")))


def _codings(concepts: Column) -> Column:
    return F.flatten(F.filter(F.transform(concepts, lambda c: c["coding"]), lambda c: c.isNotNull()))


def identifier_pairs(identifier: Column) -> Column:
    """(system, value) pairs where both are set."""
    pairs = F.filter(
        identifier, lambda i: (i["system"] != "") & (i["value"] != "")
    )
    return F.transform(pairs, lambda i: F.struct(i["system"].alias("system"), i["value"].alias("value")))


def _telecom_values(telecom: Column, system: str) -> Column:
    return F.transform(
        F.filter(telecom, lambda t: (F.lower(t["system"]) == system) & (t["value"] != "")),
        lambda t: t["value"],
    )


def _address_texts(addresses: Column) -> Column:
    """Addresses with their lines joined into one text."""
    return F.transform(addresses, lambda a: a.withField("line", joined_lines(a["line"])))


def practitioner_nodes(resources: Resources) -> DataFrame:
    r = F.col("r")
    codings = F.flatten(
        F.filter(F.transform(r["qualification"], lambda q: q["code"]["coding"]), lambda c: c.isNotNull())
    )

    def displays(system: str) -> Column:
        return _texts(
            F.transform(F.filter(codings, lambda c: c["system"] == system), lambda c: c["display"])
        )

    def license_of(q: Column) -> Column:
        numbers = F.transform(
            F.filter(
                q["identifier"],
                lambda i: F.exists(i["type"]["coding"], lambda c: c["code"] == "MD") & (i["value"] != ""),
            ),
            lambda i: i["value"],
        )
        return F.struct(
            issuer_state(q["issuer"]["reference"]).alias("state"),
            F.get(numbers, F.lit(0)).alias("license_number"),
        )

    spoken = F.flatten(
        F.filter(F.transform(r["communication"], lambda c: c["coding"]), lambda c: c.isNotNull())
    )
    first_name = F.get(r["name"], F.lit(0))
    return _records(
        resources, "Practitioner", "identifier", "name", "active", "gender", "qualification",
        "communication", "telecom", "address",
    ).select(
        "id",
        F.concat_ws(" ", F.array_join(first_name["given"], " "), first_name["family"]).alias("name"),
        r["active"].alias("active"),
        r["gender"].alias("gender"),
        F.get(npis_lenient(r["identifier"]), F.lit(0)).alias("npi"),
        identifier_pairs(r["identifier"]).alias("identifiers"),
        _address_texts(r["address"]).alias("addresses"),
        _texts(F.transform(r["address"], lambda a: F.upper(strip(a["state"])))).alias("states"),
        _telecom_values(r["telecom"], "email").alias("emails"),
        _telecom_values(r["telecom"], "phone").alias("phones"),
        _telecom_values(r["telecom"], "fax").alias("faxes"),
        F.array_sort(F.array_distinct(displays(K.NUCC_SYSTEM))).alias("specialties"),
        displays(K.DEGREE_SYSTEM).alias("degrees"),
        F.filter(
            F.transform(r["qualification"], license_of),
            lambda x: x["state"].isNotNull() & x["license_number"].isNotNull(),
        ).alias("licenses"),
        _texts(
            F.transform(
                F.filter(spoken, lambda c: F.lower(F.coalesce(c["code"], F.lit(""))) != "en"),
                lambda c: c["display"],
            )
        ).alias("languages"),
    )


def organization_nodes(resources: Resources) -> DataFrame:
    r = F.col("r")
    return _records(
        resources, "Organization", "identifier", "name", "active", "type", "telecom", "address", "partOf"
    ).select(
        "id",
        r["name"].alias("name"),
        r["active"].alias("active"),
        npis_lenient(r["identifier"]).alias("npis"),
        identifier_pairs(r["identifier"]).alias("identifiers"),
        _labels(r["type"]).alias("org_types"),
        _address_texts(r["address"]).alias("addresses"),
        _texts(F.transform(r["address"], lambda a: F.upper(strip(a["state"])))).alias("states"),
        _telecom_values(r["telecom"], "email").alias("emails"),
        _telecom_values(r["telecom"], "phone").alias("phones"),
        _telecom_values(r["telecom"], "fax").alias("faxes"),
        ref_id(r["partOf"]["reference"]).alias("part_of_id"),
    )


def location_nodes(resources: Resources) -> DataFrame:
    r = F.col("r")
    address = F.get(r["address"], F.lit(0))
    return _records(
        resources, "Location", "identifier", "status", "name", "type", "address", "position", "partOf"
    ).select(
        "id",
        r["name"].alias("name"),
        r["status"].alias("status"),
        _labels(r["type"]).alias("location_types"),
        joined_lines(address["line"]).alias("line"),
        address["city"].alias("city"),
        F.upper(strip(address["state"])).alias("state"),
        address["postalCode"].alias("postal_code"),
        r["position"]["latitude"].alias("latitude"),
        r["position"]["longitude"].alias("longitude"),
        ref_id(r["partOf"]["reference"]).alias("part_of_id"),
    )


def endpoint_nodes(resources: Resources) -> DataFrame:
    r = F.col("r")
    mail = is_email(r["address"])
    ranks = F.transform(
        with_url(r["extension"], K.RANK_URLS),
        lambda e: F.coalesce(e["valuePositiveInt"], e["valueInteger"]),
    )
    return _records(
        resources, "Endpoint", "status", "address", "connectionType", "name", "extension"
    ).select(
        "id",
        r["name"].alias("name"),
        r["status"].alias("status"),
        r["connectionType"]["code"].alias("connection_type"),
        r["address"].alias("address"),
        F.when(~mail & (r["address"] != ""), r["address"]).alias("fhir_address"),
        F.when(mail, r["address"]).alias("direct_address"),
        F.get(F.filter(ranks, lambda x: x.isNotNull()), F.lit(0)).alias("rank"),
    )


def role_nodes(resources: Resources) -> DataFrame:
    r = F.col("r")
    codings = _codings(r["specialty"])
    return _records(
        resources, "PractitionerRole", "identifier", "active", "practitioner", "organization", "specialty"
    ).select(
        "id",
        r["active"].alias("active"),
        F.get(npis_lenient(r["identifier"]), F.lit(0)).alias("npi"),
        ref_id(r["practitioner"]["reference"]).alias("practitioner_id"),
        ref_id(r["organization"]["reference"]).alias("organization_id"),
        _texts(F.transform(codings, lambda c: c["code"])).alias("specialties"),
        _texts(F.transform(codings, lambda c: c["display"])).alias("specialty_displays"),
    )


def affiliation_nodes(resources: Resources) -> DataFrame:
    r = F.col("r")
    return _records(
        resources, "OrganizationAffiliation", "active", "organization", "participatingOrganization", "code", "specialty"
    ).select(
        "id",
        r["active"].alias("active"),
        ref_id(r["organization"]["reference"]).alias("organization_id"),
        ref_id(r["participatingOrganization"]["reference"]).alias("participating_organization_id"),
        _labels(r["code"]).alias("codes"),
        _labels(r["specialty"]).alias("specialties"),
    )


NODE_TABLES = {
    "Practitioner": practitioner_nodes,
    "Organization": organization_nodes,
    "Location": location_nodes,
    "Endpoint": endpoint_nodes,
    "PractitionerRole": role_nodes,
    "OrganizationAffiliation": affiliation_nodes,
}


def node_ids(resources: Resources) -> DataFrame:
    """``node`` (``Type/id``) and ``node_type`` of every resource with an id."""
    out = None
    for rtype, df in resources.items():
        part = (
            _with_id(df)
            .select("id")
            .where(F.col("id") != "")
            .distinct()
            .select(F.concat(F.lit(f"{rtype}/"), "id").alias("node"), F.lit(rtype).alias("node_type"))
        )
        out = part if out is None else out.unionByName(part)
    return out


def _one(ref: Column) -> Column:
    return F.array(ref_id(ref["reference"]))


def _many(refs: Column) -> Column:
    return F.transform(refs, lambda x: ref_id(x["reference"]))


# per type: (field, its ids, other type, relationship, direction of the edge)
EDGE_RULES = {
    "PractitionerRole": [
        ("practitioner", _one, "Practitioner", "HAS_ROLE", "in"),
        ("organization", _one, "Organization", "WORKS_AT", "out"),
        ("location", _many, "Location", "AT_LOCATION", "out"),
        ("endpoint", _many, "Endpoint", "HAS_ENDPOINT", "out"),
    ],
    "OrganizationAffiliation": [
        ("organization", _one, "Organization", "HAS_AFFILIATION", "in"),
        ("participatingOrganization", _one, "Organization", "AFFILIATED_WITH", "out"),
        ("location", _many, "Location", "AT_LOCATION", "out"),
        ("endpoint", _many, "Endpoint", "HAS_ENDPOINT", "out"),
    ],
    "Location": [
        ("managingOrganization", _one, "Organization", "MANAGES", "in"),
        ("partOf", _one, "Location", "PART_OF", "out"),
        ("endpoint", _many, "Endpoint", "HAS_ENDPOINT", "out"),
    ],
    "Organization": [
        ("partOf", _one, "Organization", "PART_OF", "out"),
        ("endpoint", _many, "Endpoint", "HAS_ENDPOINT", "out"),
    ],
    "Endpoint": [("managingOrganization", _one, "Organization", "MANAGES", "in")],
    "Practitioner": [],
}


#: (type that holds the reference, relationship, type it names) of every rule
LINK_TYPES = [(rtype, rel, other) for rtype, rules in EDGE_RULES.items() for _, _, other, rel, _ in rules] + [("Practitioner", "HAS_ENDPOINT", "Endpoint")]
RELATIONSHIPS = tuple(sorted({rel for _, rel, _ in LINK_TYPES}))
#: relationships whose ``src`` is the far end; the resource that holds the reference is ``dst``
INWARD = tuple(sorted({rel for rules in EDGE_RULES.values() for *_, rel, direction in rules if direction == "in"}))


def types_of(rels: Iterable[str]) -> list[str]:
    """Resource types at either end of some relationships."""
    return sorted({t for owner, rel, other in LINK_TYPES if rel in rels for t in (owner, other)})


def relationships_at(rtype: str) -> tuple[str, ...]:
    """Relationships that may touch a node of the type."""
    return tuple(sorted({rel for owner, rel, other in LINK_TYPES if rtype in (owner, other)}))


def _link_list(ids: Column, other: str, rel: str) -> Column:
    def link(i: Column) -> Column:
        return F.struct(F.lit(rel).alias("rel"), F.concat(F.lit(f"{other}/"), i).alias("far"), F.lit(None).cast("bigint").alias("rank"))

    return F.transform(F.filter(ids, lambda i: i.isNotNull()), link)


def _endpoint_links(extension: Column) -> Column:
    return F.transform(
        endpoint_refs(extension, K.ENDPOINT_REFERENCE_URLS),
        lambda e: F.struct(
            F.lit("HAS_ENDPOINT").alias("rel"), F.concat(F.lit("Endpoint/"), e["endpoint_id"]).alias("far"), e["rank"].cast("bigint").alias("rank")
        ),
    )


def links_of(resources: Resources, rels: Iterable[str] | None = None) -> DataFrame | None:
    """One row per line that refers to something: its node ``me`` and its ``links`` (rel, far, rank), whether or not the far end exists.

    ``rels`` limits the relationships; types that have none of them are not read, fields that hold none not built.
    """
    out = None
    for rtype, rules in EDGE_RULES.items():
        rules = [rule for rule in rules if rels is None or rule[3] in rels]
        own = rtype == "Practitioner" and (rels is None or "HAS_ENDPOINT" in rels)
        if rtype not in resources or not (rules or own):
            continue
        lists = [_link_list(ids(F.col(f"r.{field}")), other, rel) for field, ids, other, rel, _ in rules]
        if own:
            lists.append(_endpoint_links(F.col("r.extension")))
        fields = sorted({field for field, *_ in rules} | ({"extension"} if own else set()))
        part = (
            parse_resources(resources[rtype], rtype, ("id", *fields))
            .where(F.col("r.id") != "")
            .select(F.concat(F.lit(f"{rtype}/"), F.col("r.id")).alias("me"), F.flatten(F.array_compact(F.array(*lists))).alias("links"))
            .where(F.size("links") > 0)
        )
        out = part if out is None else out.unionByName(part)
    return out


def _nodes(resources: Resources) -> DataFrame:
    """(node) of every line with an id, repeated as often as the id is."""
    out = None
    for rtype, df in resources.items():
        part = _with_id(df).where("id <> ''").select(F.concat(F.lit(f"{rtype}/"), "id").alias("node"))
        out = part if out is None else out.unionByName(part)
    return out


def build_edges(resources: Resources, rels: Iterable[str] | None = None) -> DataFrame:
    """(src, rel, dst, rank) with both ends present, each once; ``rels`` limits the relationships.

    The end that owns the reference exists by construction. Targets of the others are reduced to distinct ones and those that do not
    exist, usually few, are taken out. Equal edges have one owner, so only links of an owner that occurs twice, or that names
    a target twice, are grouped; all others leave without a shuffle.
    """
    rels = None if rels is None else set(rels)
    links = links_of(resources, rels)
    if links is None:
        spark = next(iter(resources.values())).sparkSession
        return spark.createDataFrame([], "src string, rel string, dst string, rank bigint")
    links = cut_lineage(links, "links")
    pairs = F.transform("links", lambda x: F.struct(x["rel"], x["far"]))
    twice = links.select("me", (F.size(F.array_distinct(pairs)) < F.size("links")).alias("_same"))
    repeated = cut_lineage(twice.groupBy("me").agg(F.count(F.lit(1)).alias("_n"), F.max("_same").alias("_same")).where("_n > 1 OR _same").select("me"), "repeated")
    far_types = {other for _, rel, other in LINK_TYPES if rels is None or rel in rels}
    named = links.select(F.explode("links.far").alias("far")).distinct()
    known = _nodes({t: df for t, df in resources.items() if t in far_types})
    if known is not None:
        named = named.join(known.withColumnRenamed("node", "far"), "far", "left_anti")
    missing = cut_lineage(named, "missing")

    def pairs_of(rows: DataFrame) -> DataFrame:
        return rows.select("me", F.explode("links").alias("e")).select("me", "e.*").join(missing, "far", "left_anti")

    inward = F.col("rel").isin(*INWARD)
    if repeated.isEmpty():
        found = pairs_of(links)
    else:
        # equal edges differ at most in rank: the greatest is kept
        again = pairs_of(links.join(repeated, "me", "left_semi")).groupBy("me", "far", "rel").agg(F.max("rank").alias("rank"))
        found = pairs_of(links.join(repeated, "me", "left_anti")).select("me", "far", "rel", "rank").unionByName(again)
    return found.select(F.when(inward, F.col("far")).otherwise(F.col("me")).alias("src"), "rel", F.when(inward, F.col("me")).otherwise(F.col("far")).alias("dst"), "rank")


def node_type(node: Column) -> Column:
    return F.substring_index(node, "/", 1)



def adjacency(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, a loop once: (node, rel, other, edge)."""
    return _there(edges).unionByName(_back(edges))


def _edge() -> Column:
    return F.concat_ws("|", "src", "rel", "dst").alias("edge")


def _there(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node"), "rel", F.col("dst").alias("other"), _edge())


def _back(edges: DataFrame) -> DataFrame:
    return edges.where("src <> dst").select(F.col("dst").alias("node"), "rel", F.col("src").alias("other"), _edge())


def links_from(edges: DataFrame, frontier: DataFrame) -> DataFrame:
    """Rows of ``adjacency`` at the nodes of ``frontier``, a written table (node).

    Edges are reduced to those that touch the frontier before anything is shuffled by node; Spark knows the size of the
    frontier and broadcasts it when it is small.
    """
    return _there(edges).join(frontier, "node", "left_semi").unionByName(_back(edges).join(frontier, "node", "left_semi"))


def path_levels(
    edges: DataFrame, seeds: DataFrame, hops: int, through: tuple[str, ...] | None = None
) -> Iterator[DataFrame]:
    """The paths of length 1, 2, ... of :func:`k_hop`, each level written to the shared folder."""
    paths = cut_lineage(
        seeds.distinct().select(
            "seed", F.col("seed").alias("node"), F.array().cast("array<string>").alias("used"),
            F.lit("").alias("rels"), F.lit("").alias("nodes"),
        ), "seeds",
    )
    for length in range(1, hops + 1):
        frontier = cut_lineage(paths.select("node").distinct(), "frontier")
        grown = (
            cut_lineage(links_from(edges, frontier), "links")
            .join(paths, "node")
            .where(~F.array_contains("used", F.col("edge")))
            .select(
                "seed",
                F.col("other").alias("node"),
                F.array_append("used", F.col("edge")).alias("used"),
                F.concat_ws(">", F.when(F.col("rels") != "", F.col("rels")), "rel").alias("rels"),
                F.concat_ws(">", F.when(F.col("nodes") != "", F.col("nodes")), "other").alias("nodes"),
            )
        )
        grown = cut_lineage(grown, "paths")
        yield grown.select("seed", F.lit(length).alias("length"), "rels", "nodes", F.col("node").alias("end"))
        paths = grown if through is None else grown.where(node_type(F.col("node")).isin(*through))


def k_hop(
    edges: DataFrame, seeds: DataFrame, hops: int = 1, through: tuple[str, ...] | None = None
) -> DataFrame:
    """All undirected paths of 1..``hops`` edges from the seed nodes; no edge twice on a path.

    ``seeds`` has one column ``seed``. ``through`` restricts the inner nodes to some types.
    Columns: seed, length, rels and nodes (``>``-joined) and the end of the path.
    """
    out = None
    for found in path_levels(edges, seeds, hops, through):
        out = found if out is None else out.unionByName(found)
    return out


def first_paths(paths: DataFrame, limit: int) -> DataFrame:
    """A limited listing in a fixed order: short paths first."""
    return paths.orderBy("length", "seed", "nodes", "rels").limit(limit)


def first_of_k_hop(
    edges: DataFrame, seeds: DataFrame, hops: int, limit: int, through: tuple[str, ...] | None = None
) -> DataFrame:
    """``first_paths`` of ``k_hop``, walked level by level; longer paths are not made once shorter ones fill the listing."""
    out, have = None, 0
    for found in path_levels(edges, seeds, hops, through):
        out = found if out is None else out.unionByName(found)
        have += found.count()
        if have >= limit:
            break
    return first_paths(out, limit)


def all_nodes(resources: Resources) -> DataFrame:
    """(node) of every resource that has an id."""
    out = None
    for rtype, lines in resources.items():
        part = lines.where("id <> ''").select(F.concat(F.lit(f"{rtype}/"), "id").alias("node"))
        out = part if out is None else out.unionByName(part)
    return out


def relationships(edges: DataFrame, nodes: DataFrame, limit: int = 50) -> DataFrame:
    """The first relationships of ``nodes`` (node) with the neighbour and its type; a node without any gives one row of nulls.

    Every node gives a row and rows are listed by node, so no more than the ``limit`` smallest nodes can be listed.
    """
    wanted = cut_lineage(nodes.select("node").distinct().orderBy("node").limit(limit), "nodes")
    found = wanted.join(links_from(edges, wanted).drop("edge"), "node", "left")
    return (
        found.select("node", "rel", F.col("other").alias("neighbour"), node_type(F.col("other")).alias("neighbour_type"))
        .orderBy("node", "rel", "neighbour")
        .limit(limit)
    )


def seeds_by_npi(resources: Resources, npi: str) -> DataFrame:
    """Nodes carrying the NPI: practitioners and roles by their first, organizations by any."""
    out = None
    for rtype in ("Practitioner", "Organization", "PractitionerRole"):
        if rtype not in resources:
            continue
        near = resources[rtype].where(F.col("value").contains(npi))
        found = npis_lenient(F.col("r.identifier"))
        if rtype != "Organization":
            found = F.slice(found, 1, 1)
        part = (
            parse_resources(near, rtype, ("id", "identifier"))
            .where(F.array_contains(found, npi))
            .select(F.concat(F.lit(f"{rtype}/"), "r.id").alias("seed"))
        )
        out = part if out is None else out.unionByName(part)
    return out


def seeds_where(nodes: DataFrame, rtype: str, condition: Column) -> DataFrame:
    return nodes.where(condition).select(F.concat(F.lit(f"{rtype}/"), "id").alias("seed"))


def practitioners_at_state(edges: DataFrame, locations: DataFrame, state: str, people: DataFrame | None = None) -> DataFrame:
    """Distinct practitioners with a role at a location in the state; ``people`` (seed) limits them to some.

    Locations and people are written first, so that Spark knows how few they are and edges are reduced before any shuffle.
    """
    there = cut_lineage(locations.where(F.col("state") == state).select(F.concat(F.lit("Location/"), "id").alias("dst")), "state-locations")
    held = edges.where("rel = 'HAS_ROLE'")
    if people is not None:
        held = held.join(cut_lineage(people.select(F.col("seed").alias("src")).distinct(), "people"), "src", "left_semi")
    roles = (
        edges.where((F.col("rel") == "AT_LOCATION") & F.col("src").startswith("PractitionerRole/"))
        .join(there, "dst", "left_semi")
        .select(F.col("src").alias("dst"))
        .distinct()
    )
    return held.join(roles, "dst", "left_semi").select(F.col("src").alias("seed")).distinct()


def _next_level(edges: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(node, prev) one step beyond the last level; neighbours of a level lie in it, in the one before or in the next."""
    grown = links_from(edges, levels[-1].select("node")).groupBy(F.col("other").alias("next")).agg(F.min("node").alias("prev")).withColumnRenamed("next", "node")
    for known in levels[-2:]:
        grown = grown.join(known.select("node"), "node", "left_anti")
    return cut_lineage(grown, "level")


def _trail(levels: list[DataFrame], node: str) -> list[str]:
    """Nodes from the first level to ``node`` in the last one: one lookup per level."""
    out = [node]
    for level in levels[:0:-1]:
        out.append(level.where(F.col("node") == out[-1]).agg(F.min("prev")).first()[0])
    return out[::-1]


def shortest_path(edges: DataFrame, source: str, target: str, max_hops: int = 10) -> DataFrame:
    """One shortest undirected path as (source, target, hops, path); no row if none is short enough.

    Breadth first from both ends. Each step expands the end whose last level has fewer adjacent edges, so a hub is only read
    when nothing smaller is left. Both ends hold whole levels, so the first level that meets the other end's last one
    ends the search at the sum of the depths. Of several meeting nodes and of several ways to a node the smallest is taken.
    """
    spark = edges.sparkSession
    ends = (source, target)
    sides = [[cut_lineage(spark.range(1).select(F.lit(x).alias("node"), F.lit(None).cast("string").alias("prev")), "level")] for x in ends]
    adjacent: list[int | None] = [None, None]
    meet = source if source == target else None
    while meet is None and sum(map(len, sides)) - 2 < max_hops:
        for i, levels in enumerate(sides):
            if adjacent[i] is None:
                adjacent[i] = links_from(edges, levels[-1].select("node")).count()
        side = 0 if adjacent[0] <= adjacent[1] else 1
        level = _next_level(edges, sides[side])
        if level.isEmpty():
            break
        sides[side].append(level)
        adjacent[side] = None
        meet = level.join(sides[1 - side][-1].select("node"), "node", "left_semi").agg(F.min("node")).first()[0]
    found = []
    if meet is not None:
        path = _trail(sides[0], meet) + _trail(sides[1], meet)[-2::-1]
        found = [(source, target, len(path) - 1, ">".join(path))]
    return spark.createDataFrame(found, "source string, target string, hops int, path string")


def degrees(edges: DataFrame) -> DataFrame:
    """Undirected degree per node, loops counted once; combined map-side, so hubs are no problem."""
    ends = F.when(F.col("src") == F.col("dst"), F.array("src")).otherwise(F.array("src", "dst"))
    return edges.select(F.explode(ends).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def employment(edges: DataFrame) -> DataFrame:
    """Distinct (practitioner, organization) pairs linked by a role."""
    has_role = edges.where("rel = 'HAS_ROLE'").select(F.col("src").alias("practitioner"), F.col("dst").alias("role"))
    works_at = edges.where("rel = 'WORKS_AT'").select(F.col("src").alias("role"), F.col("dst").alias("organization"))
    return has_role.join(works_at, "role").select("practitioner", "organization").distinct()


def shared_employer_pairs(bridge: DataFrame, limit: int = 25) -> DataFrame:
    """The first ``limit`` (practitioner_1 < practitioner_2, organization), in that order.

    A pair among the first ``limit`` overall is among the first ``limit`` of its organization, and
    those only involve its ``limit + 1`` smallest practitioners. So each organization is cut to
    that many before the self-join, which keeps the result exact at a bounded size per group. The cut is made twice,
    first within hashed parts of an organization, so that no task sorts a whole large one.
    """
    from pyspark.sql import Window

    parts = int(bridge.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = bridge.withColumn("_part", F.pmod(F.xxhash64("practitioner"), F.lit(parts)))
    few = split
    for keys in (("organization", "_part"), ("organization",)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("practitioner"))
        few = few.withColumn("_r", rank).where(F.col("_r") <= limit + 1).drop("_r")
    few = few.drop("_part")
    right = few.select("organization", F.col("practitioner").alias("practitioner_2"))
    return (
        few.withColumnRenamed("practitioner", "practitioner_1")
        .join(right, "organization")
        .where("practitioner_1 < practitioner_2")
        .select("practitioner_1", "practitioner_2", "organization")
        .orderBy("practitioner_1", "practitioner_2", "organization")
        .limit(limit)
    )


def shared_employer_counts(bridge: DataFrame) -> DataFrame:
    """Number of practitioner pairs per organization, in closed form instead of by listing them."""
    n = F.count(F.lit(1))
    return bridge.groupBy("organization").agg(n.alias("practitioners"), (n * (n - 1) / 2).cast("bigint").alias("pairs"))


def organizations_sharing(bridge: DataFrame, more_than: int = 5, frequent: int = 100) -> DataFrame:
    """Organization pairs with more than ``more_than`` practitioners in common.

    Practitioners of at most ``frequent`` organizations are paired and counted directly. For the others exact prefix filtering:
    with practitioners ordered from rare to frequent, two organizations that share c of them must meet outside the last c-1
    of each, so up to c-1 frequent practitioners of an organization make no candidate pairs. The join that finds candidates
    also counts what their prefixes share; what was left out is looked up for pairs that it could bring above the limit.
    """
    from pyspark.sql import Window

    c = more_than + 1
    bridge = cut_lineage(bridge)
    n = F.count(F.lit(1))
    small = cut_lineage(bridge.groupBy("organization").agg(n.alias("_n")).where(F.col("_n") < c).select("organization"))
    often = cut_lineage(bridge.groupBy("practitioner").agg(n.alias("f")).where(F.col("f") > frequent))
    large = bridge.join(small, "organization", "left_anti")
    # position from the frequent end, so that the window keeps at most c - 1 rows to drop
    order = Window.partitionBy("organization").orderBy(F.desc("f"), F.desc("practitioner"))
    last = cut_lineage(
        large.join(often, "practitioner")
        .withColumn("_r", F.row_number().over(order))
        .where(F.col("_r") <= c - 1)
        .select("organization", "practitioner")
    )
    none_left_out = last.isEmpty()
    prefix = large.select("organization", "practitioner")
    if not none_left_out:
        prefix = cut_lineage(prefix.join(last, ["organization", "practitioner"], "left_anti"))
    left = prefix.select("practitioner", F.col("organization").alias("organization_1"))
    right = prefix.select("practitioner", F.col("organization").alias("organization_2"))
    candidates = (
        left.join(right, "practitioner")
        .where("organization_1 < organization_2")
        .groupBy("organization_1", "organization_2")
        .agg(n.alias("_common"))
    )
    if none_left_out:
        return candidates.where(F.col("_common") > more_than).withColumnRenamed("_common", "shared_practitioners")
    # what the prefixes did not count: the at most c - 1 frequent practitioners of either side
    tails = last.groupBy("organization").agg(F.collect_list("practitioner").alias("_tail"))

    def tail(i: int) -> DataFrame:
        return tails.select(F.col("organization").alias(f"organization_{i}"), F.col("_tail").alias(f"_tail_{i}"))

    known = candidates.join(tail(1), "organization_1", "left").join(tail(2), "organization_2", "left")
    empty = F.array().cast("array<string>")
    tail_1, tail_2 = (F.coalesce(F.col(f"_tail_{i}"), empty) for i in (1, 2))
    pairs = cut_lineage(known.where(F.col("_common") + F.size(tail_1) + F.size(tail_2) > more_than))

    def questions(org: str, only: Column) -> Column:
        return F.transform(only, lambda p: F.struct(F.col(org).alias("organization"), p.alias("practitioner")))

    asked = F.concat(
        questions("organization_2", F.array_except(tail_1, tail_2)),
        questions("organization_1", F.array_except(tail_2, tail_1)),
    )
    found = (
        pairs.select("organization_1", "organization_2", F.explode(asked).alias("q"))
        .select("organization_1", "organization_2", "q.*")
        .join(prefix, ["organization", "practitioner"], "left_semi")
        .groupBy("organization_1", "organization_2")
        .agg(F.count(F.lit(1)).alias("_found"))
    )
    shared = F.col("_common") + F.size(F.array_intersect(tail_1, tail_2)) + F.coalesce("_found", F.lit(0))
    return (
        pairs.join(found, ["organization_1", "organization_2"], "left")
        .select("organization_1", "organization_2", shared.alias("shared_practitioners"))
        .where(F.col("shared_practitioners") > more_than)
    )


def assemble_network(edges: DataFrame, practitioners: DataFrame) -> DataFrame:
    """practitioner with its roles, and each role with organization, location and endpoint, or NULL.

    ``practitioners`` has a column ``practitioner``; a role with several locations and endpoints
    gives every combination, as the pattern query does.
    """

    def side(rel: str, name: str) -> DataFrame:
        return edges.where((F.col("rel") == rel) & F.col("src").startswith("PractitionerRole/")).select(
            F.col("src").alias("role"), F.col("dst").alias(name)
        )

    people = practitioners.select("practitioner").distinct()
    roles = edges.where("rel = 'HAS_ROLE'").select(F.col("src").alias("practitioner"), F.col("dst").alias("role"))
    # roles are the large side: looked up from there, a practitioner with very many roles is spread
    held = salted_lookup(roles, people, "practitioner")
    lonely = people.join(roles.select("practitioner").distinct(), "practitioner", "left_anti")
    return (
        held.join(side("WORKS_AT", "organization"), "role", "left")
        .join(side("AT_LOCATION", "location"), "role", "left")
        .join(side("HAS_ENDPOINT", "endpoint"), "role", "left")
        .select("practitioner", "role", "organization", "location", "endpoint")
        .unionByName(lonely, allowMissingColumns=True)
    )


def integrity(resources: Resources, edges: DataFrame) -> DataFrame:
    """Counts that tell whether the graph holds what the resources say: (metric, n)."""
    wrong = None
    for rtype, df in resources.items():
        part = df.select((F.get_json_object("value", "$.resourceType") != rtype).alias("w"))
        wrong = part if wrong is None else wrong.unionByName(part)
    misfiled = wrong.agg(F.count(F.when(F.col("w"), 1)).alias("n"))

    def unlinked(rtype: str, *ends: tuple[str, str]) -> DataFrame:
        linked = None
        for rel, column in ends:
            part = edges.where(F.col("rel") == rel).select(F.col(column).alias("node")).distinct()
            linked = part if linked is None else linked.unionByName(part)
        return node_ids({rtype: resources[rtype]}).join(linked, "node", "left_anti").agg(F.count(F.lit(1)).alias("n"))

    nameless = practitioner_nodes(resources).where(F.coalesce("name", F.lit("")) == "")
    referring = role_nodes(resources).where("practitioner_id IS NOT NULL")
    linked = edges.where("rel = 'HAS_ROLE'").select("dst").distinct()
    parts = {
        "misclassified_nodes": misfiled,
        "orphan_roles": unlinked("PractitionerRole", ("HAS_ROLE", "dst")),
        "orphan_affiliations": unlinked(
            "OrganizationAffiliation", ("HAS_AFFILIATION", "dst"), ("AFFILIATED_WITH", "src")
        ),
        "nameless_practitioners": nameless.agg(F.count(F.lit(1)).alias("n")),
        "roles_with_reference": referring.agg(F.count(F.lit(1)).alias("n")),
        "roles_with_edge": linked.agg(F.count(F.lit(1)).alias("n")),
    }
    out = None
    for name, df in parts.items():
        part = df.select(F.lit(name).alias("metric"), "n")
        out = part if out is None else out.unionByName(part)
    return out
