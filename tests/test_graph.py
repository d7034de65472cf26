import itertools
import random

import pytest
from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.operators import graph, hierarchy, subset
from carelattice.operators.docgraph import filter_docgraph
from carelattice.runtime import salted_lookup


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --- hierarchy ---

TREE = {
    "root": None, "a": "root", "b": "a", "c": "b", "lost": "nowhere", "below": "lost", "self": "self", "x": "y", "y": "x", "tail": "x", "tail2": "tail", "p": "q", "q": "r", "r": "p",
}


def tree(spark, parents):
    return frame(spark, list(parents.items()), "id STRING, parent_id STRING")


def walk(parents):
    """Depth, cycle members by walking."""
    depth, cyclic = {}, set()
    for start in parents:
        seen, node = [], start
        while node in parents and node not in seen:
            seen.append(node)
            node = parents[node]
        if node in seen:
            cyclic.update(seen[seen.index(node):])
            depth[start] = None
        else:
            depth[start] = len(seen)
    return depth, cyclic


def test_depths_and_cycles(spark, rows):
    depth, cyclic = walk(TREE)
    assert dict(rows(hierarchy.depths(tree(spark, TREE)))) == depth
    assert {r[0] for r in rows(hierarchy.cycle_members(tree(spark, TREE)))} == cyclic == {"self", "x", "y", "p", "q", "r"}
    assert rows(hierarchy.broken_parents(tree(spark, TREE))) == [("lost", "nowhere")]
    assert rows(hierarchy.deepest(tree(spark, TREE))) == [("c", 4)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_hierarchies(spark, rows, seed):
    rng = random.Random(seed)
    parents = {str(i): rng.choice([None, "gone", *[str(rng.randrange(60)) for _ in range(6)]]) for i in range(60)}
    parents.update({f"chain{i}": f"chain{i - 1}" if i else "0" for i in range(70)})
    depth, cyclic = walk(parents)
    got = {r.node: r for r in hierarchy.facts(tree(spark, parents)).collect()}
    assert {n: r.depth for n, r in got.items()} == depth
    assert {n for n, r in got.items() if r.cyclic} == cyclic
    assert {n for n, r in got.items() if r.broken} == {n for n, p in parents.items() if p is not None and p not in parents}


def test_ancestors_stop_at_five_levels_and_at_cycles(spark, rows):
    parents = {str(i): str(i - 1) if i else None for i in range(8)} | {"m": "n", "n": "m"}
    got = rows(hierarchy.ancestors(tree(spark, parents), 5))
    want = [(str(i), str(i - d), d) for i in range(8) for d in range(1, 6) if i - d >= 0]
    want += [("m", "n", 1), ("m", "m", 2), ("n", "m", 1), ("n", "n", 2)]
    assert got == sorted(want, key=repr)


# --- lookups and paths ---


def test_salted_lookup_equals_a_plain_join(spark, rows):
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 100).alias("k"), "id")
    right = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        salted = salted_lookup(left.repartition(4), right, "k", how).select(plain.columns)
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def brute_paths(edges, seeds, hops, through=None):
    links = [(s, r, d, (s, r, d)) for s, r, d in edges] + [(d, r, s, (s, r, d)) for s, r, d in edges if s != d]
    out, paths = [], [(s, s, (), (), ()) for s in seeds]
    for n in range(1, hops + 1):
        paths = [(s, o, used + (e,), rels + (r,), nodes + (o,)) for s, at, used, rels, nodes in paths for f, r, o, e in links if f == at and e not in used]
        out += [(s, n, ">".join(rels), ">".join(nodes), at) for s, at, _, rels, nodes in paths]
        if through:
            paths = [p for p in paths if p[1].split("/")[0] in through]
    return sorted(out, key=repr)


def random_edges(seed, n=14, m=24):
    rng = random.Random(seed)
    nodes = [f"{t}/{i}" for i in range(n) for t in ("A", "B")]
    return sorted({(rng.choice(nodes), rng.choice(["R", "S"]), rng.choice(nodes)) for _ in range(m)})


@pytest.mark.parametrize("through", [None, ("B",)])
def test_paths_against_brute_force(spark, rows, through):
    edges = random_edges(3) + [("A/0", "R", "A/0")]
    df = frame(spark, edges, "src STRING, rel STRING, dst STRING")
    seeds = ["A/0", "B/1", "A/2"]
    got = graph.k_hop(df, frame(spark, [(s,) for s in seeds], "seed STRING"), 3, through)
    assert rows(got) == brute_paths(edges, seeds, 3, through)


def test_intervals_and_rollup_against_brute_force(spark):
    rng = random.Random(3)
    up = {f"n{i:03d}": f"n{rng.randrange(i):03d}" if i and rng.random() < 0.9 else None for i in range(120)}
    up |= {f"h{i}": "n000" for i in range(40)} | {"lost": "gone", "c1": "c2", "c2": "c1", "below": "c1"} | {f"d{i}": f"d{i - 1}" if i else None for i in range(30)}
    nodes = spark.createDataFrame(list(up.items()), "id string, parent_id string")
    good = {n for n in up if n not in ("c1", "c2", "below")}

    def chain(n):
        while n in good:
            yield n
            n = up[n]

    below = {n: {m for m in good if n in chain(m)} for n in good}
    got = {r.node: r for r in hierarchy.intervals(nodes).collect()}
    assert set(got) == good and sorted(r.first for r in got.values()) == list(range(1, len(good) + 1))
    for n, r in got.items():
        assert {m for m, x in got.items() if r.first <= x.first <= r.last} == below[n] and r.depth == len(list(chain(n)))
    weights = spark.createDataFrame([(n, k) for k, n in enumerate(sorted(good)) if k % 3] + [("n000", 5), ("unknown", 7)], "node string, weight bigint")
    weight = {n: k for k, n in enumerate(sorted(good)) if k % 3}
    weight["n000"] = weight.get("n000", 0) + 5
    sums = {r.node: (r.nodes, r.total) for r in hierarchy.rollup(hierarchy.intervals(nodes), weights, block=16).collect()}
    assert sums == {n: (len(below[n]), sum(weight.get(m, 0) for m in below[n])) for n in good}
    assert hierarchy.intervals(nodes.where("false")).collect() == []


def test_shortest_path_reads_a_hub_last(spark, monkeypatch):
    """Both ends hang on long, thin ways; the near end's way goes past a hub of thousands."""
    way = [(f"N/{i}", "R", f"N/{i + 1}", None) for i in range(6)]
    hub = [("N/1", "R", "H/0", None)] + [("H/0", "R", f"L/{i}", None) for i in range(3000)]
    df = spark.createDataFrame(way + hub, "src string, rel string, dst string, rank int").cache()
    read = []
    links_from = graph.links_from

    def counted(edges, frontier):
        out = links_from(edges, frontier)
        read.append(out.count())
        return out

    monkeypatch.setattr(graph, "links_from", counted)
    assert graph.shortest_path(df, "N/0", "N/6").first().path == ">".join(f"N/{i}" for i in range(7))
    assert sum(read) < 100  # one-sided, the level after N/1 reads the hub's 3,001 edges


def test_shortest_paths_against_brute_force(spark):
    edges = random_edges(5)
    df = frame(spark, edges, "src STRING, rel STRING, dst STRING")
    links = {(a, b) for s, _, d in edges for a, b in ((s, d), (d, s))}
    dist, level, n = {"A/0": 0}, {"A/0"}, 0
    while level:
        n += 1
        level = {b for a, b in links if a in level} - set(dist)
        dist.update(dict.fromkeys(level, n))
    far = max(dist, key=lambda k: (dist[k], k))
    found = graph.shortest_path(df, "A/0", far).first()
    nodes = found.path.split(">")
    assert found.hops == dist[far] == len(nodes) - 1
    assert all((a, b) in links for a, b in itertools.pairwise(nodes))
    assert graph.shortest_path(df, "A/0", "Z/0").count() == 0
    assert graph.shortest_path(df, "A/0", far, max_hops=dist[far] - 1).count() == 0
    assert graph.shortest_path(df, "A/0", "A/0").first().hops == 0


def random_bridge(seed):
    """Two practitioners work everywhere, the others here and there."""
    rng = random.Random(seed)
    pairs = {(f"p{i}", f"o{rng.randrange(12)}") for i in range(60) for _ in range(rng.randrange(1, 6))}
    return sorted(pairs | {(f"hub{i}", f"o{j}") for i in range(2) for j in range(12)})


@pytest.mark.parametrize("more_than", [0, 1, 2, 5])
def test_organizations_sharing_against_brute_force(spark, rows, more_than):
    pairs = random_bridge(more_than)
    members = {}
    for p, o in pairs:
        members.setdefault(o, set()).add(p)
    want = [(a, b, len(members[a] & members[b])) for a, b in itertools.combinations(sorted(members), 2) if len(members[a] & members[b]) > more_than]
    bridge = frame(spark, pairs, "practitioner STRING, organization STRING")
    assert rows(graph.organizations_sharing(bridge, more_than)) == want


@pytest.mark.parametrize("frequent", [1, 4, 11])
@pytest.mark.parametrize("more_than", [1, 3, 5])
def test_organizations_sharing_leaves_out_frequent_practitioners_only(spark, rows, more_than, frequent):
    pairs = random_bridge(more_than) + [("p0", "lonely"), ("hub0", "lonely")]
    members = {}
    for p, o in pairs:
        members.setdefault(o, set()).add(p)
    want = [(a, b, len(members[a] & members[b])) for a, b in itertools.combinations(sorted(members), 2) if len(members[a] & members[b]) > more_than]
    bridge = frame(spark, sorted(set(pairs)), "practitioner STRING, organization STRING")
    assert rows(graph.organizations_sharing(bridge, more_than, frequent)) == want


@pytest.mark.parametrize("limit", [3, 25, 100_000])
def test_shared_employers_against_brute_force(spark, limit):
    pairs = random_bridge(9)
    all_pairs = sorted((a, b, o) for (a, o), (b, o2) in itertools.product(pairs, pairs) if o == o2 and a < b)
    bridge = frame(spark, pairs, "practitioner STRING, organization STRING")
    assert [tuple(r) for r in graph.shared_employer_pairs(bridge, limit).collect()] == all_pairs[:limit]
    assert graph.shared_employer_counts(bridge).agg(F.sum("pairs")).first()[0] == len(all_pairs)


def test_docgraph_against_brute_force(spark, rows):
    rng = random.Random(4)
    data = sorted({(rng.randrange(20), rng.randrange(20)): rng.randrange(100) for _ in range(150)}.items())
    data = [(a, b, n, 1, 0.5, 0.5) for (a, b), n in data]
    schema = "from_npi BIGINT, to_npi BIGINT, patient_count BIGINT, transaction_count BIGINT, average_day_wait DOUBLE, std_day_wait DOUBLE"
    keys = {2, 3, 5, 7}
    key_df = frame(spark, [(k,) for k in [*keys, 2, None]], "distinct_npi BIGINT")
    for mode, test in (("either", lambda a, b: a in keys or b in keys), ("both", lambda a, b: a in keys and b in keys)):
        got = filter_docgraph(frame(spark, data, schema), key_df, mode=mode, patient_floor=40)
        assert rows(got) == sorted((d for d in data if test(d[0], d[1]) and d[2] >= 40), key=repr)


# --- edges and subsets on hand-made resources ---


def directory(lines):
    ref = lambda r: {"reference": r}
    return {
        "Practitioner": lines(
            {"resourceType": "Practitioner", "id": "1", "address": [{"state": "TX"}], "identifier": [{"system": "http://hl7.org/fhir/sid/us-npi", "value": "100"}]},
            {"resourceType": "Practitioner", "id": "11", "address": [{"state": "wy"}]},
        ),
        "Organization": lines(
            {"resourceType": "Organization", "id": "o1", "address": [{"state": "TX"}], "location": [ref("Location/l1")], "endpoint": [ref("Endpoint/e1")]},
            {"resourceType": "Organization", "id": "o2", "address": [{}, {"state": "WY"}], "endpoint": [ref("Endpoint/e2")]},
            {"resourceType": "Organization", "id": "o3", "partOf": ref("Organization/o2")},
        ),
        "Location": lines(
            {"resourceType": "Location", "id": "l1", "address": {"state": "WY"}, "managingOrganization": ref("Organization/o3")},
            {"resourceType": "Location", "id": "l2", "address": [{"state": "TX"}], "partOf": ref("Location/l1")},
        ),
        "PractitionerRole": lines(
            {"resourceType": "PractitionerRole", "id": "r1", "practitioner": ref("Practitioner/1"), "organization": ref("Organization/o3"), "location": [ref("Location/l2")]},
            {"resourceType": "PractitionerRole", "id": "r2", "practitioner": ref("https://h/fhir/Practitioner/11"), "organization": ref("#contained")},
            {"resourceType": "PractitionerRole", "id": "r3", "practitioner": ref("Practitioner/1"), "organization": ref("Organization/o1"), "endpoint": [ref("Endpoint/e3"), ref("Endpoint/none")]},
        ),
        "OrganizationAffiliation": lines(
            {"resourceType": "OrganizationAffiliation", "id": "a1", "organization": ref("Organization/o3"), "participatingOrganization": ref("Organization/o2")},
            {"resourceType": "OrganizationAffiliation", "id": "a2", "organization": ref("Organization/o3"), "location": ref("Location/l1")},
            {"resourceType": "OrganizationAffiliation", "id": "a3", "organization": ref("Organization/o3")},
        ),
        "Endpoint": lines(
            *[{"resourceType": "Endpoint", "id": f"e{i}"} for i in (1, 2, 3)],
            {"resourceType": "Endpoint", "id": "e4", "managingOrganization": ref("Organization/o2")},
            {"resourceType": "Endpoint", "id": "e5", "managingOrganization": ref("Organization/o3")},
        ),
    }


def test_state_subset(lines, rows):
    # o1 comes by its location and brings e1; o2 by its address brings e4 as manager but not e2;
    # role r2 refers to practitioner 11, which does not match practitioner 1
    want = {
        "Location": ["l1"], "Organization": ["o1", "o2"], "Practitioner": ["11"], "PractitionerRole": ["r2", "r3"], "OrganizationAffiliation": ["a1", "a2"], "Endpoint": ["e1", "e3", "e4"],
    }
    flat = sorted((t, i) for t, ids in want.items() for i in ids)
    resources = directory(lines)
    assert rows(subset.state_subset_ids(resources, ["wy"])) == flat
    wider = rows(subset.state_subset_ids(resources, ["wy"], expand=True))
    assert wider == sorted(flat + [("Endpoint", "e2"), ("Practitioner", "1")])


def test_subset_lines_are_input_lines(lines, rows):
    resources = directory(lines)
    bronze = None
    for df in resources.values():
        bronze = df if bronze is None else bronze.unionByName(df)
    out = subset.state_subset(resources, bronze.unionByName(bronze), ["WY"])
    assert out.count() == 11 and out.exceptAll(bronze.select(out.columns)).isEmpty()


def test_network(lines, rows):
    bronze = None
    for df in directory(lines).values():
        bronze = df if bronze is None else bronze.unionByName(df)
    got = rows(subset.practitioner_network(bronze, "100"), "resource_type", "id")
    assert got == sorted([("Practitioner", "1"), ("PractitionerRole", "r1"), ("PractitionerRole", "r3"), ("Organization", "o3"), ("Organization", "o1"), ("Location", "l2"), ("Endpoint", "e3"),
                          ("Organization", "o2"), ("Location", "l1"), ("Endpoint", "e1")])
    assert subset.practitioner_network(bronze, "999").count() == 0


def test_edges_need_both_ends(lines, rows):
    got = rows(graph.build_edges(directory(lines)), "src", "rel", "dst")
    assert ("PractitionerRole/r3", "HAS_ENDPOINT", "Endpoint/e3") in got
    assert not any("none" in d or "contained" in d for _, _, d in got)
    assert ("Practitioner/11", "HAS_ROLE", "PractitionerRole/r2") in got
    assert ("Organization/o3", "MANAGES", "Location/l1") in got and ("Organization/o3", "PART_OF", "Organization/o2") in got
    assert len(got) == len(set(got))


def test_network_assembly_keeps_lonely_practitioners(spark, lines, rows):
    edges = graph.build_edges(directory(lines))
    people = frame(spark, [("Practitioner/1",), ("Practitioner/none",)], "practitioner STRING")
    got = rows(graph.assemble_network(edges, people))
    assert ("Practitioner/none", None, None, None, None) in got
    assert ("Practitioner/1", "PractitionerRole/r1", "Organization/o3", "Location/l2", None) in got
    assert len(got) == 3


def test_edges_of_one_relationship_read_only_its_types(lines, rows):
    resources = directory(lines)
    whole = rows(graph.build_edges(resources).where("rel = 'PART_OF'"))
    refused = F.raise_error(F.lit("not to be read")).cast("string")
    for rtype in set(resources) - {"Organization", "Location"}:
        resources[rtype] = resources[rtype].withColumn("id", refused).withColumn("value", refused)
    assert rows(graph.build_edges(resources, ["PART_OF"])) == whole != []


def test_equal_edges_of_a_line_and_of_two_lines_are_one(lines, rows):
    def points(endpoint, rank):
        return {"url": K.ENDPOINT_REFERENCE_URLS[0], "valueReference": {"reference": f"Endpoint/{endpoint}"}, "extension": [{"url": "rank", "valuePositiveInt": rank}]}

    person = {"resourceType": "Practitioner", "id": "p"}
    resources = {
        "Practitioner": lines(person | {"extension": [points("e", 1), points("e", 3), points("f", 2), points("none", 1)]}, person | {"extension": [points("e", 2)]}),
        "Endpoint": lines({"resourceType": "Endpoint", "id": "e"}, {"resourceType": "Endpoint", "id": "f"}, {"resourceType": "Endpoint", "id": "f"}),
    }
    assert rows(graph.build_edges(resources)) == [("Practitioner/p", "HAS_ENDPOINT", "Endpoint/e", 3), ("Practitioner/p", "HAS_ENDPOINT", "Endpoint/f", 2)]


def test_practitioners_at_state_of_some_people(spark, rows):
    at = [(f"PractitionerRole/r{k}", "AT_LOCATION", f"Location/l{k % 2}", None) for k in range(6)]
    held = [(f"Practitioner/p{k // 2}", "HAS_ROLE", f"PractitionerRole/r{k}", None) for k in range(5)]
    edges = spark.createDataFrame(at + held, "src string, rel string, dst string, rank long")
    places = spark.createDataFrame([("l0", "CA"), ("l1", "NY")], "id string, state string")
    people = spark.createDataFrame([("Practitioner/p1",), ("Practitioner/p2",), ("Practitioner/p2",)], "seed string")
    assert rows(graph.practitioners_at_state(edges, places, "CA")) == [("Practitioner/p0",), ("Practitioner/p1",), ("Practitioner/p2",)]
    assert rows(graph.practitioners_at_state(edges, places, "CA", people)) == [("Practitioner/p1",), ("Practitioner/p2",)]
    assert rows(graph.practitioners_at_state(edges, places, "NY", people)) == [("Practitioner/p1",)]


@pytest.mark.parametrize("limit", [0, 1_000])
def test_subset_with_broadcast_and_shuffled_targets(lines, rows, monkeypatch, limit):
    """Versions of one id, the second of which alone names the kept location or an endpoint."""
    monkeypatch.setattr(subset, "BROADCAST_REFS", limit)
    ref = lambda r: {"reference": r}
    resources = {
        "Location": lines({"id": "l1", "address": {"state": "WY"}}, {"id": "l2", "address": {"state": "CA"}}),
        "Organization": lines({"id": "o1", "location": [ref("Location/l1"), ref("Location/l1")], "endpoint": [ref("Endpoint/e1")]}),
        "Practitioner": lines({"id": "p1", "address": [{"state": "CA"}]}),
        "PractitionerRole": lines(
            {"id": "r1", "location": [ref("Location/l2")], "endpoint": [ref("Endpoint/e2")], "practitioner": ref("Practitioner/p1")}, {"id": "r1", "location": [ref("Location/l1")]},
            *({"id": f"s{k}", "organization": ref("Organization/o1")} for k in range(9)), {"id": "r3", "location": [ref("Location/l2")], "endpoint": [ref("Endpoint/e3")]},
        ),
        "OrganizationAffiliation": lines({"id": "a1", "participatingOrganization": ref("Organization/o1")}),
        "Endpoint": lines({"id": "e1"}, {"id": "e2"}, {"id": "e3"}),
    }
    kept = [("Location", "l1"), ("Organization", "o1"), *(("PractitionerRole", x) for x in ("r1", *(f"s{k}" for k in range(9)))), ("OrganizationAffiliation", "a1"), ("Endpoint", "e1"), ("Endpoint", "e2")]
    assert rows(subset.state_subset_ids(resources, ["wy"])) == sorted(kept, key=repr)
    assert rows(subset.state_subset_ids(resources, ["wy"], expand=True)) == sorted([*kept, ("Practitioner", "p1")], key=repr)


def test_lines_of_a_subset_are_joined_to_written_ids(spark, rows, monkeypatch):
    written, real = [], subset.cut_lineage
    monkeypatch.setattr(subset, "cut_lineage", lambda df, name="stage", by=None: written.append(name) or real(df, name, by))
    bronze = spark.createDataFrame([("A", "1", "x"), ("A", "1", "w"), ("A", "2", "y"), ("B", "1", "z")], "resource_type string, id string, value string")
    assert rows(subset.lines_of(bronze, bronze.select("resource_type", "id").where("id = '1'"))) == [("A", "1", "w"), ("B", "1", "z")]
    assert written[0] == "subset-ids"
