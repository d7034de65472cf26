"""What the star tables say about each directory record, as SQL common table expressions.

Written from the star columns alone; no expression here touches resource JSON.
"""

from __future__ import annotations

from carelattice.sources.star import PRIORITY_NUCC, SEGMENT_NUCC, STATES


def lookup(column: str, table: dict, part: int) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v[part]}'" for k, v in table.items())
    return f"CASE {column} {whens} END"


def state(key: str) -> str:
    return "([" + ", ".join(f"'{s}'" for s in STATES) + f"])[({key}) + 1]"


def pad(prefix: str, key: str) -> str:
    return f"'{prefix}-' || lpad(CAST({key} AS VARCHAR), 8, '0')"


def initcap(column: str) -> str:
    return f"(upper({column}[1]) || lower({column}[2:]))"


PRELUDE = f"""WITH RECURSIVE
prac AS (
  SELECT c_custkey AS k, {pad('prac', 'c_custkey')} AS id, c_mktsegment AS seg, c_nationkey AS nk,
    CASE WHEN c_custkey % 50 <> 0 THEN '1' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS npi,
    CASE WHEN c_custkey % 30 <> 0 THEN c_acctbal >= 0 END AS active,
    CASE WHEN c_custkey % 40 = 3 THEN 'Test' WHEN c_custkey % 90 = 5 THEN 'O''Brien 2'
         WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE {initcap('c_mktsegment')} END AS family,
    CASE WHEN c_custkey % 25 = 7 THEN NULL WHEN c_custkey % 35 = 9 THEN 'J'
         ELSE {initcap('c_mktsegment')} END AS first_given,
    CASE WHEN c_custkey % 25 <> 7 AND c_custkey % 35 <> 9 THEN 'Q' END AS middle,
    CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 20 <= 9 THEN 'male'
         WHEN c_custkey % 20 <= 18 THEN 'female' ELSE 'other' END AS gender,
    {state('c_nationkey')} AS st,
    CASE WHEN c_custkey % 13 = 4 THEN ' ' || lower({state('c_nationkey')}) ELSE {state('c_nationkey')} END AS raw_state,
    {lookup('c_mktsegment', SEGMENT_NUCC, 0)} AS nucc, {lookup('c_mktsegment', SEGMENT_NUCC, 1)} AS nucc_display
  FROM customer),
org AS (
  SELECT s_suppkey AS k, {pad('org', 's_suppkey')} AS id, s_name AS sname, s_nationkey AS nk,
    CASE WHEN s_suppkey % 30 <> 17 THEN '2' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END AS npi,
    CASE WHEN s_suppkey % 30 <> 17 AND s_suppkey % 20 = 1 THEN '3' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END AS npi2,
    CASE WHEN s_suppkey % 25 <> 4 THEN s_acctbal >= -500 END AS active,
    CASE WHEN s_nationkey % 2 = 0 THEN 'prov' ELSE 'pay' END AS type_code,
    s_name || CASE WHEN s_suppkey % 5 = 2 THEN ' Hospital' ELSE ' Clinic' END AS name,
    CASE WHEN s_suppkey % 40 = 39 THEN 'org-99999999' WHEN s_suppkey > 0 THEN {pad('org', '(s_suppkey // 3)')} END AS parent,
    {state('s_nationkey')} AS st
  FROM supplier),
loc AS (
  SELECT p_partkey AS k, {pad('loc', 'p_partkey')} AS id,
    CASE WHEN p_partkey % 12 <> 5 THEN p_partkey % 9 <> 3 END AS active,
    CASE WHEN p_partkey % 60 <> 7 THEN CASE WHEN p_partkey % 9 = 3 THEN 'suspended' ELSE 'active' END END AS status,
    CASE WHEN p_partkey % 45 <> 8 THEN p_name || ' clinic' END AS name,
    CASE WHEN p_partkey % 6 = 2 THEN p_type END AS description,
    p_partkey % 17 <> 0 AS has_address,
    CASE WHEN p_partkey % 17 <> 0 THEN (p_partkey // 2) || ' Elm Rd' END AS line1,
    CASE WHEN p_partkey % 17 <> 0 THEN CASE WHEN p_partkey % 6 = 0 THEN 'Bldg ' || (p_partkey % 5) END END AS line2,
    CASE WHEN p_partkey % 17 <> 0 THEN 'City' || (p_partkey % 25) END AS city,
    CASE WHEN p_partkey % 17 <> 0 THEN {state('p_partkey % 25')} END AS st,
    CASE WHEN p_partkey % 17 <> 0 AND p_partkey % 16 <> 3 THEN lpad(CAST(p_partkey % 25 AS VARCHAR), 5, '0') END AS postal,
    CASE WHEN p_partkey % 5 <> 0 THEN 30 + p_partkey % 20 END AS lat,
    CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 25 <> 1 THEN -70 - p_partkey % 30 END AS lon,
    {pad('org', '(p_partkey // 20)')} AS managing,
    CASE WHEN p_partkey % 10 = 1 THEN {pad('loc', '(p_partkey // 4)')} END AS parent,
    CASE WHEN p_partkey % 3 = 0 THEN {pad('end', 'p_partkey')} END AS endpoint,
    CASE WHEN p_partkey % 21 = 0 THEN 'closed on holidays' END AS exceptions
  FROM part),
ep AS (
  SELECT p_partkey AS k, {pad('end', 'p_partkey')} AS id, p_name AS name,
    CASE WHEN p_partkey % 70 = 1 THEN NULL WHEN p_partkey % 80 = 9 THEN 'bogus' WHEN p_partkey % 8 = 0 THEN 'off' ELSE 'active' END AS status,
    p_partkey % 65 <> 2 AS has_connection,
    CASE WHEN p_partkey % 65 <> 2 THEN CASE WHEN p_partkey % 5 = 0 THEN 'direct-project' WHEN p_partkey % 50 <> 1 THEN 'hl7-fhir-rest' END END AS code,
    CASE WHEN p_partkey % 65 <> 2 AND p_partkey % 100 <> 51 THEN 'Connection' END AS display,
    CASE WHEN p_partkey % 60 = 0 THEN NULL
      WHEN p_partkey % 5 = 0 THEN 'e' || p_partkey || '@direct.net'
      WHEN p_partkey % 10 = 1 THEN 'http://h' || p_partkey || '.org/fhir'
      WHEN p_partkey % 100 = 2 THEN 'https://example.com/fhir'
      WHEN p_partkey % 90 = 3 THEN 'not a url'
      ELSE 'https://h' || (p_partkey // 2) || '.org/fhir' END AS address,
    CASE WHEN p_partkey % 4 <> 1 THEN {pad('org', '(p_partkey // 20)')} END AS managing,
    CASE WHEN p_partkey % 6 <> 5 THEN p_partkey % 3 + 1 END AS rank
  FROM part),
role AS (
  SELECT o_orderkey AS k, {pad('role', 'o_orderkey')} AS id,
    CASE WHEN o_orderkey % 60 <> 13 THEN o_orderstatus <> 'F' END AS active,
    CASE WHEN o_orderkey % 200 = 7 THEN 'prac-99999999' WHEN o_orderkey % 500 <> 9 THEN {pad('prac', 'o_custkey')} END AS prac_id,
    CASE WHEN o_orderkey % 400 = 17 THEN 'org-99999999' WHEN o_orderkey % 3 = 0 THEN 'org-00000000'
         ELSE {pad('org', '(o_orderkey // 150)')} END AS org_id,
    CASE WHEN o_orderkey % 250 <> 19 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'doctor' ELSE 'nurse' END END AS code,
    {pad('loc', '(o_orderkey // 10)')} AS loc1,
    CASE WHEN o_orderkey % 4 = 0 THEN {pad('loc', '(o_orderkey // 8)')} END AS loc2,
    CASE WHEN o_orderkey % 30 = 0 THEN 'hs-' || (o_orderkey % 40) END AS hs,
    CASE WHEN o_orderkey % 300 = 11 THEN 'end-99999999' WHEN o_orderkey % 2 = 0 THEN {pad('end', '(o_orderkey // 8)')} END AS end_id,
    {lookup('o_orderpriority', PRIORITY_NUCC, 0)} AS nucc, {lookup('o_orderpriority', PRIORITY_NUCC, 1)} AS nucc_display
  FROM orders),
aff AS (
  SELECT c_custkey AS k, {pad('aff', 'c_custkey')} AS id, c_custkey % 10 <> 3 AS active,
    CASE WHEN c_custkey % 150 <> 77 THEN {pad('org', '(c_custkey // 15)')} END AS org_id,
    CASE WHEN c_custkey % 100 = 41 THEN 'org-99999999' ELSE {pad('org', '(c_custkey // 30)')} END AS part_id,
    c_custkey % 120 <> 31 AS has_code,
    CASE WHEN c_custkey % 4 = 0 THEN {pad('loc', 'c_custkey')} END AS loc_id,
    CASE WHEN c_custkey % 6 = 0 THEN {pad('end', 'c_custkey')} END AS end_id,
    {lookup('c_mktsegment', SEGMENT_NUCC, 0)} AS nucc
  FROM customer),
counts AS (
  SELECT 'Practitioner' AS resource_type, count(*) AS n FROM prac UNION ALL
  SELECT 'Organization', count(*) FROM org UNION ALL SELECT 'Location', count(*) FROM loc UNION ALL
  SELECT 'Endpoint', count(*) FROM ep UNION ALL SELECT 'PractitionerRole', count(*) FROM role UNION ALL
  SELECT 'OrganizationAffiliation', count(*) FROM aff),
raw_edges AS (
  SELECT 'Practitioner/' || prac_id AS src, 'HAS_ROLE' AS rel, 'PractitionerRole/' || id AS dst, CAST(NULL AS BIGINT) AS rank FROM role WHERE prac_id IS NOT NULL
  UNION ALL SELECT 'PractitionerRole/' || id, 'WORKS_AT', 'Organization/' || org_id, NULL FROM role
  UNION ALL SELECT 'PractitionerRole/' || id, 'AT_LOCATION', 'Location/' || loc1, NULL FROM role
  UNION ALL SELECT 'PractitionerRole/' || id, 'AT_LOCATION', 'Location/' || loc2, NULL FROM role WHERE loc2 IS NOT NULL
  UNION ALL SELECT 'PractitionerRole/' || id, 'HAS_ENDPOINT', 'Endpoint/' || end_id, NULL FROM role WHERE end_id IS NOT NULL
  UNION ALL SELECT 'Organization/' || org_id, 'HAS_AFFILIATION', 'OrganizationAffiliation/' || id, NULL FROM aff WHERE org_id IS NOT NULL
  UNION ALL SELECT 'OrganizationAffiliation/' || id, 'AFFILIATED_WITH', 'Organization/' || part_id, NULL FROM aff
  UNION ALL SELECT 'OrganizationAffiliation/' || id, 'AT_LOCATION', 'Location/' || loc_id, NULL FROM aff WHERE loc_id IS NOT NULL
  UNION ALL SELECT 'OrganizationAffiliation/' || id, 'HAS_ENDPOINT', 'Endpoint/' || end_id, NULL FROM aff WHERE end_id IS NOT NULL
  UNION ALL SELECT 'Organization/' || managing, 'MANAGES', 'Location/' || id, NULL FROM loc
  UNION ALL SELECT 'Location/' || id, 'PART_OF', 'Location/' || parent, NULL FROM loc WHERE parent IS NOT NULL
  UNION ALL SELECT 'Location/' || id, 'HAS_ENDPOINT', 'Endpoint/' || endpoint, NULL FROM loc WHERE endpoint IS NOT NULL
  UNION ALL SELECT 'Organization/' || id, 'PART_OF', 'Organization/' || parent, NULL FROM org WHERE parent IS NOT NULL
  UNION ALL SELECT 'Organization/' || id, 'HAS_ENDPOINT', 'Endpoint/' || {pad('end', 'k')}, NULL FROM org WHERE k % 2 = 0
  UNION ALL SELECT 'Organization/' || id, 'HAS_ENDPOINT', 'Endpoint/' || {pad('end', '(k * 10)')}, NULL FROM org WHERE k % 4 = 0
  UNION ALL SELECT 'Organization/' || managing, 'MANAGES', 'Endpoint/' || id, NULL FROM ep WHERE managing IS NOT NULL
  UNION ALL SELECT 'Practitioner/' || id, 'HAS_ENDPOINT', 'Endpoint/' || {pad('end', '(k // 3)')}, k % 3 + 1 FROM prac WHERE k % 10 <> 9),
nodes AS (
  SELECT 'Practitioner/' || id AS node FROM prac UNION ALL SELECT 'Organization/' || id FROM org UNION ALL
  SELECT 'Location/' || id FROM loc UNION ALL SELECT 'Endpoint/' || id FROM ep UNION ALL
  SELECT 'PractitionerRole/' || id FROM role UNION ALL SELECT 'OrganizationAffiliation/' || id FROM aff),
edges AS (
  SELECT src, rel, dst, max(rank) AS rank FROM raw_edges
  WHERE src IN (SELECT node FROM nodes) AND dst IN (SELECT node FROM nodes) GROUP BY ALL)
"""
