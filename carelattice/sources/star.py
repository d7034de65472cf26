"""Star tables as resource lines: each row becomes one JSON text by fixed rules on its keys.

Used by the registered queries, the benchmark and the tests. A third of all roles point at one
organization, so every job that runs on these lines meets a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from carelattice.constants import (
    ACCESSIBILITY_URLS,
    ALIAS_TYPE_URLS,
    BOUNDARY_URLS,
    CMS_ENROLLED_URLS,
    CMS_NETWORK_URLS,
    CONNECTION_TYPE_SYSTEM,
    DEGREE_SYSTEM,
    DESCRIPTION_URLS,
    ENDPOINT_REFERENCE_URLS,
    LOGO_URLS,
    NPI_SYSTEM,
    NUCC_SYSTEM,
    ORG_PECOS_URLS,
    ORG_RATING_URLS,
    ORG_TYPE_SYSTEM,
    PROFICIENCY_URLS,
    RACE_URLS,
    RANK_URLS,
    ROLE_PECOS_URLS,
)
from carelattice.runtime import listing, new_shared_path

# fixed values: state of each nation key 0..24; the last one is no state
STATES = (
    "CA", "TX", "FL", "NY", "PA", "WY", "RI", "WA", "OR", "NV", "AZ", "CO", "UT",
    "ID", "MT", "NM", "KS", "NE", "IA", "MO", "AR", "LA", "MS", "PR", "XX",
)
# fixed values: taxonomy code and label of each order priority and market segment
PRIORITY_NUCC = {
    "1-URGENT": ("207Q00000X", "Family Medicine"),
    "2-HIGH": ("207R00000X", "Internal Medicine"),
    "3-MEDIUM": ("363A00000X", "Physician Assistant"),
    "4-NOT SPECIFIED": ("208M00000X", "Hospitalist"),
    "5-LOW": ("208600000X", "Surgery"),
}
SEGMENT_NUCC = {
    "AUTOMOBILE": ("207Q00000X", "Family Medicine"),
    "BUILDING": ("207R00000X", "Internal Medicine"),
    "FURNITURE": ("363A00000X", "Physician Assistant"),
    "HOUSEHOLD": ("208M00000X", "Hospitalist"),
    "MACHINERY": ("208600000X", "Surgery"),
}
NEW_PATIENTS_URL = "http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-newpatients"
ROLE_RATING_URL = "http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-rating"


def _lookup(column: str, table: dict, part: int) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v[part]}'" for k, v in table.items())
    return f"CASE {column} {whens} END"


def _state(key: str) -> str:
    codes = ", ".join(f"'{s}'" for s in STATES)
    return f"element_at(array({codes}), CAST({key} AS INT) + 1)"


def _ref(rtype: str, prefix: str, key: str) -> str:
    return f"named_struct('reference', '{rtype}/{prefix}-' || lpad(CAST({key} AS STRING), 8, '0'))"


def _present(*items: str) -> str:
    """Array of the items that are not NULL, itself NULL when none is."""
    kept = f"filter(array({', '.join(items)}), x -> x IS NOT NULL)"
    return f"nullif({kept}, filter(array({', '.join(items)}), x -> false))"


def _address(line1: str, line2: str, line3: str, city: str, state: str, postal: str) -> str:
    return (
        f"named_struct('line', filter(array({line1}, {line2}, {line3}), x -> x IS NOT NULL), "
        f"'city', {city}, 'state', {state}, 'postalCode', {postal}, 'country', 'US', "
        "'type', 'physical', 'use', 'work')"
    )


def _concept(system: str, code: str, display: str, text: str = "CAST(NULL AS STRING)") -> str:
    return (
        f"named_struct('coding', array(named_struct('system', {system}, 'code', {code}, "
        f"'display', {display})), 'text', {text})"
    )


PRACTITIONER_STATE = (
    "CASE WHEN c_custkey % 13 = 4 THEN ' ' || lower(" + _state("c_nationkey") + ") "
    "ELSE " + _state("c_nationkey") + " END"
)

PRACTITIONER = f"""to_json(named_struct(
 'resourceType', 'Practitioner',
 'id', 'prac-' || lpad(CAST(c_custkey AS STRING), 8, '0'),
 'meta', named_struct('lastUpdated', '2024-01-01T00:00:00Z'),
 'identifier', {_present(
    "CASE WHEN c_custkey % 6 = 1 THEN named_struct('system', 'http://example.org/license', 'value', 'L' || c_custkey) END",
    f"CASE WHEN c_custkey % 50 <> 0 THEN named_struct('system', '{NPI_SYSTEM}', 'value', '1' || lpad(CAST(c_custkey AS STRING), 9, '0')) END")},
 'active', CASE WHEN c_custkey % 30 <> 0 THEN c_acctbal >= 0 END,
 'name', filter(array(
    named_struct('use', 'official',
      'family', CASE WHEN c_custkey % 40 = 3 THEN 'Test' WHEN c_custkey % 90 = 5 THEN 'O''Brien 2'
                     WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE initcap(c_mktsegment) END,
      'given', CASE WHEN c_custkey % 25 = 7 THEN array()
                    WHEN c_custkey % 35 = 9 THEN array('J')
                    ELSE array(initcap(c_mktsegment), 'Q', 'X') END,
      'prefix', CASE WHEN c_custkey % 4 = 0 THEN array('Dr', 'Prof') END,
      'suffix', CASE WHEN c_custkey % 12 = 0 THEN array('Jr') END),
    CASE WHEN c_custkey % 5 = 0 THEN named_struct('use', 'nickname', 'family', 'Alias' || (c_custkey % 7),
      'given', array('Al'), 'prefix', CAST(NULL AS ARRAY<STRING>), 'suffix', CAST(NULL AS ARRAY<STRING>)) END,
    CASE WHEN c_custkey % 15 = 0 THEN named_struct('use', 'old', 'family', 'Former',
      'given', array('Fo'), 'prefix', CAST(NULL AS ARRAY<STRING>), 'suffix', CAST(NULL AS ARRAY<STRING>)) END),
    x -> x IS NOT NULL),
 'gender', CASE WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 20 <= 9 THEN 'male'
                WHEN c_custkey % 20 <= 18 THEN 'female' ELSE 'other' END,
 'telecom', filter(array(
    named_struct('system', 'phone', 'value', '555-' || lpad(CAST(c_custkey DIV 3 AS STRING), 7, '0')),
    CASE WHEN c_custkey % 3 = 0 THEN named_struct('system', 'email', 'value', 'p' || c_custkey || '@clinic.org') END,
    CASE WHEN c_custkey % 4 = 1 THEN named_struct('system', 'fax', 'value', '556-' || lpad(CAST(c_custkey AS STRING), 7, '0')) END),
    x -> x IS NOT NULL),
 'address', array({_address("(c_custkey DIV 2) || ' Main St'", "'Suite ' || (c_nationkey)", "CASE WHEN c_custkey % 8 = 0 THEN 'Floor 2' END", "'City' || c_nationkey", PRACTITIONER_STATE, "lpad(CAST(c_nationkey AS STRING), 5, '0')")}),
 'communication', CASE WHEN c_custkey % 7 = 0 THEN filter(array(
    named_struct('language', {_concept("'urn:ietf:bcp:47'", "'es'", "'Spanish'")},
       'coding', array(named_struct('code', 'es', 'display', 'Spanish')),
       'extension', array(named_struct('url', '{PROFICIENCY_URLS[0]}', 'valueCode', 'fluent'))),
    CASE WHEN c_custkey % 14 = 0 THEN named_struct('language', {_concept("'urn:ietf:bcp:47'", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)", "'English'")},
       'coding', array(named_struct('code', 'en', 'display', 'English')),
       'extension', CAST(NULL AS ARRAY<STRUCT<url:STRING,valueCode:STRING>>)) END), x -> x IS NOT NULL) END,
 'qualification', {_present(
    f"CASE WHEN c_custkey % 3 <> 1 THEN named_struct('code', {_concept(repr(NUCC_SYSTEM), _lookup('c_mktsegment', SEGMENT_NUCC, 0), _lookup('c_mktsegment', SEGMENT_NUCC, 1))}, 'identifier', array(named_struct('value', 'LIC' || c_custkey, 'type', {_concept('CAST(NULL AS STRING)', repr('MD'), 'CAST(NULL AS STRING)')})), 'issuer', named_struct('reference', 'Organization/Organization-State-' || {_state('c_nationkey')})) END",
    f"CASE WHEN c_custkey % 2 = 0 THEN named_struct('code', {_concept(repr(DEGREE_SYSTEM), repr('MD'), repr('Doctor of Medicine'), repr('MD'))}, 'identifier', CAST(NULL AS ARRAY<STRUCT<value:STRING,type:STRUCT<coding:ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>,text:STRING>>>), 'issuer', CAST(NULL AS STRUCT<reference:STRING>)) END")},
 'specialty', filter(array(
    {_concept(repr(NUCC_SYSTEM), _lookup('c_mktsegment', SEGMENT_NUCC, 0), _lookup('c_mktsegment', SEGMENT_NUCC, 1))},
    CASE WHEN c_custkey % 9 = 0 THEN {_concept(repr(NUCC_SYSTEM), "CAST(NULL AS STRING)", "'uncoded'")} END),
    x -> x IS NOT NULL),
 'extension', {_present(
    f"CASE WHEN c_custkey % 10 <> 9 THEN named_struct('url', '{ENDPOINT_REFERENCE_URLS[0]}', 'valueBoolean', CAST(NULL AS BOOLEAN), 'valueReference', {_ref('Endpoint', 'end', '(c_custkey DIV 3)')}, 'extension', array(named_struct('url', 'rank', 'valuePositiveInt', c_custkey % 3 + 1, 'valueReference', CAST(NULL AS STRUCT<reference:STRING>), 'valueCoding', CAST(NULL AS STRUCT<code:STRING>), 'valueString', CAST(NULL AS STRING)))) END",
    f"CASE WHEN c_custkey % 11 < 8 THEN named_struct('url', '{CMS_ENROLLED_URLS[0]}', 'valueBoolean', c_custkey % 2 = 0, 'valueReference', CAST(NULL AS STRUCT<reference:STRING>), 'extension', CAST(NULL AS ARRAY<STRUCT<url:STRING,valuePositiveInt:BIGINT,valueReference:STRUCT<reference:STRING>,valueCoding:STRUCT<code:STRING>,valueString:STRING>>)) END",
    f"CASE WHEN c_custkey % 17 = 0 THEN named_struct('url', '{CMS_NETWORK_URLS[0]}', 'valueBoolean', true, 'valueReference', CAST(NULL AS STRUCT<reference:STRING>), 'extension', CAST(NULL AS ARRAY<STRUCT<url:STRING,valuePositiveInt:BIGINT,valueReference:STRUCT<reference:STRING>,valueCoding:STRUCT<code:STRING>,valueString:STRING>>)) END",
    f"CASE WHEN c_custkey % 10 = 0 THEN named_struct('url', '{RACE_URLS[0]}', 'valueBoolean', CAST(NULL AS BOOLEAN), 'valueReference', CAST(NULL AS STRUCT<reference:STRING>), 'extension', array(named_struct('url', CASE WHEN c_custkey % 20 = 0 THEN 'ombCategory' ELSE 'text' END, 'valuePositiveInt', CAST(NULL AS BIGINT), 'valueReference', CAST(NULL AS STRUCT<reference:STRING>), 'valueCoding', CASE WHEN c_custkey % 20 = 0 THEN named_struct('code', '2106-3') END, 'valueString', CASE WHEN c_custkey % 20 <> 0 THEN 'Mixed' END))) END")}
))"""

ORGANIZATION = f"""to_json(named_struct(
 'resourceType', 'Organization',
 'id', 'org-' || lpad(CAST(s_suppkey AS STRING), 8, '0'),
 'meta', named_struct('lastUpdated', '2024-01-01T00:00:00Z'),
 'identifier', CASE WHEN s_suppkey % 30 <> 17 THEN filter(array(
    named_struct('system', '{NPI_SYSTEM}', 'value', '2' || lpad(CAST(s_suppkey AS STRING), 9, '0')),
    CASE WHEN s_suppkey % 20 = 1 THEN named_struct('system', '{NPI_SYSTEM}', 'value', '3' || lpad(CAST(s_suppkey AS STRING), 9, '0')) END),
    x -> x IS NOT NULL) END,
 'active', CASE WHEN s_suppkey % 25 <> 4 THEN s_acctbal >= -500 END,
 'type', array({_concept(repr(ORG_TYPE_SYSTEM), "CASE WHEN s_nationkey % 2 = 0 THEN 'prov' ELSE 'pay' END", "CASE WHEN s_nationkey % 2 = 0 THEN 'Healthcare Provider' ELSE 'Payer' END")}),
 'name', s_name || CASE WHEN s_suppkey % 5 = 2 THEN ' Hospital' ELSE ' Clinic' END,
 'alias', CASE WHEN s_suppkey % 6 = 0 THEN array('Alias A' || s_suppkey, 'Alias B') END,
 '_alias', CASE WHEN s_suppkey % 6 = 0 THEN array(named_struct('extension', array(named_struct('url', '{ALIAS_TYPE_URLS[0]}', 'valueCode', 'doing-business-as')))) END,
 'description', CASE WHEN s_suppkey % 3 = 0 THEN 'About ' || s_name END,
 'telecom', {_present(
    "CASE WHEN s_suppkey % 4 IN (0, 2) THEN named_struct('system', 'phone', 'value', '700-' || lpad(CAST(s_suppkey DIV 2 AS STRING), 7, '0')) END",
    "CASE WHEN s_suppkey % 4 = 1 THEN named_struct('system', 'fax', 'value', '701-' || lpad(CAST(s_suppkey AS STRING), 7, '0')) END",
    "CASE WHEN s_suppkey % 4 = 2 THEN named_struct('system', 'email', 'value', 'o' || s_suppkey || '@clinic.org') END")},
 'address', transform(sequence(0, CAST(s_suppkey % 3 AS INT)), i -> {_address("(s_suppkey + i) || ' Oak Ave'", "CASE WHEN i = 1 THEN 'Unit 1' END", "CASE WHEN i = 1 AND s_suppkey % 2 = 0 THEN 'Rear' END", "'City' || s_nationkey", _state("s_nationkey"), "CASE WHEN s_suppkey % 10 <> 4 THEN lpad(CAST(s_nationkey AS STRING), 5, '0') END")}),
 'partOf', CASE WHEN s_suppkey % 40 = 39 THEN named_struct('reference', 'Organization/org-99999999')
                WHEN s_suppkey > 0 THEN {_ref("Organization", "org", "(s_suppkey DIV 3)")} END,
 'contact', CASE WHEN s_suppkey % 5 = 0 THEN filter(array(
    named_struct('name', named_struct('family', 'Contact' || s_suppkey, 'given', array('Em')),
      'telecom', array(named_struct('system', 'phone', 'value', '703-' || s_suppkey), named_struct('system', 'email', 'value', 'c@clinic.org')),
      'address', {_address("'C1'", "'C2'", "'C3'", "'Y'", "'NY'", "'10001'")}),
    CASE WHEN s_suppkey % 10 = 0 THEN named_struct('name', named_struct('family', 'Second', 'given', array('Bo')),
      'telecom', array(named_struct('system', 'phone', 'value', '704-' || s_suppkey)),
      'address', {_address("'D1'", "CAST(NULL AS STRING)", "CAST(NULL AS STRING)", "'Z'", "'NY'", "'10001'")}) END),
    x -> x IS NOT NULL) END,
 'endpoint', CASE WHEN s_suppkey % 2 = 0 THEN filter(array({_ref("Endpoint", "end", "s_suppkey")}, CASE WHEN s_suppkey % 4 = 0 THEN {_ref("Endpoint", "end", "(s_suppkey * 10)")} END), x -> x IS NOT NULL) END,
 'location', CASE WHEN s_suppkey % 9 = 2 THEN array({_ref("Location", "loc", "(s_suppkey * 5)")}) END,
 'extension', {_present(
    f"CASE WHEN s_suppkey % 3 = 0 THEN named_struct('url', '{DESCRIPTION_URLS[0]}', 'valueString', 'Desc ' || s_suppkey, 'valueBoolean', CAST(NULL AS BOOLEAN), 'valueInteger', CAST(NULL AS BIGINT), 'valueUrl', CAST(NULL AS STRING)) END",
    f"CASE WHEN s_suppkey % 4 = 0 THEN named_struct('url', '{LOGO_URLS[0]}', 'valueString', CAST(NULL AS STRING), 'valueBoolean', CAST(NULL AS BOOLEAN), 'valueInteger', CAST(NULL AS BIGINT), 'valueUrl', 'https://logo.org/' || s_suppkey) END",
    f"CASE WHEN s_suppkey % 5 < 3 THEN named_struct('url', '{ORG_RATING_URLS[0]}', 'valueString', CASE WHEN s_suppkey % 5 = 1 THEN CAST(s_suppkey % 6 AS STRING) WHEN s_suppkey % 5 = 2 THEN 'good' END, 'valueBoolean', CAST(NULL AS BOOLEAN), 'valueInteger', CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey % 6 END, 'valueUrl', CAST(NULL AS STRING)) END",
    f"CASE WHEN s_suppkey % 7 = 0 THEN named_struct('url', '{ORG_PECOS_URLS[0]}', 'valueString', CAST(NULL AS STRING), 'valueBoolean', true, 'valueInteger', CAST(NULL AS BIGINT), 'valueUrl', CAST(NULL AS STRING)) END")}
))"""

LOCATION_ADDRESS = _address(
    "(p_partkey DIV 2) || ' Elm Rd'", "CASE WHEN p_partkey % 6 = 0 THEN 'Bldg ' || (p_partkey % 5) END",
    "CASE WHEN p_partkey % 12 = 0 THEN 'Dock' END",
    "'City' || (p_partkey % 25)", _state("p_partkey % 25"),
    "CASE WHEN p_partkey % 16 <> 3 THEN lpad(CAST(p_partkey % 25 AS STRING), 5, '0') END",
)
_LOCATION_TAIL = f"""
 'position', CASE WHEN p_partkey % 5 <> 0 THEN named_struct('latitude', 30 + p_partkey % 20,
    'longitude', CASE WHEN p_partkey % 25 <> 1 THEN -70 - p_partkey % 30 END) END,
 'managingOrganization', {_ref("Organization", "org", "(p_partkey DIV 20)")},
 'partOf', CASE WHEN p_partkey % 10 = 1 THEN {_ref("Location", "loc", "(p_partkey DIV 4)")} END,
 'endpoint', CASE WHEN p_partkey % 3 = 0 THEN array({_ref("Endpoint", "end", "p_partkey")}) END,
 'hoursOfOperation', CASE WHEN p_partkey % 4 = 0 THEN array(named_struct('allDay', p_partkey % 8 = 0, 'openingTime', '08:00:00', 'closingTime', '17:00:00')) END,
 'availabilityExceptions', CASE WHEN p_partkey % 21 = 0 THEN 'closed on holidays' END,
 'extension', {_present(
    f"CASE WHEN p_partkey % 7 = 0 THEN named_struct('url', '{BOUNDARY_URLS[0]}', 'valueAttachment', named_struct('data', CASE WHEN p_partkey % 14 = 0 THEN base64(CAST('geo-' || p_partkey AS BINARY)) END, 'url', CASE WHEN p_partkey % 14 <> 0 THEN 'https://geo.org/' || p_partkey END), 'valueCodeableConcept', CAST(NULL AS STRUCT<coding:ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>,text:STRING>)) END",
    f"CASE WHEN p_partkey % 9 = 0 THEN named_struct('url', '{ACCESSIBILITY_URLS[0]}', 'valueAttachment', CAST(NULL AS STRUCT<data:STRING,url:STRING>), 'valueCodeableConcept', {_concept(repr('urn:access'), 'CASE WHEN p_partkey % 27 <> 0 THEN ' + repr('wheel') + ' END', 'CAST(NULL AS STRING)')}) END")}
))"""
_LOCATION_HEAD = """to_json(named_struct(
 'resourceType', 'Location',
 'id', 'loc-' || lpad(CAST(p_partkey AS STRING), 8, '0'),
 'meta', named_struct('lastUpdated', '2024-01-01T00:00:00Z'),
 'active', CASE WHEN p_partkey % 12 <> 5 THEN p_partkey % 9 <> 3 END,
 'status', CASE WHEN p_partkey % 60 <> 7 THEN CASE WHEN p_partkey % 9 = 3 THEN 'suspended' ELSE 'active' END END,
 'name', CASE WHEN p_partkey % 45 <> 8 THEN p_name || ' clinic' END,
 'description', CASE WHEN p_partkey % 6 = 2 THEN p_type END,
 'mode', 'instance',
 'telecom', filter(array(
    named_struct('system', 'phone', 'value', '800-' || lpad(CAST(p_partkey DIV 4 AS STRING), 7, '0')),
    CASE WHEN p_partkey % 5 = 1 THEN named_struct('system', 'email', 'value', 'l@clinic.org') END), x -> x IS NOT NULL),
 'address', """
LOCATION = (
    "CASE WHEN p_partkey % 17 = 0 THEN "
    + _LOCATION_HEAD + "CAST(NULL AS STRING)," + _LOCATION_TAIL
    + " WHEN p_partkey % 2 = 0 THEN "
    + _LOCATION_HEAD + LOCATION_ADDRESS + "," + _LOCATION_TAIL
    + " ELSE "
    + _LOCATION_HEAD + f"array({LOCATION_ADDRESS})," + _LOCATION_TAIL
    + " END"
)

_CONNECTION_CODE = "CASE WHEN p_partkey % 5 = 0 THEN 'direct-project' WHEN p_partkey % 50 <> 1 THEN 'hl7-fhir-rest' END"
ENDPOINT = f"""to_json(named_struct(
 'resourceType', 'Endpoint',
 'id', 'end-' || lpad(CAST(p_partkey AS STRING), 8, '0'),
 'meta', named_struct('lastUpdated', '2024-01-01T00:00:00Z'),
 'status', CASE WHEN p_partkey % 70 = 1 THEN NULL WHEN p_partkey % 80 = 9 THEN 'bogus' WHEN p_partkey % 8 = 0 THEN 'off' ELSE 'active' END,
 'connectionType', CASE WHEN p_partkey % 65 <> 2 THEN named_struct('system', '{CONNECTION_TYPE_SYSTEM}', 'code', {_CONNECTION_CODE},
    'display', CASE WHEN p_partkey % 100 <> 51 THEN 'Connection' END,
    'coding', array(named_struct('system', '{CONNECTION_TYPE_SYSTEM}', 'code', {_CONNECTION_CODE}))) END,
 'name', p_name,
 'address', CASE WHEN p_partkey % 60 = 0 THEN NULL
   WHEN p_partkey % 5 = 0 THEN 'e' || p_partkey || '@direct.net'
   WHEN p_partkey % 10 = 1 THEN 'http://h' || p_partkey || '.org/fhir'
   WHEN p_partkey % 100 = 2 THEN 'https://example.com/fhir'
   WHEN p_partkey % 90 = 3 THEN 'not a url'
   ELSE 'https://h' || (p_partkey DIV 2) || '.org/fhir' END,
 'payloadType', {_present(
    f"CASE WHEN p_partkey % 4 <> 3 THEN {_concept(repr('urn:payload'), repr('any'), repr('Any'))} END",
    "CASE WHEN p_partkey % 3 = 0 THEN named_struct('coding', CAST(NULL AS ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>), 'text', 'text-only') END",
    "CASE WHEN p_partkey % 11 = 0 THEN named_struct('coding', CAST(NULL AS ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>), 'text', CAST(NULL AS STRING)) END")},
 'managingOrganization', CASE WHEN p_partkey % 4 <> 1 THEN {_ref("Organization", "org", "(p_partkey DIV 20)")} END,
 'extension', CASE WHEN p_partkey % 6 <> 5 THEN array(named_struct('url', '{RANK_URLS[0]}',
    'valuePositiveInt', CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 3 + 1 END,
    'valueInteger', CASE WHEN p_partkey % 2 = 1 THEN p_partkey % 3 + 1 END)) END
))"""

ROLE = f"""to_json(named_struct(
 'resourceType', 'PractitionerRole',
 'id', 'role-' || lpad(CAST(o_orderkey AS STRING), 8, '0'),
 'meta', named_struct('lastUpdated', '2024-01-01T00:00:00Z'),
 'active', CASE WHEN o_orderkey % 60 <> 13 THEN o_orderstatus <> 'F' END,
 'practitioner', CASE WHEN o_orderkey % 200 = 7 THEN named_struct('reference', 'Practitioner/prac-99999999')
                      WHEN o_orderkey % 500 <> 9 THEN {_ref("Practitioner", "prac", "o_custkey")} END,
 'organization', CASE WHEN o_orderkey % 400 = 17 THEN named_struct('reference', 'Organization/org-99999999')
                      WHEN o_orderkey % 3 = 0 THEN {_ref("Organization", "org", "0")}
                      ELSE {_ref("Organization", "org", "(o_orderkey DIV 150)")} END,
 'code', CASE WHEN o_orderkey % 250 <> 19 THEN filter(array(
    {_concept("'urn:role'", "CASE WHEN o_orderkey % 2 = 0 THEN 'doctor' ELSE 'nurse' END", "CASE WHEN o_orderkey % 2 = 0 THEN 'Doctor' ELSE 'Nurse' END")},
    CASE WHEN o_orderkey % 50 = 0 THEN {_concept("'urn:role'", "'ict'", "'ICT'")} END), x -> x IS NOT NULL) END,
 'specialty', filter(array(
    {_concept(repr(NUCC_SYSTEM), _lookup('o_orderpriority', PRIORITY_NUCC, 0), _lookup('o_orderpriority', PRIORITY_NUCC, 1))},
    CASE WHEN o_orderkey % 6 = 0 THEN named_struct('coding', CAST(NULL AS ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>), 'text', 'general') END,
    CASE WHEN o_orderkey % 12 = 0 THEN named_struct('coding', CAST(NULL AS ARRAY<STRUCT<system:STRING,code:STRING,display:STRING>>), 'text', CAST(NULL AS STRING)) END),
    x -> x IS NOT NULL),
 'location', filter(array({_ref("Location", "loc", "(o_orderkey DIV 10)")},
    CASE WHEN o_orderkey % 4 = 0 THEN {_ref("Location", "loc", "(o_orderkey DIV 8)")} END), x -> x IS NOT NULL),
 'healthcareService', CASE WHEN o_orderkey % 30 = 0 THEN array(named_struct('reference', 'HealthcareService/hs-' || (o_orderkey % 40))) END,
 'endpoint', filter(array(CASE WHEN o_orderkey % 300 = 11 THEN named_struct('reference', 'Endpoint/end-99999999')
                  WHEN o_orderkey % 2 = 0 THEN {_ref("Endpoint", "end", "(o_orderkey DIV 8)")} END), x -> x IS NOT NULL),
 'telecom', filter(array(
    named_struct('system', 'phone', 'value', '900-' || lpad(CAST(o_orderkey DIV 5 AS STRING), 7, '0')),
    CASE WHEN o_orderkey % 8 = 1 THEN named_struct('system', 'email', 'value', 'r@clinic.org') END), x -> x IS NOT NULL),
 'extension', {_present(
    f"CASE WHEN o_orderkey % 5 <> 4 THEN named_struct('url', '{NEW_PATIENTS_URL}', 'valueBoolean', o_orderkey % 5 < 2, 'valueInteger', CAST(NULL AS BIGINT)) END",
    f"CASE WHEN o_orderkey % 7 = 0 THEN named_struct('url', '{ROLE_RATING_URL}', 'valueBoolean', CAST(NULL AS BOOLEAN), 'valueInteger', o_orderkey % 6) END",
    f"CASE WHEN o_orderkey % 9 = 0 THEN named_struct('url', '{ROLE_PECOS_URLS[0]}', 'valueBoolean', true, 'valueInteger', CAST(NULL AS BIGINT)) END")}
))"""

AFFILIATION = f"""to_json(named_struct(
 'resourceType', 'OrganizationAffiliation',
 'id', 'aff-' || lpad(CAST(c_custkey AS STRING), 8, '0'),
 'meta', named_struct('lastUpdated', '2024-01-01T00:00:00Z'),
 'active', c_custkey % 10 <> 3,
 'organization', CASE WHEN c_custkey % 150 <> 77 THEN {_ref("Organization", "org", "(c_custkey DIV 15)")} END,
 'participatingOrganization', CASE WHEN c_custkey % 100 = 41 THEN named_struct('reference', 'Organization/org-99999999')
                                   ELSE {_ref("Organization", "org", "(c_custkey DIV 30)")} END,
 'code', CASE WHEN c_custkey % 120 <> 31 THEN array({_concept("'urn:affiliation'", "CASE WHEN c_custkey % 3 = 0 THEN 'member' END", "CASE WHEN c_custkey % 3 = 0 THEN 'Member' END", "CASE WHEN c_custkey % 3 <> 0 THEN 'partner' END")}) END,
 'specialty', array({_concept(repr(NUCC_SYSTEM), _lookup('c_mktsegment', SEGMENT_NUCC, 0), _lookup('c_mktsegment', SEGMENT_NUCC, 1))}),
 'location', CASE WHEN c_custkey % 4 = 0 THEN array({_ref("Location", "loc", "c_custkey")}) END,
 'endpoint', CASE WHEN c_custkey % 6 = 0 THEN array({_ref("Endpoint", "end", "c_custkey")}) END,
 'telecom', array(named_struct('system', CASE WHEN c_custkey % 2 = 0 THEN 'phone' ELSE 'url' END, 'value', '910-' || c_custkey))
))"""

# resource type -> (star table, key column, id prefix, JSON expression)
RULES = {
    "Practitioner": ("customer", "c_custkey", "prac", PRACTITIONER),
    "Organization": ("supplier", "s_suppkey", "org", ORGANIZATION),
    "Location": ("part", "p_partkey", "loc", LOCATION),
    "Endpoint": ("part", "p_partkey", "end", ENDPOINT),
    "PractitionerRole": ("orders", "o_orderkey", "role", ROLE),
    "OrganizationAffiliation": ("customer", "c_custkey", "aff", AFFILIATION),
}


_AT_REST: dict[tuple[str, str, str], str] = {}


def spread(df: DataFrame) -> DataFrame:
    """A table in fewer pieces than there are cores is spread over all of them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def generate(spark: SparkSession, sf_dir: str, resource_type: str) -> DataFrame:
    """Bronze rows ``(resource_type, id, value)`` of one type, straight from the star table."""
    table, key, prefix, expression = RULES[resource_type]
    rows = spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return rows.selectExpr(
        f"'{resource_type}' AS resource_type",
        f"'{prefix}-' || lpad(CAST({key} AS STRING), 8, '0') AS id",
        f"{expression} AS value",
    )


def _bronze_root(spark: SparkSession, sf_dir: str, types: Iterable[str]) -> str:
    """Bronze table of a star folder, one partition folder per type; types are added on first use."""
    app = f"{spark.sparkContext.applicationId} {listing(spark, sf_dir)}"
    root = _AT_REST.setdefault((app, sf_dir, ""), new_shared_path(spark, "bronze"))
    for rtype in types:
        if (app, sf_dir, rtype) not in _AT_REST:
            path = f"{root}/resource_type={rtype}"
            generate(spark, sf_dir, rtype).drop("resource_type").write.parquet(path)
            _AT_REST[(app, sf_dir, rtype)] = path
    return root


def star_bronze(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """Bronze rows ``(resource_type, id, value)`` of some or all types, in one scan."""
    wanted = types or tuple(RULES)
    root = _bronze_root(spark, sf_dir, wanted)
    paths = [f"{root}/resource_type={t}" for t in wanted]
    return spark.read.option("basePath", root).parquet(*paths).select("resource_type", "id", "value")


def star_resources(spark: SparkSession, sf_dir: str, resource_type: str) -> DataFrame:
    return star_bronze(spark, sf_dir, resource_type)


def star_set(spark: SparkSession, sf_dir: str, *types: str) -> dict[str, DataFrame]:
    return {t: star_resources(spark, sf_dir, t) for t in (types or RULES)}
