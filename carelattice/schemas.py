"""Explicit schemas, one per resource type, limited to the fields some job reads.

``address`` is declared as text because it may arrive as an object or as an array; see
:func:`carelattice.sources.ndjson.parse_resources`, which always turns it into an array.
"""

from collections.abc import Iterable

from pyspark.sql import types as T

CODING = "STRUCT<system:STRING,code:STRING,display:STRING>"
CONCEPT = f"STRUCT<coding:ARRAY<{CODING}>,text:STRING>"
REFERENCE = "STRUCT<reference:STRING>"
IDENTIFIERS = f"ARRAY<STRUCT<system:STRING,value:STRING,type:{CONCEPT}>>"
TELECOMS = "ARRAY<STRUCT<system:STRING,value:STRING>>"
ADDRESS = (
    "STRUCT<line:ARRAY<STRING>,city:STRING,state:STRING,postalCode:STRING,"
    "country:STRING,type:STRING,use:STRING>"
)
ADDRESSES = f"ARRAY<{ADDRESS}>"
NESTED_EXTENSION = (
    "STRUCT<url:STRING,valueString:STRING,valueCoding:STRUCT<code:STRING>,"
    f"valueReference:{REFERENCE},valuePositiveInt:BIGINT>"
)
EXTENSIONS = (
    "ARRAY<STRUCT<url:STRING,valueBoolean:BOOLEAN,valueInteger:BIGINT,valuePositiveInt:BIGINT,"
    "valueString:STRING,valueCode:STRING,valueUrl:STRING,"
    f"valueReference:{REFERENCE},valueCodeableConcept:{CONCEPT},"
    "valueAttachment:STRUCT<data:STRING,url:STRING>,"
    f"extension:ARRAY<{NESTED_EXTENSION}>>>"
)

_COMMON = (
    "resourceType STRING, id STRING, meta STRUCT<lastUpdated:STRING,profile:ARRAY<STRING>>, "
    f"identifier {IDENTIFIERS}, extension {EXTENSIONS}, "
)

HEADER = "resourceType:STRING, id:VARIANT, meta:STRING"

DDL = {
    "Practitioner": _COMMON
    + "active BOOLEAN, name ARRAY<STRUCT<family:STRING,given:ARRAY<STRING>,prefix:ARRAY<STRING>,"
    "suffix:ARRAY<STRING>,use:STRING>>, gender STRING, "
    f"telecom {TELECOMS}, address STRING, "
    f"qualification ARRAY<STRUCT<code:{CONCEPT},identifier:{IDENTIFIERS},issuer:{REFERENCE}>>, "
    f"communication ARRAY<STRUCT<language:{CONCEPT},coding:ARRAY<STRUCT<code:STRING,display:STRING>>,"
    "extension:ARRAY<STRUCT<url:STRING,valueCode:STRING,valueString:STRING>>>>, "
    f"specialty ARRAY<{CONCEPT}>",
    "PractitionerRole": _COMMON
    + f"active BOOLEAN, practitioner {REFERENCE}, organization {REFERENCE}, code ARRAY<{CONCEPT}>, "
    f"specialty ARRAY<{CONCEPT}>, location ARRAY<{REFERENCE}>, healthcareService ARRAY<{REFERENCE}>, "
    f"endpoint ARRAY<{REFERENCE}>, telecom {TELECOMS}",
    "Organization": _COMMON
    + f"active BOOLEAN, type ARRAY<{CONCEPT}>, name STRING, alias ARRAY<STRING>, "
    "_alias ARRAY<STRUCT<extension:ARRAY<STRUCT<url:STRING,valueCode:STRING,valueString:STRING>>>>, "
    f"description STRING, telecom {TELECOMS}, address STRING, partOf {REFERENCE}, "
    "contact ARRAY<STRUCT<name:STRUCT<family:STRING,given:ARRAY<STRING>>,"
    f"telecom:{TELECOMS},address:{ADDRESS}>>, endpoint ARRAY<{REFERENCE}>",
    "OrganizationAffiliation": _COMMON
    + f"active BOOLEAN, organization {REFERENCE}, participatingOrganization {REFERENCE}, "
    f"code ARRAY<{CONCEPT}>, specialty ARRAY<{CONCEPT}>, location ARRAY<{REFERENCE}>, "
    f"endpoint ARRAY<{REFERENCE}>, telecom {TELECOMS}",
    "Location": _COMMON
    + "active BOOLEAN, status STRING, name STRING, description STRING, mode STRING, "
    f"type ARRAY<{CONCEPT}>, telecom {TELECOMS}, address STRING, "
    "position STRUCT<latitude:STRING,longitude:STRING,altitude:STRING>, "
    f"managingOrganization {REFERENCE}, partOf {REFERENCE}, endpoint ARRAY<{REFERENCE}>, "
    "hoursOfOperation ARRAY<STRUCT<allDay:BOOLEAN,openingTime:STRING,closingTime:STRING>>, "
    "availabilityExceptions STRING",
    "Endpoint": _COMMON
    + "status STRING, "
    f"connectionType STRUCT<system:STRING,code:STRING,display:STRING,coding:ARRAY<{CODING}>>, "
    f"name STRING, address STRING, payloadType ARRAY<{CONCEPT}>, managingOrganization {REFERENCE}",
}

# types whose address text is an address object or a list of them (Endpoint.address is a URL)
ADDRESSED = ("Practitioner", "Organization", "Location")


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def raw_struct(resource_type: str, fields: Iterable[str] | None = None) -> T.StructType:
    """Schema of a type as written in JSON, or of just some of its top-level fields."""
    schema = struct_of(DDL[resource_type])
    if fields is None:
        return schema
    wanted = set(fields)
    missing = wanted - set(schema.names)
    if missing:
        raise ValueError(f"{resource_type} has no {sorted(missing)}")
    return T.StructType([f for f in schema if f.name in wanted])


def parsed_struct(resource_type: str, fields: Iterable[str] | None = None) -> T.StructType:
    """Schema of the parsed record, with ``address`` already an array where it is a postal one."""
    schema = raw_struct(resource_type, fields)
    if resource_type not in ADDRESSED:
        return schema
    addresses = struct_of(f"a {ADDRESSES}")["a"].dataType
    return T.StructType(
        [T.StructField(f.name, addresses if f.name == "address" else f.dataType) for f in schema]
    )
