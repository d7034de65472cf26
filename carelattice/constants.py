"""Fixed values the results depend on: code systems, extension URLs, word lists,
state lists, patterns and check thresholds. All of them are plain data."""

RESOURCE_TYPES = (
    "Practitioner",
    "PractitionerRole",
    "Organization",
    "OrganizationAffiliation",
    "Location",
    "Endpoint",
)

# fixed values: code systems
NPI_SYSTEM = "http://hl7.org/fhir/sid/us-npi"
NUCC_SYSTEM = "http://nucc.org/provider-taxonomy"
DEGREE_SYSTEM = "http://terminology.hl7.org/CodeSystem/v2-0360"
ORG_TYPE_SYSTEM = "http://terminology.hl7.org/CodeSystem/organization-type"
ORG_TYPE_PROV = "prov"
CONNECTION_TYPE_SYSTEM = "http://terminology.hl7.org/CodeSystem/endpoint-connection-type"

# fixed values: extension URLs; where two spellings are in use, both are accepted
RACE_URLS = ("http://hl7.org/fhir/us/core/StructureDefinition/us-core-race",)
ETHNICITY_URLS = ("http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity",)
ENDPOINT_REFERENCE_URLS = (
    "https://build.fhir.org/ig/HL7/fhir-us-ndh/StructureDefinition-base-ext-endpoint-reference.html",
    "http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-endpoint-reference",
)
PROFICIENCY_URLS = (
    "https://build.fhir.org/ig/HL7/fhir-us-ndh/StructureDefinition-base-ext-communication-proficiency.html",
)
LOGO_URLS = ("https://build.fhir.org/ig/HL7/fhir-us-ndh/StructureDefinition-base-ext-logo.html",)
ALIAS_TYPE_URLS = ("https://example.com/extension_url/org-alias-type",)
ORG_RATING_URLS = ("https://example.com/extension_url/rating",)
ORG_PECOS_URLS = ("https://example.com/extension_url/cms_pecos_validated",)
ORG_IAL2_URLS = ("https://example.com/extension_url/cms_ial2_validated",)
ORG_NETWORK_URLS = ("https://example.com/extension_url/has_cms_aligned_data_network",)
ROLE_NEW_PATIENTS_URLS = (
    "https://example.com/extension_url/accepting_new_patients",
    "http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-newpatients",
)
ROLE_RATING_URLS = (
    "https://example.com/extension_url/practitioner_role_rating",
    "http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-rating",
)
ROLE_PECOS_URLS = ("https://example.com/extension_url/practitioner_role_cms_pecos_validated",)
ROLE_IAL2_URLS = ("https://example.com/extension_url/practitioner_role_cms_ial2_validated",)
ROLE_NETWORK_URLS = (
    "https://example.com/extension_url/practitioner_role_has_cms_aligned_data_network",
)
CMS_ENROLLED_URLS = ("https://example.com/extension_url/cms-enrolled",)
CMS_IAL2_URLS = ("https://example.com/extension_url/cms-ial2-verified",)
CMS_NETWORK_URLS = ("https://example.com/extension_url/cms-aligned-data-networks",)
BOUNDARY_URLS = ("http://hl7.org/fhir/StructureDefinition/location-boundary-geojson",)
ACCESSIBILITY_URLS = ("http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-accessibility",)
RANK_URLS = ("http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-endpoint-rank",)
DESCRIPTION_URLS = ("http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-org-description",)

# fixed values: profile URLs written back when a record is serialized
PROFILES = {
    "Organization": "http://hl7.org/fhir/us/ndh/StructureDefinition/ndh-Organization",
    "Location": "http://hl7.org/fhir/us/ndh/StructureDefinition/ndh-Location",
    "Endpoint": "http://hl7.org/fhir/us/ndh/StructureDefinition/ndh-Endpoint",
}

# fixed values: state codes
STATES_AND_DC = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS",
    "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY",
    "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV",
    "WI", "WY", "DC",
)
TERRITORIES = ("PR", "VI", "GU", "AS", "MP")
STATES_DC_TERRITORIES = STATES_AND_DC + TERRITORIES
LARGEST_STATES = ("CA", "TX", "FL", "NY", "PA")

# fixed values: words that stand in for a missing name
PLACEHOLDER_NAMES = ("test", "unknown", "pending", "n/a", "none", "null")

# fixed values: patterns
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
NAME_ILLEGAL_CHARS = r"[^a-zA-Z \-'.]"
PLACEHOLDER_URL_PATTERNS = (
    r"example\.com",
    r"example\.org",
    r"example\.net",
    r"localhost",
    r"127\.0\.0\.1",
    r"\btest\b",
    r"\btodo\b",
    r"\bplaceholder\b",
    r"\bfake\b",
    r"\bdummy\b",
    r"\bsample\b",
    r"\.invalid$",
    r"\.test$",
    r"\.example$",
    r"\.localhost$",
    r"your[_\-]?url",
    r"replace[_\-]?me",
    r"changeme",
    r"xxx+",
    r"0\.0\.0\.0",
)
ENDPOINT_STATUSES = ("active", "suspended", "error", "off", "entered-in-error", "test")

# fixed values: text written where a value is absent
MISSING_CONNECTION_CODE = "(missing)"
PLACEHOLDER = "(placeholder)"
MISSING_TYPE_LABEL = "<missing_resourceType>"

# fixed values: check thresholds (defaults; every one can be overridden by configuration)
THRESHOLDS = {
    "min_rows": 1,
    "max_rows": 10_000_000,
    "min_both_names": 0.95,
    "max_placeholder_names": 0.01,
    "min_name_length": 2,
    "max_short_names": 0.02,
    "all_caps_length": 4,
    "max_all_caps": 0.10,
    "max_special_chars": 0.01,
    "max_gender_pct": 70.0,
    "min_gender_pct": 30.0,
    "small_gender_pct": 5.0,
    "min_language_pct": 10.0,
    "expected_top_nucc": (),
    "top_nucc": 10,
    "min_top_nucc_match": 7,
    "max_without_roles_pct": 50.0,
    "max_without_affiliations_pct": 80.0,
    "max_addresses": 50,
    "max_telecom": 20,
    "min_prov_orgs": 1,
    "max_prov_orgs": 10_000_000,
    "min_taxonomy_codes": 100,
    "max_taxonomy_codes": 10_000_000,
    "min_fhir_endpoints": 1,
    "min_direct_endpoints": 1,
    "max_missing_address": 0.02,
    "min_well_formed": 0.95,
    "min_https": 0.80,
    "max_placeholder_urls": 0.01,
    "min_active": {
        "Organization": 0.85,
        "Practitioner": 0.90,
        "Location": 0.85,
        "PractitionerRole": 0.80,
    },
    "max_not_active": 0.20,
    "min_rows_to_judge": 10,
    "min_complete_address": 0.80,
    "min_valid_state": 0.95,
    "min_any_contact": 0.90,
    "min_non_fax_contact": 0.70,
    "max_depth": 6,
    "max_broken_parents": 0.01,
    "max_cycles": 0,
    "max_state_share": 0.25,
    "min_states": 40,
    "min_top5_share": 0.20,
    "max_hhi": 0.10,
    "max_broken_refs": {
        "PractitionerRole.practitioner": 0.01,
        "PractitionerRole.organization": 0.01,
        "PractitionerRole.endpoint": 0.02,
        "OrganizationAffiliation.organization": 0.01,
        "OrganizationAffiliation.participatingOrganization": 0.01,
    },
    "max_total_broken_refs": 100,
    "allow_delta": 0,
}

# fixed value: rows beyond an announced total after which a paged ingest ends
MOST_OVERRUN = 100_000
