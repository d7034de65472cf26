"""The shipped view specifications: column name and path, in output order."""

# fixed values: columns of the six views
VIEW_COLUMNS = {
    "practitioner": (
        "Practitioner",
        [
            ("resource_uuid", "id"),
            ("npi", "identifier.where(system='http://hl7.org/fhir/sid/us-npi').value.first()"),
            ("active_status", "active"),
            ("first_name", "name[0].given[0]"),
            ("middle_name", "name[0].given[1]"),
            ("last_name", "name[0].family"),
            ("prefix", "name[0].prefix[0]"),
            ("non_clinical_suffix", "name[0].suffix[0]"),
            ("other_first_name", "name[1].given[0]"),
            ("other_middle_name", "name[1].given[1]"),
            ("other_last_name", "name[1].family"),
            ("other_prefix", "name[1].prefix[0]"),
            ("other_non_clinical_suffix", "name[1].suffix[0]"),
            ("gender", "gender"),
            ("is_cms_enrolled", "extension.where(url='https://example.com/extension_url/cms-enrolled').valueBoolean"),
            ("is_cms_ial2_verified", "extension.where(url='https://example.com/extension_url/cms-ial2-verified').valueBoolean"),
            (
                "is_participating_in_cms_aligned_data_networks",
                "extension.where(url='https://example.com/extension_url/cms-aligned-data-networks').valueBoolean",
            ),
        ],
    ),
    "practitioner_role": (
        "PractitionerRole",
        [
            ("resource_uuid", "id"),
            ("active", "active"),
            ("practitioner_reference", "practitioner.reference"),
            ("organization_reference", "organization.reference"),
            ("code_system", "code[0].coding[0].system"),
            ("code_code", "code[0].coding[0].code"),
            ("code_display", "code[0].coding[0].display"),
            ("location_reference", "location[0].reference"),
            ("healthcare_service_reference", "healthcareService[0].reference"),
            (
                "accepting_new_patients",
                "extension.where(url='http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-newpatients').valueBoolean.first()",
            ),
            ("rating", "extension.where(url='http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-rating').valueInteger.first()"),
        ],
    ),
    "organization": (
        "Organization",
        [
            ("resource_uuid", "id"),
            ("npi", "identifier.where(system='http://hl7.org/fhir/sid/us-npi').value.first()"),
            ("active", "active"),
            ("name", "name"),
            (
                "description",
                "extension.where(url='http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-org-description').valueString.first()",
            ),
            ("part_of_reference", "partOf.reference"),
            ("organization_type_code", "type[0].coding[0].code"),
        ],
    ),
    "organization_affiliation": (
        "OrganizationAffiliation",
        [
            ("resource_uuid", "id"),
            ("active", "active"),
            ("primary_organization_reference", "organization.reference"),
            ("participating_organization_reference", "participatingOrganization.reference"),
            ("code_system", "code[0].coding[0].system"),
            ("code_code", "code[0].coding[0].code"),
            ("code_display", "code[0].coding[0].display"),
        ],
    ),
    "location": (
        "Location",
        [
            ("resource_uuid", "id"),
            ("status", "status"),
            ("name", "name"),
            ("description", "description"),
            ("mode", "mode"),
            ("address_line1", "address.line[0]"),
            ("address_line2", "address.line[1]"),
            ("address_city", "address.city"),
            ("address_state", "address.state"),
            ("address_postal_code", "address.postalCode"),
            ("address_country", "address.country"),
            ("latitude", "position.latitude"),
            ("longitude", "position.longitude"),
            ("altitude", "position.altitude"),
            ("managing_organization_reference", "managingOrganization.reference"),
            ("part_of_location_reference", "partOf.reference"),
            ("availability_exceptions", "availabilityExceptions"),
        ],
    ),
    "endpoint": (
        "Endpoint",
        [
            ("resource_uuid", "id"),
            ("status", "status"),
            ("connection_type_system", "connectionType.system"),
            ("connection_type_code", "connectionType.code"),
            ("connection_type_display", "connectionType.display"),
            ("name", "name"),
            ("address", "address"),
            (
                "endpoint_rank",
                "extension.where(url='http://hl7.org/fhir/us/ndh/StructureDefinition/base-ext-endpoint-rank').valuePositiveInt.first()",
            ),
        ],
    ),
}


def view_spec(name: str) -> dict:
    """A shipped view in the JSON form users write their own views in."""
    resource, columns = VIEW_COLUMNS[name]
    return {
        "resourceType": "ViewDefinition",
        "name": name,
        "resource": resource,
        "select": [{"column": [{"name": n, "path": p} for n, p in columns]}],
    }
