import base64
import re
import json
import uuid
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from carelattice import constants as K
from carelattice.functions import address, extensions, identity, paths, refs, text
from carelattice.schemas import ADDRESSES, DDL, struct_of


def evaluate(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {type_}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_references(spark):
    values = ["Organization/abc", "Location/123", "https://example.org/fhir/organization/xyz?a=1", "#c1", "plain", "Organization/", " ", None, "Organization/a#b"]
    assert evaluate(spark, values, lambda c: refs.parse_ref(c, "Organization")) == ["abc", None, "xyz", None, None, None, None, None, "a"]
    assert evaluate(spark, values[:5], refs.ref_id) == ["abc", "123", "xyz?a=1", "#c1", "plain"]
    assert evaluate(spark, ["Organization/a", "x", "http://h/Location/1"], refs.ref_type) == ["Organization", None, "Location"]


def test_reference_fields_in_every_shape(spark):
    values = ['{"reference":"Location/1"}', '[{"reference":"Location/1"},"Location/2",{"display":"x"},{"reference":"Endpoint/3"}]', "Location/4", None, "[]"]
    found = evaluate(spark, values, lambda c: refs.typed_ids(c, "Location"))
    assert found == [["1"], ["1", "2"], ["4"], [], []]


def test_all_references_at_any_depth(spark):
    value = '{"a":{"reference":"X/1"},"b":[{"c":{"reference" : "Y/2"}},{"reference":"X/1"}],"t":"\\"reference\\":\\"Z/9\\"","d":{"reference":"bare"},"e":{"reference":"Y/2/_history/3"}}'
    assert sorted(evaluate(spark, [value], refs.all_refs)[0]) == ["X/1", "Y/2", "Y/2/_history/3"]


def test_references_written_with_escapes(spark):
    values = [
        r'{"reference":"Organization\/1"}',
        r'{"reference":"Organization\u002f2"}',
        r'{"r\u0065f\u0065rence" : "Location/3"}',
        r'{"note":"\\","a":{"reference":"X/\"4\\"}}',
        r'{"note":"\\\",\"reference\":\"No/1\"","reference":{"reference":7},"b":["reference","No/2",{"reference":null},{"reference":["No/3"]}]}',
        '{"reference":"bare"}', '{"reference":"/x"}', '{"reference":"X/"}', "", "no json", None,
        json.dumps({"text": "\n\t\\ \"" * 20_000, "deep": {"reference": "Deep/5"}}),
    ]
    found = evaluate(spark, values, refs.all_refs)
    assert found == [["Organization/1"], ["Organization/2"], ["Location/3"], ['X/"4\\'], [], [], [], [], [], [], None, ["Deep/5"]]


def test_uuid_equals_the_standard_library(spark):
    values = ["HansSolo", "a", "é", "11111111-1111-1111-1111-111111111111", "ABCDEF00-0000-4000-8000-000000000000", "org-1"]
    want = []
    for v in values:
        try:
            want.append(str(uuid.UUID(v)))
        except ValueError:
            want.append(str(uuid.uuid5(uuid.NAMESPACE_URL, v)))
    assert evaluate(spark, values, identity.stable_uuid) == want
    assert want[0] == "27442cfc-c18e-592e-a368-4d54cf662690"


URLS = [
    "http://a.org/x", "HTTPS://a.org", "http:///x", "https://", "mailto:a@b.org", "urn:uuid:1", "ftp:", "/x/y", "a b", "", "http:a", "x:?q", "http://[::1]/", "http://[::1/",
    "1a://b", "a+b://c", "//host/x", "https://h?q#f", "scheme://", "file:///x", "http://a b/", "ldap://h", "tel:1",
]


def well_formed(url):
    try:
        p = urlparse(url.strip())
    except ValueError:
        return False
    if p.scheme in ("http", "https"):
        return bool(p.netloc)
    return bool(p.scheme) and bool(p.netloc or p.path)


def test_well_formed_urls_agree_with_the_standard_library(spark):
    assert evaluate(spark, URLS, text.is_well_formed_url) == [well_formed(u) for u in URLS]


def test_placeholder_urls(spark):
    values = ["https://api.example.com/x", "https://test.org", "https://contest.org", "https://a.test", "http://localhost:80", "http://my-url/your_url", "https://xxxx.org", "https://a.org/TODO", "https://a.org"]
    want = [any(re.search(p, v.lower()) for p in K.PLACEHOLDER_URL_PATTERNS) for v in values]
    assert evaluate(spark, values, text.is_placeholder_url) == want
    assert want[-1] is False and want[2] is False


def test_emails_and_names(spark):
    assert evaluate(spark, ["a@b.org", " a@b.org ", "a@b", "https://a@b.org/", None], text.is_email) == [True, True, False, False, False]
    assert evaluate(spark, [" Test ", "N/A", "Tester", None], text.is_placeholder_name) == [True, True, False, False]
    assert evaluate(spark, ["J", " ", "Jo", None, " x "], text.is_short_name) == [True, False, False, False, True]
    assert evaluate(spark, ["ABCD", "ABC", "Abcd", "A-B C"], text.is_all_caps) == [True, False, False, True]
    assert evaluate(spark, ["O'Brien-Smith Jr.", "Zoë", "A2"], text.has_illegal_chars) == [False, True, True]
    assert evaluate(spark, ["\t\n", "x", "", None], text.present) == [False, True, False, False]


def test_states(spark):
    values = ['{"state":" wy "}', '[{"city":"x"},{"state":""},{"state":"ri"}]', "[]", None]
    assert evaluate(spark, values, lambda c: address.first_state(F.from_json(c, ADDRESSES))) == ["WY", "RI", None, None]
    assert address.normalize_states(["wy", "RI", "wy", "  ca  "]) == (["WY", "RI", "CA"], "WY-RI-CA")
    with pytest.raises(ValueError):
        address.normalize_states([" "])
    assert len(K.STATES_DC_TERRITORIES) == 56 and len(K.STATES_AND_DC) == 51


def test_address_key_groups_like_the_trimmed_parts(spark):
    df = spark.createDataFrame([(" a ", None), ("a", ""), ("a", "b")], "x STRING, y STRING")
    keys = [r[0] for r in df.select(identity.dimension_key(F.col("x"), F.col("y"))).collect()]
    assert keys[0] == keys[1] != keys[2] and len(keys[0]) == 32


def test_issuer_state(spark):
    assert evaluate(spark, ["Organization/Organization-State-WY", "Organization/State-wyo", None], refs.issuer_state) == ["WY", None, None]


def test_attachment(spark):
    data = base64.b64encode(b'{"type":"Polygon"}').decode()
    df = spark.createDataFrame([(data, None), (None, "u"), ("%%", None)], "data STRING, url STRING")
    out = [r[0] for r in df.select(extensions.attachment_text(F.struct("data", "url"))).collect()]
    assert out == ['{"type":"Polygon"}', "url:u", None]


def test_unsigned_numbers(spark):
    df = spark.createDataFrame([("9223372036854775807",), ("9223372036854775808",)], "v STRING")
    assert [tuple(r) for r in df.select(*identity.fit_bigint(F.col("v"))).collect()] == [(9223372036854775807, None), (None, "9223372036854775808")]


def test_bounding_box(spark):
    df = spark.createDataFrame([("40.5", "-74.5"), ("41", "-74.5"), ("x", "-74.5"), (None, None)], "a STRING, b STRING")
    assert [r[0] for r in df.select(address.within_box(F.col("a"), F.col("b"), 40, 41, -75, -74)).collect()] == [True, False, False, False]


@pytest.mark.parametrize(
    "path, want",
    [
        ("id", "p"), ("name[0].given[1]", "B"), ("name[5].family", None), ("identifier.where(system='s2').value.first()", "v2"), ("identifier.where(system='none').value.first()", None),
        ("extension.where(url='u').valueBoolean", True), ("qualification.code.coding.code", "C1"), ("name.given[2]", "C"), ("meta.lastUpdated", "t"),
    ],
)
def test_paths(spark, path, want):
    value = """{"id":"p","meta":{"lastUpdated":"t"},"name":[{"given":["A","B"]},{"given":["C"]}],"identifier":[{"system":"s1","value":"v1"},{"system":"s2","value":"v2"}],
      "extension":[{"url":"u","valueString":"x"},{"url":"u","valueBoolean":true}],"qualification":[{"identifier":[]},{"code":{"coding":[{"code":"C1"}]}}]}"""
    schema = struct_of(DDL["Practitioner"])
    df = spark.createDataFrame([(value,)], "value STRING").select(F.from_json("value", schema).alias("r"))
    assert df.select(paths.path_column(path, schema, F.col("r"))).first()[0] == want


@pytest.mark.parametrize("path", ["name[0", "id.where(x='y')", "name.join(',')", "id[0]"])
def test_unsupported_paths_are_refused(spark, path):
    with pytest.raises(ValueError):
        paths.path_column(path, struct_of(DDL["Practitioner"]), F.col("r"))
