"""Shredding of nested records (problem 2)."""

import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from textlens.operators import nested


def _rows(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "j string").select(F.from_json("j", nested.RECORD).alias("r")).select("r.*")


def _paths(df):
    s = nested.shred(df, ["tinyId"], ["designations", "definitions", "valueDomain"])
    parts = [nested.field_values(s, ["tinyId"], ["designations"], ["designation"]), nested.field_values(s, ["tinyId"], ["valueDomain", "permissibleValues"], ["valueMeaningName"])]
    return {(r.tinyId, r.field_path, r.text) for p in parts for r in p.collect()}, s


def test_nulls_keep_places_and_equal_objects_are_stored_once(spark):
    d = {"designation": "Pain", "tags": ["a"]}
    df = _rows(spark, [{"tinyId": "A", "designations": [None, d, {"designation": "  "}]}, {"tinyId": "B", "designations": [d]}, {"tinyId": "B", "designations": [d]}, {"tinyId": "C", "designations": None}])
    found, s = _paths(df)
    assert found == {("A", "designations[1].designation", "Pain"), ("B", "designations[0].designation", "Pain")}
    assert s.objects.where("kind = 'designations'").count() == 2
    assert s.bridges.count() == 3


def test_deep_values_and_empty_table(spark):
    v = {"permissibleValue": "0", "valueMeaningName": "No"}
    df = _rows(spark, [{"tinyId": "A", "valueDomain": {"name": "x", "permissibleValues": [v, None, v]}}])
    found, s = _paths(df)
    assert found == {("A", "valueDomain.permissibleValues[0].valueMeaningName", "No"), ("A", "valueDomain.permissibleValues[2].valueMeaningName", "No")}
    assert s.objects.count() == 2
    assert _paths(df.limit(0))[0] == set()


def test_identity_ignores_field_order_but_not_content(spark):
    df = _rows(spark, [{"tinyId": "A", "definitions": [{"definition": "x", "definitionFormat": "html"}]}, {"tinyId": "B", "definitions": [{"definitionFormat": "html", "definition": "x"}]}, {"tinyId": "C", "definitions": [{"definition": "x"}]}])
    s = nested.shred(df, ["tinyId"], ["definitions"])
    assert len({r.root_id for r in s.roots.collect()}) == 2


def test_latest_version(spark):
    df = spark.createDataFrame([("A", 1, "old"), ("A", 2, "new"), ("A", 2, "new"), (None, 9, "x"), ("B", None, "only")], "tinyId string, v int, t string")
    assert sorted((r.tinyId, r.t) for r in nested.latest_version(df, "tinyId", "v").distinct().collect()) == [("A", "new"), ("B", "only")]


def test_raw_payload_shapes(spark):
    payloads = [
        '{"tinyId": "A", "designations": "bare", "definitions": {"definition": "lone"}}', '{"data": [{"tinyId": "B", "designations": [null, "x"]}, {"tinyId": "C"}]}',
        '[{"tinyId": "D"}]', '{"tinyId": "E", ', "", None, '{"tinyId": "F", "x": NaN}', "7", '{"cde": {"tinyId": "G", "designations": 5}}',
    ]
    raw = spark.createDataFrame([(i, p, "z") for i, p in enumerate(payloads)], "line_no int, payload string, tinyId string")
    got = {r.tinyId: r for r in nested.parse_records(raw).collect()}
    assert set(got) == {"A", "B", "C", "D", "G"}
    assert got["A"].designations[0].designation == "bare" and got["A"].definitions[0].definition == "lone"
    assert got["B"].designations[0] is None and got["B"].designations[1].designation == "x"
    assert got["G"].designations == [None]


text = st.one_of(st.none(), st.text("ab ", max_size=3))
label = st.one_of(st.none(), st.fixed_dictionaries({"designation": text}))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.lists(label, max_size=4)), min_size=1, max_size=6))
def test_round_trip_against_brute_force(spark, lists):
    records = [{"tinyId": f"r{i}", "designations": v} for i, v in enumerate(lists)]
    want = {(r["tinyId"], f"designations[{i}].designation", d["designation"]) for r in records for i, d in enumerate(r["designations"] or []) if d and (d["designation"] or "").strip()}
    assert _paths(_rows(spark, records))[0] == want
