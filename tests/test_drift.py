from __future__ import annotations

import pytest

from plumbline.operators import drift as dr
from plumbline.plans import jobs
from plumbline.sources import snapshots as sn

DDL = "table_name string, version bigint, committed_at timestamp, record_count bigint, columns array<struct<name:string,type:string,nullable:boolean>>"
BASE = {"id": "int", "a": "int", "b": "bigint"}

# (columns, nullable columns) of seven versions
VERSIONS = [
    (BASE, ()),
    ({**BASE, "c": "string"}, ()),                              # added
    ({"id": "int", "a": "int", "c": "string"}, ()),             # removed
    ({"id": "int", "a": "bigint", "c": "string"}, ()),          # widened
    ({"id": "int", "a": "string", "c": "string"}, ()),          # not readable as before
    ({"id": "int", "a": "string", "c": "string"}, ("a",)),      # nullability only
    ({"a": "string", "c": "string"}, ("a",)),                   # key column removed
]


def frame(spark, versions, first=1):
    rows = [
        ("t", first + i, None, 1, [(n, t, n in nullable) for n, t in sorted(columns.items())])
        for i, (columns, nullable) in enumerate(versions)
    ]
    return spark.createDataFrame(rows, DDL)


def test_changes_and_severity(spark):
    versions = frame(spark, VERSIONS)
    rows = {r["to_version"]: r for r in dr.verdicts(dr.drift(versions), key_columns=["id"]).collect()}
    assert {v: (r["is_breaking_change"], r["severity"]) for v, r in rows.items()} == {
        2: (False, "low"), 3: (True, "high"), 4: (False, "medium"), 5: (True, "high"), 7: (True, "critical")}
    assert rows[2]["added_columns"] == ["c"]
    assert rows[3]["removed_columns"] == ["b"]
    assert [tuple(c) for c in rows[5]["type_changes"]] == [("a", "bigint", "string")]
    assert rows[7]["rollback_sql"] == "SELECT * FROM t VERSION AS OF 6"
    assert rows[2]["rollback_sql"] is None
    changed = {r["to_version"]: r["nullability_changes"] for r in dr.changes(versions).collect()}
    assert changed[6] == ["a"]


def test_equal_versions_and_single_version_have_no_drift(spark):
    assert dr.drift(frame(spark, [VERSIONS[0]] * 3)).isEmpty()
    assert dr.newest_drift(frame(spark, VERSIONS[:1])).isEmpty()


def test_added_and_removed_mirror(spark):
    forth = dr.drift(frame(spark, [VERSIONS[0], VERSIONS[1]])).first()
    back = dr.drift(frame(spark, [VERSIONS[1], VERSIONS[0]])).first()
    assert forth["added_columns"] == back["removed_columns"] == ["c"]
    assert forth["removed_columns"] == back["added_columns"] == []


def test_gap_in_versions_compares_with_the_version_before(spark):
    versions = frame(spark, [VERSIONS[0]], 1).unionByName(frame(spark, [VERSIONS[1]], 5))
    assert [(r["from_version"], r["to_version"]) for r in dr.drift(versions).collect()] == [(1, 5)]


def test_history_limits_versions(spark):
    assert sorted(r["version"] for r in dr.history(frame(spark, VERSIONS + VERSIONS)).collect()) == list(range(8, 15))


def test_job_raises_on_breaking_change_only(spark):
    with pytest.raises(jobs.BreakingSchemaChange, match="critical"):
        jobs.check_schema(frame(spark, VERSIONS), ["id"])
    assert jobs.check_schema(frame(spark, VERSIONS[:2])).first()["severity"] == "low"
    assert jobs.check_schema(frame(spark, VERSIONS[:1])).isEmpty()


def test_observed_types(spark):
    values = [
        '{"a": 1, "b": 1.5, "c": "x", "d": null, "e": [1], "f": {"g": 1}, "h": 1, "i": 1, "j": true}',
        '{"a": 2, "b": 2, "c": "y", "d": null, "e": [], "f": {}, "h": "1", "j": false}',
        "not json", None,
    ]
    rows = spark.createDataFrame([(1, None, v) for v in values], "version int, event_ts timestamp, value string")
    found = dr.observed_versions(rows, "t").first()
    assert found["record_count"] == 2
    assert [tuple(c) for c in found["columns"]] == [
        ("a", "bigint", False), ("b", "double", False), ("c", "string", False), ("d", "void", True), ("e", "array", False),
        ("f", "struct", False), ("h", "string", False), ("i", "bigint", True), ("j", "boolean", False)]


def test_versions_of_snapshots(spark, tmp_path):
    path = f"{tmp_path}/s"
    sn.publish(spark.range(3), path, 1)
    sn.publish(spark.range(3).selectExpr("id", "id * 2 AS twice"), path, 2)
    drift = dr.newest_drift(sn.schema_versions(spark, path, "s")).first()
    assert drift["added_columns"] == ["twice"]
