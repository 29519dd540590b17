"""Nested schemas and their changes."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from plumbline.operators import paths as pa


def observed(spark, versions, depth=pa.DEPTH):
    rows = [(v, None, value if isinstance(value, str) or value is None else json.dumps(value)) for v, values in versions.items() for value in values]
    return pa.observed_paths(spark.createDataFrame(rows, "version int, event_ts timestamp, value string"), "t", depth=depth)


def told(paths):
    return {r["path"]: (r["type"], r["nullable"]) for r in paths.collect()}


def test_types_and_nullability_by_path(spark):
    values = [
        {"a": 1, "b": {"c": 1, "d": None}, "l": [1, 2.5], "m": [], "x": [{"y": 1}, {"y": None, "z": "s"}], "q": {"w": 1}},
        {"a": 2.5, "b": {"c": "x"}, "l": [], "m": None, "x": [], "q": "text"},
        {"a": None, "b": {}, "l": [None], "deep": {"e": {"f": {"g": {"h": {"i": 1}}}}}},
        "no json", "[1]", None, {},
    ]
    paths = observed(spark, {1: values})
    assert {r["record_count"] for r in paths.collect()} == {4}
    assert told(paths) == {
        "a": ("double", True), "b": ("struct", True), "b.c": ("string", True), "b.d": ("void", True), "l": ("array", True), "l[]": ("double", True),
        "m": ("array", True), "x": ("array", True), "x[]": ("struct", False), "x[].y": ("bigint", True), "x[].z": ("string", True),
        "q": ("string", True), "q.w": ("bigint", False), "deep": ("struct", True), "deep.e": ("struct", False), "deep.e.f": ("struct", False),
        "deep.e.f.g": ("struct", False), "deep.e.f.g.h": ("struct", False),
    }
    assert "deep.e" not in told(observed(spark, {1: values}, depth=1))


def test_forms_keep_paths_and_types_and_meet(spark):
    texts = [
        '{"a": "x\\\\\\" : 1", "1,2": -0, "b\\u0061 ":[ true ,false,null, 1.50, -12,"",{"q" :"s"}], "c":1e5, "d":123456789012345678901, "e":1.0, "f":9223372036854775807}',
        '{"a":"\\u00e9\\n","true":{"0":0.5}} tail 1', '{"a":}', '{"a":01}', '{"a":1,}', '{"a":"\\x"}', '{1"a":}', '{"a":tru}', '{"a":1,"a":2}', "", " ", "null", "5", '"s"',
        '["a"]', '{"a":-}', '{"a":1.}', '{"a":.5}', '{"a":1}}', '{"k":"' + "y\\n" * 9000 + '"}', '{"t":"two\nlines"}', '{"a":1.5.2}', '{"a":1-2}', None,
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = frame.filter("try_parse_json(t) is not null").selectExpr("i", "schema_of_variant(parse_json(t)) AS own", "t")
    rows = found.withColumn("form", pa.json_form(F.col("t"))).selectExpr("i", "own", "form", "schema_of_variant(try_parse_json(form)) AS formed").collect()
    fraction = lambda name: re.sub(r"DECIMAL\(\d+,\d+\)", "DOUBLE", name)
    assert len(rows) > 6 and all(fraction(r["own"]) == fraction(r["formed"]) for r in rows)
    # However many payloads, few forms are taken apart.
    many = spark.range(5000).selectExpr("""concat('{"id":', id, ',"s":"t', id, '","x":[{"y":', id, '.25}],"b":', id % 2 = 0, '}') AS t""")
    assert [r[0] for r in many.select(pa.json_form(F.col("t"))).distinct().collect()] == ['{"id":0,"s":"","x":[{"y":0.5}],"b":true}']
    plan = pa.observed_paths(many.selectExpr("1 AS version", "null AS event_ts", "t AS value"), "t")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):]
    assert "regexp_replace" in below and below.count("Generate") == 1


def test_changes_and_verdicts(spark):
    first = {"id": 1, "b": {"c": 1, "d": [1]}, "s": 1}
    paths = observed(spark, {
        1: [first], 3: [{**first, "b": {"c": 1, "d": [1], "n": {"k": 1}}}], 4: [{**first, "s": 1.5, "b": {"c": 1, "d": [1], "n": {"k": 1}}}],
        5: [{**first, "s": 1.5, "b": {"c": 1, "d": [1], "n": {"k": 1}}}, {"id": 2, "b": {"d": [1], "n": {"k": 1}}, "s": 2.5}],
        6: [{"id": "x", "b": {"d": ["t"]}, "s": 1.5}], 7: [{"id": "x", "b": {"d": ["t"]}, "s": 1.5}],
    })
    changes = sorted(tuple(r)[1:] for r in pa.path_changes(paths).collect())
    assert changes == sorted([
        (1, 3, "added", "b.n", None, None), (1, 3, "added", "b.n.k", None, None), (3, 4, "type", "s", "bigint", "double"),
        (4, 5, "nullability", "b.c", None, None), (5, 6, "removed", "b.c", None, None), (5, 6, "removed", "b.n", None, None),
        (5, 6, "removed", "b.n.k", None, None), (5, 6, "type", "b.d[]", "bigint", "string"), (5, 6, "type", "id", "bigint", "string"),
    ])
    rows = {r["to_version"]: (r["is_breaking_change"], r["severity"]) for r in pa.path_verdicts(pa.path_changes(paths), ["id"]).collect()}
    assert rows == {3: (False, "low"), 4: (False, "medium"), 6: (True, "critical")}
    assert {r["version"] for r in pa.newest_versions(paths, 2).collect()} == {6, 7}


def test_map_like_payloads_of_a_million_keys_are_rows(spark):
    keys = F.concat(F.lit('{"k":{"'), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.col("id") * 1000 + k), '":1,"'), F.lit('":1}}'))
    messages = spark.range(1000).select((F.col("id") % 2 + 1).alias("version"), F.lit(None).cast("timestamp").alias("event_ts"), keys.alias("value"))
    paths = pa.observed_paths(messages, "t")
    changes = pa.path_changes(paths)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    assert {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()} == {"added": 500_000, "removed": 500_000}


def test_empty(spark):
    paths = observed(spark, {1: ["junk"]})
    assert paths.isEmpty() and pa.path_changes(paths).isEmpty() and pa.path_verdicts(pa.path_changes(paths)).isEmpty()
