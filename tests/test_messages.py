from __future__ import annotations

import json

from pyspark.sql import functions as F

from plumbline.operators import catalog as ca
from plumbline.operators import drift as dr
from plumbline.operators import messages as me
from plumbline.operators import profile as pr
from tests.test_drift import VERSIONS, frame


def test_anomaly_prompts(flagged):
    rows = me.anomaly_prompts(flagged).collect()
    assert sum(r["n"] for r in rows) == 108
    row = next(r for r in rows if str(r["date_part"]) == "2099-01-01")
    assert "ROOT CAUSE" in row["prompt"]
    assert "BUSINESS IMPACT" in row["prompt"]
    assert "13 records:" in row["prompt"]
    records = [json.loads(line) for line in row["prompt"].splitlines() if line.startswith("{")]
    assert len(records) == 13
    assert all("future_ts" in r["anomaly_type"] for r in records)


def test_schema_prompt(spark):
    versions = frame(spark, VERSIONS[:3])
    rows = {r["to_version"]: r["prompt"] for r in me.schema_prompts(dr.drift(versions), versions).collect()}
    assert "BREAKING CHANGE" in rows[2]
    assert '"added_columns":["c"]' in rows[2]
    assert '"removed_columns":["b"]' in rows[3]


def test_enrichment_prompts(spark):
    df = spark.range(60).select(F.concat(F.lit("EVT-"), "id").alias("event_id"), F.lit(1.5).alias("amount")).coalesce(1)
    rows = me.enrichment_prompts(df, ["event_id", "amount"]).collect()
    assert sorted(r["n"] for r in rows) == [10, 25, 25]
    assert all("fraud_risk" in r["prompt"] and "enrichment_confidence" in r["prompt"] for r in rows)
    assert sum(r["prompt"].count('"event_id":"EVT-') for r in rows) == 60


def test_catalog_prompts(spark):
    catalog = ca.entries({"clean": spark.range(3)}, {"clean": "/w/clean"})
    profile = pr.table_profile(spark.range(3).selectExpr("id", "'x' AS s"), "clean", "/w/clean", "id")
    prompt = me.table_prompts(profile).first()["prompt"]
    assert '"row_count":3' in prompt
    assert '"id":["0","1","2"]' in prompt
    found = catalog.select(F.lit(1).alias("question_id"), F.lit("Which table has amounts?").alias("question"), F.lit(1).alias("rank"), "document")
    prompt = me.question_prompts(found).first()["prompt"]
    assert "Which table has amounts?" in prompt
    assert "TABLE: clean" in prompt


ANSWERS = [
    (1, 'Sure: {"severity": "low", "is_breaking_change": false, "recommended_actions": ["a"]} Done.'),
    (2, '[{"event_id": "e", "fraud_risk": "low", "reasoning": "r"}] as asked'),
    (3, "no JSON at all"),
    (4, 'broken {"severity": "low" [ '),
    (5, ""),
    (6, None),
    (7, 'two {"severity": "a"} and {"severity": "b"}'),
]


def test_objects(spark):
    rows = me.parse_verdicts(spark.createDataFrame(ANSWERS, "id int, text string")).collect()
    got = {r["id"]: (r["parse_ok"], r["severity"]) for r in rows}
    assert got == {1: (True, "low"), 2: (False, None), 3: (False, None), 4: (False, None), 5: (False, None), 6: (False, None), 7: (False, None)}
    assert rows[0]["recommended_actions"] == ["a"]


def test_arrays(spark):
    answers = spark.createDataFrame([(2, ANSWERS[1][1]), (3, "x"), (4, "[1, "), (5, '[{"event_id": "a"}, {"event_id": "b"}]')], "id int, text string")
    rows = me.parse_enrichments(answers)
    assert [(r["id"], r["event_id"], r["fraud_risk"]) for r in rows.collect()] == [(2, "e", "low"), (5, "a", None), (5, "b", None)]
    assert sorted(r["id"] for r in me.unreadable(answers).collect()) == [3, 4]


def test_reports(spark):
    text = 'Report: {"anomaly_groups": [{"anomaly_type": "null_user", "count": 2, "example_event_ids": ["a", "b"]}], "overall_pipeline_health": "healthy"}'
    row = me.parse_reports(spark.createDataFrame([(text,)], "text string")).first()
    assert row["anomaly_groups"][0]["count"] == 2
    assert row["anomaly_groups"][0]["example_event_ids"] == ["a", "b"]
    assert row["overall_pipeline_health"] == "healthy"


def test_report_through_a_service(flagged):
    def service(prompts):
        records = [json.loads(line) for line in prompts[0].splitlines() if line.startswith("{")]
        if any(r["currency"] == "XYZ" and r["amount"] < 0 for r in records):
            raise RuntimeError("down")
        group = {"anomaly_type": "any", "count": len(records), "example_event_ids": [records[0]["event_id"]]}
        health = "critical" if len(records) > 10 else "healthy"
        return ["Report: " + json.dumps({"anomaly_groups": [group], "overall_pipeline_health": health, "executive_summary": "s", "recommended_actions": ["b", "a"]})]

    prompts = me.anomaly_prompts(flagged, size=4)
    answers = me.answer(prompts, service)
    assert answers.columns == ["date_part", "batch", "n", "text"]
    parsed = me.parse_reports(answers).cache()
    by_day = parsed.groupBy("date_part").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("parse_ok"), F.col("n"))).alias("read"), F.count_if(~F.col("parse_ok")).alias("unread"))
    wanted = {r["date_part"]: r for r in by_day.collect()}
    reports = {r["run_date"]: r for r in me.combine_reports(parsed, "2024-01-31 00:00:00").collect()}
    assert {d: (r["anomaly_count"], r["unread_batches"]) for d, r in reports.items()} == {d: (r["n"], r["unread"]) for d, r in wanted.items()}
    for day, row in reports.items():
        report = json.loads(row["full_report"])
        if wanted[day]["read"] is None:
            assert row["pipeline_health"] == "unknown" and report["anomaly_groups"] is None
        else:
            assert [g["count"] for g in report["anomaly_groups"]] == [wanted[day]["read"]]
            assert report["recommended_actions"] == ["a", "b"]


def test_worst_health_wins_and_failed_calls_are_null(spark):
    def service(prompts):
        if "fail" in prompts:
            raise RuntimeError("down")
        return ['{"overall_pipeline_health": "%s", "anomaly_groups": [{"anomaly_type": "t", "count": 2}]}' % p for p in prompts]

    prompts = spark.createDataFrame([("2024-01-01", 0, 20, "healthy"), ("2024-01-01", 1, 20, "degraded"), ("2024-01-01", 2, 5, "fail")], "date_part string, batch int, n int, prompt string")
    parsed = me.parse_reports(me.answer(prompts, service))
    assert parsed.filter("NOT parse_ok").count() == 1
    row = me.combine_reports(parsed).first()
    assert (row["pipeline_health"], row["anomaly_count"], row["unread_batches"]) == ("degraded", 45, 1)
    assert json.loads(row["full_report"])["anomaly_groups"][0]["count"] == 4
