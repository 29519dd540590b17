from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline.operators import anomalies as an
from plumbline.operators import health as he
from plumbline.operators.remediate import remediate, remediation_sql
from plumbline.operators.rules import anomalous
from plumbline.plans import jobs
from plumbline.schemas import REPORT_DDL

AS_OF = "2024-01-31 00:00:00"


def test_batches_cover_all_and_are_small(flagged):
    batches = an.analysis_batches(flagged).collect()
    assert max(b["n"] for b in batches) <= 20
    ids = [i for b in batches for i in b["event_ids"]]
    assert sorted(ids, key=str) == sorted((r["event_id"] for r in anomalous(flagged).select("event_id").collect()), key=str)
    assert all(b["event_ids"][0] == b["first_event_id"] and len(b["event_ids"]) == b["n"] for b in batches)


def test_cap_keeps_the_worst_and_the_ledger_yields_the_rest(flagged):
    day = an.of_day(flagged, "2099-01-01")
    found = anomalous(day).count()
    first = an.ranked_by_day(day, 5).select("event_id", "anomaly_score")
    rest = an.not_analyzed(anomalous(day), first)
    every = an.ranked_by_day(day)
    assert sorted(r["rank"] for r in every.select("rank").collect()) == list(range(1, found + 1))
    assert sorted(r[0] for r in every.filter("rank <= 5").select("event_id").collect()) == sorted(r[0] for r in first.select("event_id").collect())
    assert first.count() == 5
    assert rest.count() == found - 5
    assert first.agg(F.min("anomaly_score")).first()[0] >= rest.agg(F.max("anomaly_score")).first()[0]


def test_records_without_id_stay_due(spark):
    rows = spark.createDataFrame([("a",), (None,)], "event_id string")
    assert an.not_analyzed(rows, rows).collect() == [(None,)]


def test_top_is_ordered_and_ties_go_by_id(flagged):
    top = an.top_anomalies(flagged, 10).select("anomaly_score", "event_id").collect()
    assert [(-r[0], r[1] or "") for r in top] == sorted((-r[0], r[1] or "") for r in top)


def test_summary_of_an_empty_day_is_empty(flagged):
    assert an.summary_of_day(flagged, "2030-01-01").isEmpty()
    with pytest.raises(ValueError):
        an.of_day(flagged, "15.01.2024")


def test_labels(spark):
    rows = spark.createDataFrame([("null_user", date(2024, 1, 1)), ("null_user", date(2024, 1, 1)), ("x", date(2024, 1, 2))], "_anomaly_type string, date_part date")
    assert an.summary_by_label(rows, "2024-01-01").collect() == [("null_user", 2)]


def test_report_document(flagged):
    row = an.daily_report(flagged, analyzed_at=AS_OF).filter("run_date = date'2099-01-01'").first()
    report = json.loads(row["full_report"])
    groups = {g["anomaly_type"]: g for g in report["anomaly_groups"]}
    assert groups["future_ts"]["count"] == 13
    assert groups["future_ts"]["business_impact"] == "critical"
    assert len(groups["future_ts"]["example_event_ids"]) == 2
    assert report["overall_pipeline_health"] == row["pipeline_health"] == "degraded"
    assert row["anomaly_count"] == 13


def test_examples_stay_small_and_sorted(flagged):
    rows = an.examples(flagged, n=2).collect()
    for r in rows:
        ids = [x[0] for x in an.by_type(flagged).filter(F.col("anomaly_type") == r["anomaly_type"]).select("event_id").collect()]
        assert r["example_event_ids"] == sorted(i for i in ids if i is not None)[:2]


def test_pattern_counts_agree_between_dimensions(flagged):
    rows = an.patterns(flagged).groupBy("anomaly_type", "dimension").agg(F.sum("n").alias("n"), F.count_if("is_dominant").alias("d")).collect()
    sums = {(r["anomaly_type"], r["dimension"]): r["n"] for r in rows}
    assert all(r["d"] == 1 for r in rows)
    assert all(sums[(t, "country")] == sums[(t, "hour")] for t in an.TYPES)


def test_patterns_by_key_keep_types_apart(flagged):
    keyed = an.patterns(flagged, ["date_part"]).groupBy("anomaly_type").agg(F.sum("n").alias("n")).collect()
    whole = an.patterns(flagged).groupBy("anomaly_type").agg(F.sum("n").alias("n")).collect()
    assert sorted(keyed) == sorted(whole)


def test_remediation_frame_equals_sql(spark, flagged):
    flagged.createOrReplaceTempView("flagged_events")
    by_sql = spark.sql(remediation_sql("flagged_events")).groupBy("action").count().collect()
    fixed = remediate(flagged, AS_OF)
    assert sorted(by_sql) == sorted(fixed.groupBy("action").count().collect())
    assert fixed.filter("action = 'impute' AND fixed_amount < 0").isEmpty()
    assert fixed.filter(f"action = 'impute' AND fixed_event_ts > timestamp'{AS_OF}'").isEmpty()


@pytest.mark.parametrize(("minutes", "status"), [(0, "fresh"), (29, "fresh"), (30, "stale"), (31, "stale"), (1445, "stale"), (None, "stale")])
def test_freshness_edges(spark, minutes, status):
    ts = f"timestamp'{AS_OF}' - make_interval(0, 0, 0, 0, 0, {minutes})" if minutes is not None else "cast(null as timestamp)"
    row = he.freshness({"t": (spark.range(1).select(F.expr(ts).alias("at")), "at")}, AS_OF).first()
    assert (row["age_minutes"], row["freshness_status"]) == (minutes, status)


def test_routes(spark):
    rows = spark.createDataFrame([("critical",), ("degraded",), ("healthy",), ("else",), (None,)], "h string")
    got = [r[0] for r in rows.select(he.route(F.col("h"))).collect()]
    assert got == ["send_critical_alert", "send_degraded_alert", "pipeline_healthy", "pipeline_healthy", "pipeline_healthy"]


def test_daily_job_can_be_repeated(spark, flagged, tmp_path):
    reports = f"{tmp_path}/reports"
    for day in ("2099-01-01", "2024-01-15", "2024-01-15"):
        jobs.analyze_anomalies(flagged, day, reports, analyzed_at=AS_OF)
    assert spark.read.parquet(reports).groupBy("run_date").count().collect() in (
        [(date(2099, 1, 1), 1), (date(2024, 1, 15), 1)], [(date(2024, 1, 15), 1), (date(2099, 1, 1), 1)])
    assert jobs.analyze_anomalies(flagged.filter("NOT is_anomaly"), "2024-01-15", reports).isEmpty()  # a rerun that finds nothing
    assert [r[0] for r in spark.read.parquet(reports).select("run_date").collect()] == [date(2099, 1, 1)]


def test_runs_of_a_day_leave_nothing_due(spark, flagged, tmp_path):
    reports, ledger, day = f"{tmp_path}/reports", f"{tmp_path}/ledger", "2099-01-01"
    found = {r[0] for r in anomalous(an.of_day(flagged, day)).select("event_id").collect()}
    down = True

    def service(prompts):
        if down and "record" in prompts[0]:
            raise RuntimeError("down")
        return ['{"overall_pipeline_health": "healthy", "anomaly_groups": []}' for _ in prompts]

    def run(name, **options):
        return jobs.explain_anomalies(flagged, day, name, service, reports, ledger, size=3, **options).first()

    failed = run("a", cap=5)
    assert (failed["anomaly_count"], failed["unread_batches"], failed["pipeline_health"]) == (5, 2, "unknown")
    assert jobs.read_ledger(spark, ledger).isEmpty()
    down = False
    assert run("b", cap=5)["anomaly_count"] == 5
    assert run("b", cap=5)["anomaly_count"] == 5  # the same run again takes its own records again
    assert run("c")["anomaly_count"] == len(found) - 5
    assert run("d") is None
    seen = [r[0] for r in jobs.read_ledger(spark, ledger).select("event_id").collect()]
    assert sorted(seen) == sorted(found)
    assert spark.read.parquet(reports).filter("run_id IN ('b', 'c')").agg(F.sum("anomaly_count")).first()[0] == len(found)


def test_null_dates_and_times_count(spark):
    rows = [("a", None, "US", None), ("b", None, "US", None), ("c", None, None, None), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "event_id string, event_ts timestamp, country string, date_part date")
    flags = frame.select("*", *[F.lit(t == "null_user").alias(f"flag_{t}") for t in an.TYPES], F.lit(True).alias("is_anomaly"), F.lit(1.0).alias("anomaly_score"))
    assert an.patterns(flags, ["date_part"]).agg(F.sum("n")).first()[0] == 8
    assert an.patterns(flags).filter("dimension = 'hour'").first()["value"] is None
    report = an.daily_report(flags, analyzed_at=AS_OF).first()
    assert json.loads(report["full_report"])["anomaly_groups"][0]["example_event_ids"] == ["a", "b"]
    assert an.of_day(flags, None).count() == 4


def test_day_without_anomalies_has_no_report(spark, flagged, tmp_path):
    assert jobs.analyze_anomalies(flagged, "2031-01-01", f"{tmp_path}/r").isEmpty()


def test_quality_check(flagged, tmp_path):
    check = jobs.check_quality(flagged, "2099-01-01", "transactions", incidents_path=f"{tmp_path}/i", as_of=AS_OF, limit=10)
    assert check.health.first()["pipeline_health"] == "critical"
    assert check.actions.first()["actions"] == [
        "check_freshness", "summarize_anomalies", "collect_table_stats", "prepare_remediation", "open_incident", "report_critical"]
    assert check.incidents.first()["incident_id"] == "INC-20240131000000-20990101-transactions"
    assert check.table_stats.count() > 10
    assert check.remediation.count() == 13
    calm = jobs.check_quality(flagged, "2024-01-15", "transactions", stale_minutes=600)
    assert calm.table_stats is None
    assert calm.incidents is None
    assert calm.health.first()["pipeline_health"] == "healthy"


def test_a_day_without_events_is_stale(flagged):
    check = jobs.check_quality(flagged, "2031-05-05", "transactions", as_of=AS_OF)
    assert check.health.first()["pipeline_health"] == "degraded"
    assert check.incidents.first()["summary"] == "no event for an unknown time on 2031-05-05"


def test_report_columns(spark, flagged):
    wanted = [(f.name, f.dataType) for f in spark.createDataFrame([], REPORT_DDL).schema]
    assert [(f.name, f.dataType) for f in an.daily_report(flagged).schema] == wanted


def test_a_day_in_progress_is_judged_at_the_moment(spark):
    rows = [("2024-05-01 09:59:00", "2024-05-01"), ("2024-04-30 23:50:00", "2024-04-30"), ("2099-01-01 00:00:00", "2099-01-01"), ("2024-05-01 11:00:00", "2024-05-01")]
    frame = spark.createDataFrame(rows, "t string, d string").selectExpr("CAST(t AS timestamp) AS event_ts", "CAST(d AS date) AS date_part", "false AS is_anomaly")
    days = {str(r["date_part"]): (r["age_minutes"], r["is_stale"]) for r in he.health_daily(frame, "2024-05-01 10:00:00").collect()}
    assert days == {"2024-05-01": (1, False), "2024-04-30": (10, False)}
    fresh = he.freshness({"t": (frame, "event_ts")}, "2024-05-01 10:00:00").first()
    assert (fresh["age_minutes"], fresh["freshness_status"]) == (1, "fresh")
    one, two = (he.incidents(he.health_of_day(frame, "2024-05-02", "2024-05-02 10:00:00"), p, "2024-05-02 10:00:00").first() for p in ("a", "b"))
    assert one["incident_id"] != two["incident_id"]
