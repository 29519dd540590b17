"""The whole way of a user: stream, report, quality check, catalog, search, schema check."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline import cli
from plumbline.plans import jobs
from plumbline.plans.transactions import load_transactions, messages
from plumbline.session import drop_work
from plumbline.sources import snapshots as sn
from plumbline.sources.tables import append, materialize
from plumbline.streaming import batches
from tests.conftest import DATA


def test_end_to_end(spark, tmp_path):
    events, catalog = f"{tmp_path}/events", f"{tmp_path}/catalog"
    messages(load_transactions(spark, DATA)).write.text(f"{tmp_path}/in")
    cli.run(spark, ["stream", "--format", "text", "--source", f"{tmp_path}/in", "--events", events, "--checkpoint", f"{tmp_path}/cp", "--trigger", "once"])
    assert spark.read.parquet(events).count() == 1000

    report = cli.run(spark, ["analyze", "--events", events, "--date", "2024-01-15", "--reports", f"{tmp_path}/reports"]).collect()
    assert [r["pipeline_health"] for r in report] == ["healthy"] or report[0]["anomaly_count"] == 2
    actions = cli.run(spark, ["quality", "--events", events, "--date", "2024-01-15", "--incidents", f"{tmp_path}/i"]).first()
    assert actions["actions"][:2] == ["check_freshness", "summarize_anomalies"]

    listed = cli.run(spark, ["catalog", "--table", f"events={events}", "--table", f"reports={tmp_path}/reports", "--catalog", catalog, "--version", "1"])
    assert {r["table_name"]: r["row_count"] for r in listed.collect()} == {"events": 1000, "reports": 1}
    assert cli.run(spark, ["tables", "--catalog", catalog]).count() == 2
    assert cli.run(spark, ["tables", "--catalog", catalog, "--name", "reports"]).first()["row_count"] == 1
    hits = cli.run(spark, ["search", "--catalog", catalog, "--question", "executive summary", "--top-k", "1"]).collect()
    assert [r["table_name"] for r in hits] == ["reports"]


def test_two_tables_compaction_and_profile(spark, tmp_path):
    clean, bad = f"{tmp_path}/clean", f"{tmp_path}/bad"
    for part in range(2):
        rows = messages(load_transactions(spark, DATA).filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part))
        rows.coalesce(1).write.mode("append").text(f"{tmp_path}/in")
        cli.run(spark, ["stream", "--format", "text", "--source", f"{tmp_path}/in", "--clean-and-anomalies", clean, bad, "--checkpoint", f"{tmp_path}/cp", "--trigger", "once"])
    assert cli.run(spark, ["compact", "--table", clean, "--drop"]).first()[1:] == (2, 2)
    assert (batches.read_batches(spark, clean).count(), batches.read_batches(spark, bad).count()) == (892, 108)
    append(batches.read_batches(spark, bad), f"{tmp_path}/days", partition_by=["date_part"])
    found = cli.run(spark, ["profile", "--table", f"anomalies={tmp_path}/days", "--profile", f"{tmp_path}/profile"])
    assert {r["column_name"]: r["row_count"] for r in found.collect()}["amount"] == 108


def test_schema_command_fails_on_a_breaking_change(spark, tmp_path):
    path = f"{tmp_path}/s"
    sn.publish(spark.range(2).selectExpr("id", "id AS user_id"), path, 1)
    sn.publish(spark.range(2).selectExpr("id", "id AS user_id", "1 AS more"), path, 2)
    assert cli.run(spark, ["schema", "--snapshots", path, "--name", "t", "--key", "user_id"]).first()["severity"] == "low"
    sn.publish(spark.range(2).selectExpr("id", "1 AS more"), path, 3)
    with pytest.raises(jobs.BreakingSchemaChange, match="critical"):
        cli.run(spark, ["schema", "--snapshots", path, "--name", "t", "--key", "user_id"])


def test_work_tables_can_be_dropped(spark):
    stored = materialize(spark.range(5), "gone")
    files = stored.inputFiles()
    assert stored.count() == 5
    assert drop_work(spark)
    with pytest.raises(Exception, match="does not exist|PATH_NOT_FOUND"):
        spark.read.parquet(files[0]).count()
