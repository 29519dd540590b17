"""Scheduled jobs: daily anomaly analysis, schema check, quality check and catalog refresh.

Every job writes the folder of its run date (and run), or a new snapshot, so a repeated run replaces its own output, with nothing
if it finds nothing, and leaves the rest alone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import anomalies as an
from plumbline.operators import catalog as ca
from plumbline.operators import drift as dr
from plumbline.operators import health as he
from plumbline.operators import messages as me
from plumbline.operators import profile as pr
from plumbline.operators import search as se
from plumbline.operators.remediate import remediate
from plumbline.operators.rules import anomalous
from plumbline.schemas import ANALYSIS_BATCH, ANOMALY_LIMIT, STALE_MINUTES, TOP_K
from plumbline.session import as_date, path_exists
from plumbline.sources import snapshots as sn
from plumbline.sources.tables import join_null_safe, materialize


class BreakingSchemaChange(ValueError):
    """The newest version of a table breaks its readers."""


NO_DATE = "__HIVE_DEFAULT_PARTITION__"
LEDGER_DDL = "event_id STRING, run_id STRING"


def _run_folder(path: str, run_date: str | date | None) -> str:
    return f"{path}/run_date={NO_DATE if run_date is None else run_date}"


def _replace(df: DataFrame, folder: str) -> DataFrame:
    """Write one partition folder anew; an empty result empties it."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _replace_run(df: DataFrame, path: str, run_date: str | date | None) -> DataFrame:
    day = F.lit(None).cast("date") if run_date is None else as_date(run_date)
    stored = _replace(df.drop("run_date"), _run_folder(path, run_date))
    return stored.select(day.alias("run_date"), "*")


def analyze_anomalies(flagged: DataFrame, run_date: str | date | None, reports_path: str, *,
                      analyzed_at: str | datetime | Column | None = None) -> DataFrame:
    """Write and return the report row of a day over all of its anomalies (none if the day has no anomalies)."""
    return _replace_run(an.daily_report(an.of_day(flagged, run_date), analyzed_at=analyzed_at), reports_path, run_date)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(event_id, run_id) of all records explained so far."""
    if not path_exists(spark, ledger_path):
        return spark.createDataFrame([], LEDGER_DDL)
    return spark.read.schema(LEDGER_DDL).parquet(ledger_path)


def explain_anomalies(flagged: DataFrame, run_date: str | date | None, run_id: str, fn: Callable[[list[str]], list[str | None]],
                      reports_path: str, ledger_path: str, *, size: int = ANALYSIS_BATCH, cap: int | None = None, prompts_per_call: int = 1,
                      analyzed_at: str | datetime | Column | None = None) -> DataFrame:
    """Send the anomalies of a day that no other run explained to a text service, batch by batch, and write one report of its answers.

    The ledger gets a folder per run, so earlier runs stay; records of batches without a readable answer are not in it and are due
    again. A run of the same name replaces its own report and ledger entries.
    """
    spark = flagged.sparkSession
    taken = read_ledger(spark, ledger_path).filter(F.col("run_id") != run_id)
    due = an.not_analyzed(anomalous(an.of_day(flagged, run_date)), taken)
    ranked = materialize(an.ranked_by_day(due, cap), "ranked")
    answers = me.answer(me.ranked_prompts(ranked, size=size), fn, size=prompts_per_call)
    parsed = materialize(me.parse_reports(answers), "answers")
    report = _replace(me.combine_reports(parsed, analyzed_at).drop("run_date"), f"{_run_folder(reports_path, run_date)}/run_id={run_id}")
    batch = ranked.select("date_part", an.batch_number(size).alias("batch"), "event_id")
    read = join_null_safe(batch, parsed.filter("parse_ok").select("date_part", "batch"), ["date_part", "batch"], "left_semi")
    _replace(read.select("event_id"), f"{ledger_path}/run_id={run_id}")
    return report


def check_schema(versions: DataFrame, key_columns: Sequence[str] = ()) -> DataFrame:
    """Verdicts on the newest change of each table; raises if one is breaking. No row means no drift."""
    verdicts = dr.verdicts(dr.newest_drift(versions), key_columns)
    broken = verdicts.filter("is_breaking_change").orderBy("table_name").select("severity", "stakeholder_message").collect()  # one per table
    if broken:
        raise BreakingSchemaChange("; ".join(f"{r['severity']}: {r['stakeholder_message']}" for r in broken))
    return verdicts


@dataclass(frozen=True)
class QualityCheck:
    """Results of a quality check; frames that no step asked for are None."""

    health: DataFrame
    summary: DataFrame
    actions: DataFrame
    alerts: DataFrame
    table_stats: DataFrame | None
    remediation: DataFrame | None
    incidents: DataFrame | None
    freshness: DataFrame


def check_quality(flagged: DataFrame, run_date: str | date, pipeline: str, *, incidents_path: str | None = None,
                  as_of: str | datetime | Column | None = None, limit: int = ANOMALY_LIMIT,
                  stale_minutes: int = STALE_MINUTES) -> QualityCheck:
    """Freshness and anomaly summary of a day; stats and remediation if it has too many anomalies, an incident if stale."""
    day = an.of_day(flagged, run_date)
    daily = materialize(he.health_of_day(flagged, run_date, as_of, limit=limit, stale_minutes=stale_minutes), "health")
    verdict = daily.first()  # the one row
    over = verdict["is_over"]
    incidents = None
    if verdict["is_stale"]:
        incidents = he.incidents(daily, pipeline, as_of)
        if incidents_path is not None:
            incidents = _replace_run(incidents, incidents_path, run_date)
    return QualityCheck(
        health=daily,
        summary=an.summary_of_day(flagged, run_date),
        actions=he.actions(daily),
        alerts=he.alerts(daily),
        table_stats=pr.null_rates(day, pipeline) if over else None,
        remediation=remediate(anomalous(day), as_of) if over else None,
        incidents=incidents,
        freshness=he.freshness({pipeline: (flagged, "event_ts")}, as_of, stale_minutes=stale_minutes),
    )


def catalog_index_path(catalog_path: str, version: int) -> str:
    return f"{catalog_path}/index/version={version}"


def refresh_catalog(tables: Mapping[str, DataFrame], paths: Mapping[str, str], catalog_path: str, version: int, *,
                    descriptions: Mapping[str, str] | None = None, committed_at: str | datetime | Column | None = None) -> DataFrame:
    """Profile tables, merge them into the catalog published before, index the documents, and publish the result as `version`.

    The snapshot is published last, so a version that can be read has its index.
    """
    new = ca.entries(tables, paths, descriptions=descriptions, version=version)
    spark = new.sparkSession
    old = sn.read_as_of(spark, catalog_path, version - 1) if version > 1 else ca.empty_catalog(spark)
    merged = materialize(ca.upsert(old, new), "catalog")
    se.index_texts(merged, catalog_index_path(catalog_path, version), document_id="table_name", text="document")
    sn.publish(merged, catalog_path, version, committed_at=committed_at, operation="refresh")
    return sn.read_as_of(spark, catalog_path, version)


def ask_catalog(spark: SparkSession, catalog_path: str, questions: DataFrame, *, k: int = TOP_K) -> DataFrame:
    """Tables of the newest catalog version that answer each question (question_id, text), found through its index."""
    version = sn.history(spark, catalog_path, 1).first()["version"]
    index = se.open_index(spark, catalog_index_path(catalog_path, version))
    return se.search_catalog(sn.read_as_of(spark, catalog_path, version), questions, k=k, index=index)
