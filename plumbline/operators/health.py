"""Pipeline health: freshness, daily verdicts, incidents, action lists and alert routes."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import iso_utc, minutes_between
from plumbline.operators.anomalies import health, is_stale, minutes_of_silence, of_day
from plumbline.schemas import (
    ANOMALY_LIMIT,
    INCIDENT_ASSIGNEE,
    INCIDENT_SEVERITY,
    INCIDENT_STATUS,
    STALE_MINUTES,
)
from plumbline.session import as_date, as_timestamp

# Names of the alert branches.
ROUTES = {"critical": "send_critical_alert", "degraded": "send_degraded_alert"}
ROUTE_HEALTHY = "pipeline_healthy"


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: str | datetime | Column | None = None, *,
              stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """Age of every table from the latest value of its time column that is not after `as_of`.

    `tables` maps a name to (frame, column). For the age by commit pass a table's history and its `committed_at`.
    """
    times = {name: F.col(column).cast("timestamp") for name, (_, column) in tables.items()}
    rows = [
        df.agg(F.max(F.when(times[name] <= as_timestamp(as_of), times[name])).alias("last_updated"))
        .select(F.lit(name).alias("table_name"), "last_updated")
        for name, (df, _) in tables.items()
    ]
    age = minutes_between(F.col("last_updated"), as_timestamp(as_of))
    status = F.when(is_stale(F.col("age_minutes"), stale_minutes), "stale").otherwise("fresh")
    aged = reduce(DataFrame.unionByName, rows).select("*", age.alias("age_minutes"))
    return aged.select("*", status.alias("freshness_status"))


def _measures(as_of: str | datetime | Column | None) -> list[Column]:
    seen = F.max(F.when(F.col("event_ts") <= as_timestamp(as_of), F.col("event_ts")))
    return [F.count_if("is_anomaly").alias("anomaly_count"), seen.alias("last_event_ts")]


def _judge(days: DataFrame, as_of: str | datetime | Column | None, limit: int, stale_minutes: int) -> DataFrame:
    aged = days.select("*", minutes_of_silence(F.col("last_event_ts"), as_of).alias("age_minutes"))
    return aged.select(
        "*",
        (F.col("anomaly_count") > limit).alias("is_over"),
        is_stale(F.col("age_minutes"), stale_minutes).alias("is_stale"),
        health(F.col("anomaly_count"), F.col("age_minutes"), limit=limit, stale_minutes=stale_minutes).alias("pipeline_health"),
    )


def health_daily(flagged: DataFrame, as_of: str | datetime | Column | None = None, *, limit: int = ANOMALY_LIMIT,
                 stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """Per date: anomalies, time of the last event not after `as_of`, minutes from it to `as_of`, and the verdict.

    The age of a past date is taken to its end. Dates after `as_of` have no verdict; events without a date have an unknown age.
    """
    known = flagged.filter(F.coalesce(F.col("date_part") <= F.to_date(as_timestamp(as_of)), F.lit(True)))
    return _judge(known.groupBy("date_part").agg(*_measures(as_of)), as_of, limit, stale_minutes)


def health_of_day(flagged: DataFrame, run_date: str | date, as_of: str | datetime | Column | None = None, *, limit: int = ANOMALY_LIMIT,
                  stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """The same for one date; always one row, so that a date without any event shows as stale."""
    measured = of_day(flagged, run_date).agg(*_measures(as_of))
    return _judge(measured.select(as_date(run_date).alias("date_part"), "*"), as_of, limit, stale_minutes)


def incidents(daily: DataFrame, pipeline: str, created_at: str | datetime | Column | None = None) -> DataFrame:
    """One open incident per stale date. Date and pipeline are part of the id, so ids of one second do not collide."""
    created = as_timestamp(created_at)
    day = F.coalesce(F.date_format("date_part", "yyyyMMdd"), F.lit("undated"))
    age = F.coalesce(F.concat(F.col("age_minutes").cast("string"), F.lit(" minutes")), F.lit("an unknown time"))
    return daily.filter("is_stale").select(
        F.concat_ws("-", F.lit("INC"), F.date_format(created, "yyyyMMddHHmmss"), day, F.lit(pipeline)).alias("incident_id"),
        iso_utc(created).alias("created_at"),
        F.lit(INCIDENT_SEVERITY).alias("severity"),
        F.concat(F.lit("no event for "), age, F.lit(" on "), F.coalesce(F.col("date_part").cast("string"), F.lit("an unknown date"))).alias("summary"),
        F.lit(INCIDENT_ASSIGNEE).alias("assigned_to"),
        F.lit(INCIDENT_STATUS).alias("status"),
        F.lit(pipeline).alias("pipeline"),
    )


def actions(daily: DataFrame) -> DataFrame:
    """The ordered steps of a quality check per date."""
    steps = F.array_compact(F.array(
        F.lit("check_freshness"),
        F.lit("summarize_anomalies"),
        F.when(F.col("is_over"), "collect_table_stats"),
        F.when(F.col("is_over"), "prepare_remediation"),
        F.when(F.col("is_stale"), "open_incident"),
        F.concat(F.lit("report_"), F.col("pipeline_health")),
    ))
    return daily.select("date_part", "anomaly_count", "age_minutes", "pipeline_health", steps.alias("actions"))


def route(verdict: Column) -> Column:
    """The alert branch of a verdict; anything unknown counts as healthy."""
    chosen = F.lit(ROUTE_HEALTHY)
    for name, target in ROUTES.items():
        chosen = F.when(verdict == name, target).otherwise(chosen)
    return chosen


def alerts(daily: DataFrame) -> DataFrame:
    chosen = route(F.col("pipeline_health"))
    text = F.concat(
        F.lit("["), F.upper("pipeline_health"), F.lit("] "), F.coalesce(F.col("date_part").cast("string"), F.lit("undated")), F.lit(": "),
        F.col("anomaly_count").cast("string"), F.lit(" anomalies"),
    )
    return daily.select("date_part", "pipeline_health", chosen.alias("route"), F.when(chosen != ROUTE_HEALTHY, text).alias("alert_text"))
