"""Analysis of flagged events: summaries, groups, patterns, batches and the daily report.

Counting never explodes the rows: one conditional count per rule is partially aggregated in the map tasks, and only the
small result is turned into rows. Explosion by type happens on anomalies alone, where single ids are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scalars import iso_utc, lookup, minutes_between, percent, share
from plumbline.operators.remediate import POLICY
from plumbline.operators.rules import anomalous
from plumbline.schemas import ANALYSIS_BATCH, ANOMALY_LIMIT, STALE_MINUTES, TOP_ANOMALIES
from plumbline.session import as_date, as_timestamp
from plumbline.sources.tables import join_null_safe, materialize, number_rows

# The rules of `transaction_rules`, in their order.
TYPES = ["null_user", "extreme_amount", "negative_amount", "invalid_currency", "future_ts", "schema_drift"]

ROOT_CAUSES = {
    "null_user": "producer sent no user id or the message could not be decoded",
    "extreme_amount": "amount is above the accepted limit",
    "negative_amount": "amount is below zero",
    "invalid_currency": "currency is missing or not an accepted code",
    "future_ts": "event time lies after the processing time",
    "schema_drift": "payload keys differ from the expected set",
}

# What the policy does with records of each type.
REMEDIES = {name: " or ".join(action for condition, action in POLICY if f"flag_{name}" in condition) for name in TYPES}

# Upper bounds (exclusive) of an anomaly type's share of all events.
IMPACT_BOUNDS = [(0.01, "low"), (0.05, "medium"), (0.20, "high")]


def type_names() -> Column:
    """The names of the rules an event broke, in fixed order."""
    return F.array_compact(F.array(*[F.when(F.col(f"flag_{name}"), F.lit(name)) for name in TYPES]))


def by_type(flagged: DataFrame) -> DataFrame:
    """One row per anomaly and rule it broke."""
    return anomalous(flagged).select("*", F.explode(type_names()).alias("anomaly_type"))


def of_day(events: DataFrame, run_date: str | date | None) -> DataFrame:
    """The events of one run date, None for those without one; on a table partitioned by `date_part` only that partition is read."""
    return events.filter(F.col("date_part").isNull() if run_date is None else F.col("date_part") == as_date(run_date))


def count_types(flagged: DataFrame, keys: Sequence[str] = (), *extra: Column) -> DataFrame:
    """(keys, anomaly_type, n) with the events and anomalous events of the key alongside; zero counts included."""
    counts = flagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_anomaly").alias("anomalies"),
        *extra,
        *[F.count_if(f"flag_{name}").alias(name) for name in TYPES],
    )
    kept = [c for c in counts.columns if c not in TYPES]
    pairs = F.array(*[F.struct(F.lit(name).alias("anomaly_type"), F.col(name).alias("n")) for name in TYPES])
    return counts.select(*kept, F.inline(pairs))


def summary_by_type(flagged: DataFrame) -> DataFrame:
    """Anomalies per date and type; dates or types without any do not appear."""
    return count_types(flagged, ["date_part"]).filter("n > 0").select("date_part", "anomaly_type", F.col("n").alias("anomaly_count"))


def summary_of_day(flagged: DataFrame, run_date: str | date) -> DataFrame:
    """Breakdown of one day by type with the day's total; empty when the day has no anomalies."""
    counts = count_types(of_day(flagged, run_date), ["date_part"]).filter("n > 0")
    return counts.select("date_part", "anomaly_type", F.col("n").alias("anomaly_count"), F.col("anomalies").alias("total_anomalies"))


def summary_by_label(anomalies: DataFrame, run_date: str | date) -> DataFrame:
    """Breakdown of one day by the label the producer put on the record."""
    return of_day(anomalies, run_date).groupBy(F.col("_anomaly_type").alias("anomaly_type")).agg(F.count(F.lit(1)).alias("anomaly_count"))


def worst_first() -> list[Column]:
    return [F.col("anomaly_score").desc(), F.col("event_id").asc()]


def top_anomalies(flagged: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    """The n highest scores; ties are broken by event id. Each task keeps n rows, so nothing is sorted whole."""
    return anomalous(flagged).orderBy(*worst_first()).limit(n)


def not_analyzed(anomalies: DataFrame, ledger: DataFrame) -> DataFrame:
    """Anomalies whose id is not in the ledger of earlier runs. Records without an id are always due."""
    return anomalies.join(ledger.select("event_id"), "event_id", "left_anti")


def ranked_by_day(flagged: DataFrame, cap: int | None = None) -> DataFrame:
    """All anomalies with their rank within the date, worst first; with `cap` only the worst ones of every date.

    The anomalies are written before they are put in order, as finding the ranges reads them once more. Ranks come from numbers over all dates, so a date that holds most rows is ranked by many tasks. A cap is applied before the
    shuffle (WindowGroupLimit); what exceeds it is due in a later run: see `not_analyzed`.
    """
    found = anomalous(flagged)
    if cap is not None:
        rank = F.row_number().over(Window.partitionBy("date_part").orderBy(*worst_first()))
        return found.select("*", rank.cast("bigint").alias("rank")).filter(F.col("rank") <= cap)
    numbered = number_rows(materialize(found, "anomalies"), ["date_part", *worst_first()], "_at")
    first = numbered.groupBy("date_part").agg(F.min("_at").alias("_first"))
    return join_null_safe(numbered, first, ["date_part"]).withColumn("rank", F.col("_at") - F.col("_first") + 1).drop("_at", "_first")


def batch_number(size: int = ANALYSIS_BATCH) -> Column:
    return F.floor((F.col("rank") - 1) / size).cast("int")


def analysis_batches(flagged: DataFrame, *, size: int = ANALYSIS_BATCH, cap: int | None = None) -> DataFrame:
    """(date, batch) with its size, first and last id, and the ids in rank order. A batch has at most `size` rows."""
    slim = flagged.select("date_part", "event_id", "anomaly_score", "is_anomaly")
    rows = ranked_by_day(slim, cap).select("date_part", batch_number(size).alias("batch"), "rank", "event_id")
    members = F.array_sort(F.collect_list(F.struct("rank", "event_id")))
    batches = rows.groupBy("date_part", "batch").agg(F.count(F.lit(1)).alias("n"), members.alias("members"))
    ids = F.col("members.event_id")
    return batches.select(
        "date_part", "batch", "n",
        F.element_at(ids, 1).alias("first_event_id"), F.element_at(ids, -1).alias("last_event_id"), ids.alias("event_ids"),
    )


def impact(part: Column, whole: Column) -> Column:
    """Business impact from the share of events concerned."""
    ratio = share(part, whole)
    level = F.when(ratio < IMPACT_BOUNDS[0][0], IMPACT_BOUNDS[0][1])
    for bound, name in IMPACT_BOUNDS[1:]:
        level = level.when(ratio < bound, name)
    return level.otherwise("critical")


def examples(flagged: DataFrame, keys: Sequence[str] = (), n: int = 2) -> DataFrame:
    """The n smallest event ids per key and type. Ranks are limited in the map tasks, so a hot type stays small."""
    group = [*keys, "anomaly_type"]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("event_id"))
    rows = by_type(flagged).filter(F.col("event_id").isNotNull()).select(*group, "event_id")
    kept = rows.select("*", rank.alias("rank")).filter(F.col("rank") <= n)
    return kept.groupBy(*group).agg(F.array_sort(F.collect_list("event_id")).alias("example_event_ids"))


def anomaly_groups(flagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key and anomaly type: count, share, cause, impact, remedy and example ids."""
    counts = count_types(flagged, keys).filter("n > 0")
    found = examples(flagged, keys)
    return join_null_safe(counts, found, [*keys, "anomaly_type"], "left").select(
        *keys, "anomaly_type",
        F.col("n").alias("anomaly_count"),
        percent(F.col("n"), F.col("events")).alias("share_pct"),
        lookup(F.col("anomaly_type"), ROOT_CAUSES).alias("root_cause"),
        impact(F.col("n"), F.col("events")).alias("business_impact"),
        lookup(F.col("anomaly_type"), REMEDIES).alias("remediation"),
        "example_event_ids",
    )


def patterns(flagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How each type spreads over countries and hours of day, with the dominant value marked.

    Events are counted once by (country, hour); both dimensions are sums over that small table.
    """
    cells = count_types(
        flagged.select("*", F.date_format("event_ts", "HH").alias("hour_of_day")), [*keys, "country", "hour_of_day"],
    ).filter("n > 0")
    pairs = F.array(
        F.struct(F.lit("country").alias("dimension"), F.col("country").alias("value")),
        F.struct(F.lit("hour").alias("dimension"), F.col("hour_of_day").alias("value")),
    )
    group = [*keys, "anomaly_type", "dimension"]
    counts = cells.select(*keys, "anomaly_type", "n", F.inline(pairs)).groupBy(*group, "value").agg(F.sum("n").alias("n"))
    totals = counts.groupBy(*group).agg(
        F.sum("n").alias("total"), F.min_by("value", F.struct(-F.col("n"), F.col("value").isNull(), F.col("value"))).alias("top_value"),
    )
    joined = join_null_safe(counts, totals, group).select(
        *group, "value", "n", share(F.col("n"), F.col("total")).alias("ratio"), F.col("value").eqNullSafe(F.col("top_value")).alias("is_dominant"),
    )
    insight = F.when(
        F.col("is_dominant") & (F.col("ratio") >= 0.5), F.concat(F.lit("mostly "), F.col("dimension"), F.lit(" "), F.col("value")),
    )
    return joined.select(*group, "value", "n", F.round(F.col("ratio") * 100, 2).alias("share_pct"), "is_dominant", insight.alias("pattern_insight"))


def health(anomalies: Column, age_minutes: Column, *, limit: int = ANOMALY_LIMIT, stale_minutes: int = STALE_MINUTES) -> Column:
    """Too many anomalies and stale → critical; one of the two → degraded; neither → healthy. Unknown age is stale."""
    over = anomalies > limit
    stale = is_stale(age_minutes, stale_minutes)
    return F.when(over & stale, "critical").when(over | stale, "degraded").otherwise("healthy")


def is_stale(age_minutes: Column, stale_minutes: int = STALE_MINUTES) -> Column:
    return F.coalesce(age_minutes >= stale_minutes, F.lit(True))


def last_regular_time() -> Column:
    """The latest event time that does not lie in the future."""
    return F.max(F.when(~F.col("flag_future_ts"), F.col("event_ts"))).alias("last_event_ts")


def minutes_of_silence(ts: Column, as_of: str | datetime | Column | None) -> Column:
    """Minutes from an event time to `as_of`, for a past date to its end."""
    return minutes_between(ts, F.least(F.date_add(F.col("date_part"), 1).cast("timestamp"), as_timestamp(as_of)))


def daily_report(flagged: DataFrame, *, analyzed_at: str | datetime | Column | None = None, limit: int = ANOMALY_LIMIT,
                 stale_minutes: int = STALE_MINUTES) -> DataFrame:
    """One report row per date over all of its anomalies; dates without anomalies have no report.

    Counts, the dominant country and the last event time come from one aggregation by (date, country).
    """
    cells = count_types(flagged, ["date_part", "country"], last_regular_time())
    groups = cells.groupBy("date_part", "anomaly_type").agg(
        F.sum("n").alias("count"),
        F.sum("events").alias("events"),
        F.sum("anomalies").alias("anomalies"),
        F.max("last_event_ts").alias("last_event_ts"),
        F.max("n").alias("top_n"),
        F.min_by("country", F.struct(-F.col("n"), F.col("country").isNull(), F.col("country"))).alias("top_country"),
    ).filter("count > 0")
    insight = F.when(F.col("top_n") * 2 >= F.col("count"), F.concat(F.lit("mostly country "), F.col("top_country")))
    described = join_null_safe(groups, examples(flagged, ["date_part"]), ["date_part", "anomaly_type"], "left").select(
        "date_part", "events", "anomalies", "last_event_ts", "count", "anomaly_type",
        F.struct(
            "anomaly_type", "count",
            lookup(F.col("anomaly_type"), ROOT_CAUSES).alias("root_cause"),
            impact(F.col("count"), F.col("events")).alias("business_impact"),
            lookup(F.col("anomaly_type"), REMEDIES).alias("remediation"),
            "example_event_ids",
            insight.alias("pattern_insight"),
        ).alias("grp"),
    )
    days = described.groupBy("date_part").agg(
        F.max("events").alias("events"),
        F.max("anomalies").alias("anomalies"),
        F.max("last_event_ts").alias("last_event_ts"),
        F.min_by("anomaly_type", F.struct(-F.col("count"), F.col("anomaly_type"))).alias("top_type"),
        F.array_sort(F.collect_list("grp")).alias("anomaly_groups"),  # at most one entry per type
    )
    age = minutes_of_silence(F.col("last_event_ts"), analyzed_at)
    summary = F.concat(
        F.col("anomalies").cast("string"), F.lit(" of "), F.col("events").cast("string"),
        F.lit(" events are anomalous; most frequent: "), F.col("top_type"), F.lit("."),
    )
    parts = days.select(
        "date_part", "anomalies", "anomaly_groups",
        health(F.col("anomalies"), age, limit=limit, stale_minutes=stale_minutes).alias("overall_pipeline_health"),
        summary.alias("executive_summary"),
        F.array_sort(F.array_distinct(F.col("anomaly_groups.remediation"))).alias("recommended_actions"),
    )
    document = F.to_json(
        F.struct("anomaly_groups", "overall_pipeline_health", "executive_summary", "recommended_actions"), {"ignoreNullFields": "false"},
    )
    return parts.select(
        F.col("date_part").alias("run_date"),
        iso_utc(as_timestamp(analyzed_at)).alias("analyzed_at"),
        F.col("anomalies").alias("anomaly_count"),
        F.col("overall_pipeline_health").alias("pipeline_health"),
        "executive_summary",
        document.alias("full_report"),
    )
