"""Texts for and from an external text service: one prompt per batch of rows, and typed rows from its answers.

The service itself is not part of the library; a user passes a function that calls it to `answer`.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import embedded_json, is_json, iso_utc
from plumbline.operators.anomalies import batch_number, ranked_by_day, type_names
from plumbline.operators.drift import history
from plumbline.schemas import ANALYSIS_BATCH, ENRICHMENT_BATCH, GROUP_DDL, HISTORY_VERSIONS
from plumbline.session import as_timestamp
from plumbline.sources.tables import join_null_safe

logger = logging.getLogger(__name__)

ANOMALY_TASK = (
    "Explain the data-quality anomalies below. Group them by anomaly_type. Give for every group the ROOT CAUSE, the BUSINESS IMPACT "
    "(low, medium, high, critical), a remediation, example ids, and any pattern across records. Answer with one JSON object holding "
    "anomaly_groups, overall_pipeline_health, executive_summary and recommended_actions."
)
ENRICHMENT_TASK = (
    "Classify the transactions below. Answer with a JSON array holding one object per record, in the same order, with event_id, "
    "fraud_risk, customer_intent, product_category, geo_risk_flag, enrichment_confidence and reasoning."
)
SCHEMA_TASK = (
    "Judge the schema change below. Say whether it is a BREAKING CHANGE and for whom. Answer with one JSON object holding "
    "is_breaking_change, severity, impact_assessment, root_cause_hypothesis, recommended_actions, rollback_sql and stakeholder_message."
)
TABLE_TASK = "Describe the table below for a data catalog in three to five sentences: content, key columns, place in the pipeline, readers."
QUESTION_TASK = "Answer the question from the catalog entries below, naming tables and their paths. Say so if they do not contain the answer."

REPORT_ANSWER_DDL = (
    f"anomaly_groups ARRAY<STRUCT<{', '.join(part.replace(' ', ': ', 1) for part in GROUP_DDL.split(', '))}>>, "
    "overall_pipeline_health STRING, executive_summary STRING, recommended_actions ARRAY<STRING>"
)
ENRICHMENT_ANSWER_DDL = (
    "event_id STRING, fraud_risk STRING, customer_intent STRING, product_category STRING, geo_risk_flag BOOLEAN, "
    "enrichment_confidence DOUBLE, reasoning STRING"
)
VERDICT_DDL = (
    "is_breaking_change BOOLEAN, severity STRING, impact_assessment STRING, root_cause_hypothesis STRING, "
    "recommended_actions ARRAY<STRING>, rollback_sql STRING, stakeholder_message STRING"
)


def _prompt(task: str, *parts: Column) -> Column:
    return F.concat_ws("\n\n", F.lit(task), *parts)


def _record(columns: Sequence[str | Column]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def anomaly_prompts(flagged: DataFrame, *, size: int = ANALYSIS_BATCH, cap: int | None = None) -> DataFrame:
    """One prompt per date and batch of anomalies, worst first; a batch holds at most `size` records."""
    return ranked_prompts(ranked_by_day(flagged, cap), size=size)


def ranked_prompts(ranked: DataFrame, *, size: int = ANALYSIS_BATCH) -> DataFrame:
    """The same for rows that have their `rank` already."""
    record = _record([
        "event_id", "user_id", "product_id", "amount", "currency", "event_type", iso_utc(F.col("event_ts")).alias("timestamp"), "country",
        "payment_method", F.array_join(type_names(), ",").alias("anomaly_type"),
    ])
    rows = ranked.select("date_part", batch_number(size).alias("batch"), "rank", record.alias("record"))
    batches = rows.groupBy("date_part", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("rank", "record"))).alias("members"),
    )
    head = F.concat(F.col("n").cast("string"), F.lit(" records:"))
    return batches.select(
        "date_part", "batch", "n", _prompt(ANOMALY_TASK, head, F.array_join(F.col("members.record"), "\n")).alias("prompt"),
    )


def enrichment_prompts(transactions: DataFrame, columns: Sequence[str], *, size: int = ENRICHMENT_BATCH) -> DataFrame:
    """One prompt per at most `size` neighbouring rows of a partition."""
    batch = F.floor(F.monotonically_increasing_id() / size)
    rows = transactions.select(batch.alias("batch"), _record(columns).alias("record"))
    grouped = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("record")).alias("records"))
    return grouped.select("batch", "n", _prompt(ENRICHMENT_TASK, F.array_join("records", "\n")).alias("prompt"))


def schema_prompts(drifts: DataFrame, versions: DataFrame, n: int = HISTORY_VERSIONS) -> DataFrame:
    """One prompt per drift: the change, then the newest n versions of the table, newest first."""
    known = history(versions, n).groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct("version", "committed_at", "columns")), asc=False).alias("h"))
    change = _record([c for c in drifts.columns if c != "table_name"])
    return drifts.join(known, "table_name").select(
        "table_name", "to_version",
        _prompt(SCHEMA_TASK, F.concat(F.lit("CHANGE: "), change), F.concat(F.lit("VERSIONS: "), F.to_json("h"))).alias("prompt"),
    )


def table_prompts(profiles: DataFrame) -> DataFrame:
    """One prompt per table profile (see `profile.table_profile`)."""
    facts = _record(["table_name", "table_path", "row_count", "column_count", "columns", "sample_values", "stats"])
    return profiles.select("table_name", _prompt(TABLE_TASK, facts).alias("prompt"))


def question_prompts(found: DataFrame) -> DataFrame:
    """One prompt per question over its catalog hits (question_id, question, rank, document)."""
    hits = F.array_sort(F.collect_list(F.struct("rank", "document")))
    grouped = found.groupBy("question_id").agg(F.first("question").alias("question"), hits.alias("hits"))
    return grouped.select(
        "question_id", _prompt(QUESTION_TASK, F.concat(F.lit("QUESTION: "), F.col("question")), F.array_join(F.col("hits.document"), "\n\n")).alias("prompt"),
    )


def answer(prompts: DataFrame, fn: Callable[[list[str]], list[str | None]], *, size: int = 1, prompt: str = "prompt") -> DataFrame:
    """Replace each prompt by the answer (`text`) of a user's function, called in the tasks with at most `size` prompts.

    A failing call gives its prompts a NULL answer, so one bad call does not end the job.
    """
    kept = [c for c in prompts.columns if c != prompt]
    out = T.StructType([*[prompts.schema[c] for c in kept], T.StructField("text", T.StringType())])

    def call(texts: list[str]) -> list[str | None]:
        try:
            answers = fn(texts)
            if len(answers) != len(texts):
                raise ValueError(f"got {len(answers)} answers for {len(texts)} prompts")
            return answers
        except Exception:
            logger.exception("no answer to %d prompts", len(texts))
            return [None] * len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            answers = [a for start in range(0, len(texts), size) for a in call(texts[start:start + size])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(answers, pa.string())], names=out.names)

    return prompts.select(*kept, prompt).mapInArrow(run, out)


def combine_reports(answers: DataFrame, analyzed_at: str | datetime | Column | None = None) -> DataFrame:
    """One report row per date from the parsed answers (date_part, batch, n, and the columns of `parse_reports`).

    Groups of one type are added up, and the worst health of a batch is the health of the date. All batches count: those without a
    readable answer are in `anomaly_count` and `unread_batches`, and a date without any readable answer has an unknown health.
    """
    worst = F.create_map(*[F.lit(x) for pair in [("healthy", 0), ("degraded", 1), ("critical", 2)] for x in pair])
    readable = answers.filter("parse_ok")
    first = F.min_by(F.struct("root_cause", "business_impact", "remediation", "example_event_ids", "pattern_insight"), "batch")
    groups = (
        readable.select("date_part", "batch", F.inline("anomaly_groups"))
        .groupBy("date_part", "anomaly_type").agg(F.sum("count").alias("count"), first.alias("g"))
        .select("date_part", F.struct("anomaly_type", "count", "g.*").alias("g"))
        .groupBy("date_part").agg(F.array_sort(F.collect_list("g")).alias("anomaly_groups"))
    )
    asked = readable.select("date_part", F.explode("recommended_actions").alias("step")).distinct()
    steps = asked.groupBy("date_part").agg(F.array_sort(F.collect_list("step")).alias("recommended_actions"))
    when_read = lambda c: F.when(F.col("parse_ok"), F.col(c))
    days = answers.groupBy("date_part").agg(
        F.sum("n").alias("anomaly_count"),
        F.count_if(~F.col("parse_ok")).alias("unread_batches"),
        F.max_by(when_read("overall_pipeline_health"), F.try_element_at(worst, when_read("overall_pipeline_health"))).alias("overall_pipeline_health"),
        F.min_by(when_read("executive_summary"), F.when(F.col("parse_ok"), F.col("batch"))).alias("executive_summary"),
    )
    joined = join_null_safe(join_null_safe(days, groups, ["date_part"], "left"), steps, ["date_part"], "left")
    document = _record(["anomaly_groups", "overall_pipeline_health", "executive_summary", "recommended_actions", "unread_batches"])
    return joined.select(
        F.col("date_part").alias("run_date"), iso_utc(as_timestamp(analyzed_at)).alias("analyzed_at"), "anomaly_count", "unread_batches",
        F.coalesce("overall_pipeline_health", F.lit("unknown")).alias("pipeline_health"), "executive_summary", document.alias("full_report"),
    )


def parse_objects(answers: DataFrame, ddl: str, *, text: str = "text") -> DataFrame:
    """The JSON object inside each answer as typed columns.

    `parse_ok` is false and the columns are NULL if there is no object, or none of the expected fields in it.
    """
    inner = embedded_json(F.col(text), "object")
    kept = [c for c in answers.columns if c != text]
    fields = T.StructType.fromDDL(ddl).fieldNames()
    return (
        answers.select(*kept, inner.alias("_json"))
        .select(*kept, F.when(is_json(F.col("_json")), F.from_json("_json", ddl)).alias("_answer"))
        .select(*kept, F.coalesce(*[F.col(f"_answer.{f}").isNotNull() | F.lit(None) for f in fields], F.lit(False)).alias("parse_ok"), "_answer.*")
    )


def parse_reports(answers: DataFrame, *, text: str = "text") -> DataFrame:
    return parse_objects(answers, REPORT_ANSWER_DDL, text=text)


def parse_verdicts(answers: DataFrame, *, text: str = "text") -> DataFrame:
    return parse_objects(answers, VERDICT_DDL, text=text)


def parse_enrichments(answers: DataFrame, *, text: str = "text") -> DataFrame:
    """One row per enrichment in the JSON array inside each answer; unreadable answers give no row (see `unreadable`)."""
    inner = embedded_json(F.col(text), "array")
    kept = [c for c in answers.columns if c != text]
    item = f"array<struct<{', '.join(part.replace(' ', ': ', 1) for part in ENRICHMENT_ANSWER_DDL.split(', '))}>>"
    parsed = answers.select(*kept, inner.alias("_json")).filter(is_json(F.col("_json")))
    rows = parsed.select(*kept, F.inline(F.from_json("_json", item)))
    return rows.withColumnRenamed("reasoning", "enrichment_reasoning")


def unreadable(answers: DataFrame, kind: str = "array", *, text: str = "text") -> DataFrame:
    """Answers without a readable JSON part of the given kind."""
    return answers.filter(~is_json(embedded_json(F.col(text), kind)))


