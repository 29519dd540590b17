"""The registered queries: every operator applied to whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import anomalies as an
from plumbline.operators import catalog as ca
from plumbline.operators import clusters as cl
from plumbline.operators import dense as de
from plumbline.operators import drift as dr
from plumbline.operators import enrich as en
from plumbline.operators import health as he
from plumbline.operators import messages as me
from plumbline.operators import paths as pa
from plumbline.operators import profile as pr
from plumbline.operators import refresh as re
from plumbline.operators import search as se
from plumbline.operators import vector_index as vi
from plumbline.operators.remediate import remediate
from plumbline.operators.rules import Rule, anomalous, apply_rules, clean
from plumbline.plans.examples import enrich_frame, evolving_messages, explain_batches, nested_messages, service_answers
from plumbline.plans.transactions import AS_OF, load_decoded, load_flagged, load_transactions, messages, project
from plumbline.session import new_work_path
from plumbline.sources import snapshots as sn
from plumbline.sources.events import decode, drop_repeats, read_messages
from plumbline.sources.tables import append, materialize, merge_rows, read_table
from plumbline.streaming import batches, split, watch

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = "2024-01-15"
FLAGS = [f"flag_{name}" for name in an.TYPES]
# A moment inside a day: earlier dates are judged at their end, this one at the moment, later ones not at all.
HEALTH_AS_OF = "2024-01-30 12:00:00"
# With the default limits no date of the small tables is over or stale; these reach every branch.
HEALTH_LIMITS = {"limit": 20, "stale_minutes": 10}


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The analysis columns of the flagged events as a table, for queries that read them more than once."""
    columns = ["event_id", "date_part", "country", "event_ts", *FLAGS, "is_anomaly", "anomaly_score"]
    return materialize(load_flagged(spark, sf).select(*columns), "flagged")


def decode_events(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["event_id", "user_id", "product_id", "amount", "currency", "event_type", "event_ts", "country", "payment_method", "date_part"]
    return load_decoded(spark, sf).select(*columns, "ingest_ts", "malformed", F.length("raw_value").alias("raw_chars"))


def payload_key_drift(spark: SparkSession, sf: str) -> DataFrame:
    drifted = load_decoded(spark, sf).filter((F.size("unexpected_keys") > 0) | (F.size("missing_keys") > 0))
    return drifted.select(
        "event_id", F.array_join("unexpected_keys", ",").alias("unexpected"), F.array_join("missing_keys", ",").alias("missing"),
    )


def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    return load_flagged(spark, sf).select("event_id", *FLAGS, "is_anomaly", "anomaly_score")


def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    return clean(load_flagged(spark, sf)).select("event_id", "user_id", "amount", "currency", "date_part")


def anomaly_events(spark: SparkSession, sf: str) -> DataFrame:
    return anomalous(load_flagged(spark, sf)).select("event_id", "user_id", "amount", "currency", "date_part", "anomaly_score")


def rules_on_customer(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        Rule("negative_balance", "c_acctbal < 0"),
        Rule("high_balance", "c_acctbal > 9000", weight=0.5),
        Rule("unknown_segment", "c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')", on_null=True),
    ]
    flagged = apply_rules(read_table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), rules)
    return flagged.select("c_custkey", *[f"flag_{r.name}" for r in rules], "is_anomaly", "anomaly_score")


def rules_on_orders(spark: SparkSession, sf: str) -> DataFrame:
    customers = read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    rules = [
        Rule("large_order", "o_totalprice > 400000"),
        Rule("late_order", "o_orderdate > timestamp'2001-01-01 00:00:00'"),
        Rule("customer_in_debt", "c_acctbal < 0"),
    ]
    flagged = apply_rules(joined, rules)
    counts = flagged.agg(*[F.count_if(f"flag_{r.name}").alias(r.name) for r in rules], F.count_if("is_anomaly").alias("any_rule"))
    pairs = [F.struct(F.lit(c).alias("rule"), F.col(c).alias("n")) for c in counts.columns]
    return counts.select(F.inline(F.array(*pairs)))


def remediated_events(spark: SparkSession, sf: str) -> DataFrame:
    fixed = remediate(load_flagged(spark, sf), AS_OF)
    return fixed.select("event_id", "action", "fixed_amount", "fixed_event_ts")


def anomaly_summary_day(spark: SparkSession, sf: str) -> DataFrame:
    return an.summary_of_day(load_flagged(spark, sf), RUN_DATE)


def anomaly_summary_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return an.summary_by_type(load_flagged(spark, sf))


def anomaly_summary_by_label(spark: SparkSession, sf: str) -> DataFrame:
    """Breakdown of a day by producer label; the label of a record is the first rule it breaks."""
    label = F.element_at(F.concat(an.type_names(), F.array(F.lit("none"))), 1)
    labelled = anomalous(load_flagged(spark, sf)).withColumn("_anomaly_type", label)
    return an.summary_by_label(labelled, RUN_DATE)


def distinct_events(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of which the refunds were delivered twice, each event kept once."""
    transactions = load_transactions(spark, sf)
    delivered = messages(transactions).unionByName(messages(transactions.filter(F.col("event_type") == "refund")))
    return drop_repeats(decode(delivered, ingest_ts=AS_OF)).select("event_id", "event_type", "amount")


def top_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return an.top_anomalies(load_flagged(spark, sf)).select("event_id", "anomaly_score", "date_part")


def unanalyzed_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger holds what the daily runs up to RUN_DATE took: all anomalies of these dates."""
    found = materialize(anomalous(load_flagged(spark, sf)).select("event_id", "date_part", "anomaly_score"), "anomalies")
    ledger = found.filter(F.col("date_part") <= F.to_date(F.lit(RUN_DATE))).select("event_id")
    return an.not_analyzed(found, ledger).select("event_id", "date_part", "anomaly_score")


def anomaly_batches(spark: SparkSession, sf: str) -> DataFrame:
    return an.analysis_batches(load_flagged(spark, sf)).drop("event_ids")


def anomaly_groups(spark: SparkSession, sf: str) -> DataFrame:
    groups = an.anomaly_groups(_stored(spark, sf))
    return groups.withColumn("example_event_ids", F.array_join("example_event_ids", ","))


def anomaly_patterns(spark: SparkSession, sf: str) -> DataFrame:
    return an.patterns(load_flagged(spark, sf))


def anomaly_bursts(spark: SparkSession, sf: str) -> DataFrame:
    return cl.bursts(an.by_type(load_flagged(spark, sf)))


def anomaly_itemsets(spark: SparkSession, sf: str) -> DataFrame:
    found = anomalous(load_flagged(spark, sf)).withColumns({"types": an.type_names(), "hour": F.date_format("event_ts", "HH")})
    return cl.itemsets(found, ["country", "payment_method", "hour"], support=0.02, several="types")


def anomaly_report_daily(spark: SparkSession, sf: str) -> DataFrame:
    return an.daily_report(_stored(spark, sf), analyzed_at=AS_OF)


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "events": (read_table(spark, sf, "events"), "ts"),
        "orders": (read_table(spark, sf, "orders"), "o_orderdate"),
        "lineitem": (read_table(spark, sf, "lineitem"), "l_shipdate"),
        "transactions": (load_transactions(spark, sf), "event_ts"),  # with events dated in the future
    }
    return he.freshness(tables, AS_OF)


def freshness_by_commit(spark: SparkSession, sf: str) -> DataFrame:
    """Age of the snapshots of orders by their last commit before a moment between two commits."""
    return he.freshness({"orders": (sn.history(spark, _snapshots(spark, sf)), "committed_at")}, "2024-01-01 00:20:00")


def health_daily(spark: SparkSession, sf: str) -> DataFrame:
    return he.health_daily(load_flagged(spark, sf), HEALTH_AS_OF, **HEALTH_LIMITS)


def incidents(spark: SparkSession, sf: str) -> DataFrame:
    return he.incidents(health_daily(spark, sf), "transactions", AS_OF)


def dq_actions(spark: SparkSession, sf: str) -> DataFrame:
    return he.actions(health_daily(spark, sf)).withColumn("actions", F.array_join("actions", ","))


def alert_routing(spark: SparkSession, sf: str) -> DataFrame:
    return he.alerts(health_daily(spark, sf))


def stream_split(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream, split into both sides; rows per side and date of the tables written."""
    schema = read_table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")  # one file or a folder of files
    target = new_work_path(spark, "stream-split")
    flagged = split.flagged_stream(messages(project(source)), as_of=AS_OF)
    query = split.split_once(flagged, f"{target}/table", f"{target}/checkpoint", trigger=None)
    query.awaitTermination()
    sides = [split.read_side(spark, f"{target}/table", side).select(F.lit(side).alias("side"), "date_part") for side in (split.CLEAN, split.ANOMALIES)]
    return sides[0].unionByName(sides[1]).groupBy("side", "date_part").agg(F.count(F.lit(1)).alias("n"))


def _per_side_and_date(tables: dict[str, DataFrame]) -> DataFrame:
    sides = [table.select(F.lit(side).alias("side"), "date_part") for side, table in tables.items()]
    return sides[0].unionByName(sides[1]).groupBy("side", "date_part").agg(F.count(F.lit(1)).alias("n"))


def stream_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables from one query, each batch computed once and written once to either table."""
    schema = read_table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    target = new_work_path(spark, "stream-two-tables")
    flagged = split.flagged_stream(messages(project(source)), as_of=AS_OF)
    paths = {side: f"{target}/{side}" for side in (split.CLEAN, split.ANOMALIES)}
    batches.split_by_batch(flagged, *paths.values(), f"{target}/checkpoint", trigger=None).awaitTermination()
    return _per_side_and_date({side: batches.read_batches(spark, path, flagged.schema) for side, path in paths.items()})


def _message_files(spark: SparkSession, sf: str, files: int) -> DataFrame:
    """The messages of all events as a stream of text files, a file for each micro-batch."""
    path = new_work_path(spark, "messages")
    messages(load_transactions(spark, sf)).repartition(files).write.text(path)
    return read_messages(spark, "text", path=path, options={"maxFilesPerTrigger": "1"})


def stream_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per side and date of tables that six micro-batches wrote and a compaction gathered."""
    target = new_work_path(spark, "stream-compacted")
    flagged = split.flagged_stream(_message_files(spark, sf, 6), as_of=AS_OF)
    paths = {side: f"{target}/{side}" for side in (split.CLEAN, split.ANOMALIES)}
    batches.split_by_batch(flagged, *paths.values(), f"{target}/checkpoint", trigger=None).awaitTermination()
    for path in paths.values():
        batches.compact(spark, path)
        batches.drop_covered(spark, path)
    return _per_side_and_date({side: batches.read_batches(spark, path, flagged.schema) for side, path in paths.items()})


def stream_latency(spark: SparkSession, sf: str) -> DataFrame:
    """For each micro-batch, how long its oldest message waited until it was in its table."""
    target = new_work_path(spark, "stream-latency")
    arriving = watch.observe_arrivals(_message_files(spark, sf, 3), "_metadata.file_modification_time")
    flagged = watch.observe_verdicts(split.flagged_stream(arriving, as_of=AS_OF))
    times = watch.BatchTimes()
    spark.streams.addListener(times)
    try:
        query = split.split_once(flagged, f"{target}/table", f"{target}/checkpoint", trigger=None)
        watch.wait_for_all([query])
        times.settle(query)
    finally:
        spark.streams.removeListener(times)
    return times.table(spark).select("batch", "n_messages", "n_anomalies", "batch_seconds", "latency_seconds")


def stream_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """A stream in which refunds are delivered twice, each event kept once within the watermark."""
    schema = read_table(spark, sf, "events").schema
    rows = project(spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*"))
    twice = F.explode(F.sequence(F.lit(1), F.when(F.col("event_type") == "refund", 2).otherwise(1)))
    once = drop_repeats(decode(messages(rows.select("*", twice)), ingest_ts=AS_OF), watermark="1 hour")
    target = new_work_path(spark, "stream-distinct")
    split.write_sink(once, f"{target}/table", f"{target}/checkpoint", trigger=None).awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{target}/table").select("event_id", "event_type", "amount")


ENRICHED = ["event_id", *[name for name, _, _ in en.ENRICHMENT_DEFAULTS]]


def enrich_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return en.enrich(load_transactions(spark, sf)).select(*ENRICHED)


def enrich_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    inputs = load_transactions(spark, sf).select("event_id", "product_id", "amount", "currency", "event_type", "country", "payment_method")
    return en.enrich_partitions(inputs, enrich_frame, batch_size=2000, on_error="raise").select(*ENRICHED)


def enrich_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Two rounds of enrichments for overlapping parts of the events; the second round wins, the rest gets defaults."""
    records = load_transactions(spark, sf).select("event_id", "amount", "event_type")
    given = en.enrich(load_transactions(spark, sf))
    first = F.when(F.col("event_type") == "purchase", F.struct(F.lit(1).alias("round"), F.col("enrichment_reasoning")))
    second = F.when(F.col("payment_method") == "crypto", F.struct(F.lit(2).alias("round"), F.lit("second round").alias("enrichment_reasoning")))
    others = [c for c in ENRICHED if c != "enrichment_reasoning"]
    return en.merge_enrichments(records, given.select(*others, F.inline(F.array_compact(F.array(first, second)))), "round")


def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    transactions = load_transactions(spark, sf).drop("drifted", "defect")
    tables = {"transactions": transactions, "documents": read_table(spark, sf, "documents"), "orders": read_table(spark, sf, "orders")}
    return pr.over_tables(pr.null_rates, tables)


def numeric_profile(spark: SparkSession, sf: str) -> DataFrame:
    return pr.over_tables(pr.numeric_profile, {t: read_table(spark, sf, t) for t in ("orders", "lineitem", "events", "part")})


def sample_values(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"part": "p_partkey", "nation": "n_nationkey"}
    samples = pr.over_tables(lambda df, t: pr.sample_values(df, t, keys[t]), {t: read_table(spark, sf, t) for t in keys})
    return samples.withColumn("samples", F.array_join("samples", ","))


TABLES = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders", "pages",
    "part", "region", "supplier",
]


def _catalog(spark: SparkSession, sf: str, tables: list[str] = TABLES, **options) -> DataFrame:
    return ca.entries({t: read_table(spark, sf, t) for t in tables}, {t: f"warehouse/{t}" for t in tables}, **options)


def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    return ca.list_tables(_catalog(spark, sf))


def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    return pr.over_tables(pr.described_columns, {t: read_table(spark, sf, t) for t in TABLES})


def catalog_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _catalog(spark, sf).select("table_name", "document")


def catalog_describe(spark: SparkSession, sf: str) -> DataFrame:
    found = ca.describe(_catalog(spark, sf), "orders")
    return found.select("table_name", "table_path", "row_count", F.array_join("columns.name", ",").alias("column_names"), "description")


def catalog_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the events by day, refreshed after each half of the month was added."""
    target = new_work_path(spark, "profiles")
    events = read_table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    early = F.col("day") < F.to_date(F.lit(RUN_DATE))
    for half in (early, ~early):
        append(events.filter(half), f"{target}/table", partition_by=["day"])
        re.refresh(spark.read.parquet(f"{target}/table"), f"{target}/profile", by="day", key="event_id")
    return re.profile(spark, f"{target}/profile", "events").withColumn("samples", F.array_join("samples", ","))


def catalog_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A first catalog of the business tables, then a later run over all tables that share a name with it and the others."""
    old = _catalog(spark, sf, ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"])
    later = [t for t in TABLES if t not in ("nation", "region")]
    new = _catalog(spark, sf, later, version=2, descriptions={"orders": "One row per order."})
    return ca.upsert(old, new).select("table_name", "row_count", "description", "version")


QUESTIONS = [
    (1, "Which table holds the price of an order?"),
    (2, "customer name, nation key and account balance"),
    (3, "Where are the embedding vectors and their label?"),
    (4, "tables with text of documents, pages or conversations"),
]


def catalog_search(spark: SparkSession, sf: str) -> DataFrame:
    """Questions answered from the catalog of all tables."""
    questions = spark.createDataFrame(QUESTIONS, "question_id int, text string")
    found = se.search_catalog(materialize(_catalog(spark, sf), "catalog"), questions)
    return found.select("question_id", "rank", "table_name", "table_path", "row_count", "relevance_score")


def _vector_questions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    vectors = read_table(spark, sf, "embeddings")
    return se.centroids(vectors, "label", "embedding"), vectors


def vector_topk_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors nearest to the mean vector of each label."""
    questions, vectors = _vector_questions(spark, sf)
    hits = se.nearest(questions, vectors, question_id="label", document_id="vec_id", vector="embedding")
    return hits.select("question_id", "document_id", "rank", F.round("score", 4).alias("relevance"))


def vector_topk_l2(spark: SparkSession, sf: str) -> DataFrame:
    questions, vectors = _vector_questions(spark, sf)
    hits = se.nearest(questions, vectors, metric="l2", question_id="label", document_id="vec_id", vector="embedding")
    return hits.select("question_id", "document_id", "rank", F.round(-F.col("score"), 4).alias("distance"))


def vector_topk_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The same questions asked of an approximate index."""
    questions, vectors = _vector_questions(spark, sf)
    index = vi.build(vectors, new_work_path(spark, "vector-index"), document_id="vec_id", vector="embedding")
    hits = vi.search(index, questions, question_id="label", vector="embedding")
    return hits.select("question_id", "document_id", "rank", F.round("score", 4).alias("relevance"))


def text_topk_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    hits = se.tfidf_top_k(
        read_table(spark, sf, "benchmark"), read_table(spark, sf, "documents"), question_id="item_id", document_id="doc_id",
    )
    return hits.select("question_id", "document_id", "rank", F.round("score", 4).alias("relevance"))


def document_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Dense vectors of all documents."""
    vectors, _ = de.document_vectors(read_table(spark, sf, "documents"), document_id="doc_id")
    return vectors.select("document_id", F.size("vector").alias("numbers"), F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    return dr.observed_versions(evolving_messages(read_table(spark, sf, "events")), "payloads")


def schema_history(spark: SparkSession, sf: str) -> DataFrame:
    versions = dr.history(_versions(spark, sf))
    return versions.select("version", "committed_at", "record_count", F.inline("columns")).withColumnRenamed("name", "column_name")


def schema_drift_pair(spark: SparkSession, sf: str) -> DataFrame:
    return dr.change_rows(dr.newest_drift(_versions(spark, sf))).drop("table_name")


def schema_drift_history(spark: SparkSession, sf: str) -> DataFrame:
    return dr.change_rows(dr.changes(_versions(spark, sf))).drop("table_name")


def schema_drift_severity(spark: SparkSession, sf: str) -> DataFrame:
    found = dr.verdicts(dr.drift(_versions(spark, sf)), key_columns=["event_id", "user_id"])
    return found.select(
        "from_version", "to_version", "is_breaking_change", "severity", "root_cause_hypothesis",
        F.array_join("recommended_actions", "; ").alias("recommended_actions"), "rollback_sql",
    )


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    return pa.observed_paths(nested_messages(read_table(spark, sf, "events")), "payloads")


def schema_paths(spark: SparkSession, sf: str) -> DataFrame:
    return pa.newest_versions(materialize(_paths(spark, sf), "paths")).drop("table_name")


def schema_path_changes(spark: SparkSession, sf: str) -> DataFrame:
    return pa.path_changes(materialize(_paths(spark, sf), "paths")).drop("table_name")


def schema_path_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    changes = pa.path_changes(materialize(_paths(spark, sf), "paths"))
    return pa.path_verdicts(changes, ["event_id", "user.id"]).drop("table_name")


def schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Events before mid-month as an older generation without `payment_method`, later ones with it."""
    rows = load_transactions(spark, sf).select("event_id", "amount", "payment_method", F.to_date("event_ts").alias("date_part"))
    early = F.coalesce(F.col("date_part") < F.to_date(F.lit(RUN_DATE)), F.lit(False))
    return merge_rows(rows.filter(early).drop("payment_method"), rows.filter(~early))


def _snapshots(spark: SparkSession, sf: str) -> str:
    """Orders published twice: those before 2000, then all."""
    path = new_work_path(spark, "snapshots")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    sn.publish(orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")), path, 1, committed_at="2024-01-01 00:00:00")
    sn.publish(orders, path, 2, committed_at="2024-01-02 00:00:00")
    return path


def _totals(snapshot: DataFrame, version: int) -> DataFrame:
    totals = snapshot.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return totals.select(F.lit(version).alias("version"), "o_orderstatus", "n", "total")


def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    path = _snapshots(spark, sf)
    earlier = sn.read_as_of(spark, path, at="2024-01-01 12:00:00")
    return _totals(earlier, 1).unionByName(_totals(sn.read_as_of(spark, path, 2), 2))


def snapshot_rollback(spark: SparkSession, sf: str) -> DataFrame:
    path = _snapshots(spark, sf)
    version = sn.rollback(spark, path, 1, committed_at="2024-01-03 00:00:00")
    return _totals(sn.read_as_of(spark, path), version)


def table_history(spark: SparkSession, sf: str) -> DataFrame:
    path = _snapshots(spark, sf)
    sn.rollback(spark, path, 1, committed_at="2024-01-03 00:00:00")
    return sn.history(spark, path).select("version", "committed_at", "operation", "row_count", F.size("columns").alias("column_count"))


def prompt_batches(spark: SparkSession, sf: str) -> DataFrame:
    prompts = me.anomaly_prompts(load_flagged(spark, sf))
    return prompts.select(
        "date_part", "batch", "n", F.length("prompt").cast("bigint").alias("prompt_chars"), F.md5("prompt").alias("prompt_md5"),
        F.size(F.split("prompt", '"event_id":"EVT-')).cast("bigint").alias("parts"),
    )


def explained_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Every anomaly through prompts, a service's answers, and one combined report per date."""
    answers = me.answer(me.anomaly_prompts(load_flagged(spark, sf)), explain_batches)
    reports = me.combine_reports(materialize(me.parse_reports(answers), "answers"), AS_OF)
    groups = F.json_array_length(F.get_json_object("full_report", "$.anomaly_groups"))
    return reports.select("run_date", "anomaly_count", "unread_batches", "pipeline_health", F.coalesce(groups, F.lit(0)).alias("group_count"))


def parse_responses(spark: SparkSession, sf: str) -> DataFrame:
    answers = service_answers(en.enrich(load_transactions(spark, sf)))
    return me.parse_objects(answers, me.ENRICHMENT_ANSWER_DDL).select("answer_id", "parse_ok", "event_id", "fraud_risk", "geo_risk_flag", "enrichment_confidence", "reasoning")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        decode_events, payload_key_drift, quality_flags, clean_events, anomaly_events, rules_on_customer, rules_on_orders,
        remediated_events, anomaly_summary_day, anomaly_summary_by_type, anomaly_summary_by_label, distinct_events, top_anomalies, unanalyzed_anomalies,
        anomaly_batches, anomaly_groups, anomaly_patterns, anomaly_bursts, anomaly_itemsets, anomaly_report_daily,
        stream_split, stream_two_tables, stream_compacted, stream_latency, stream_distinct, enrich_transactions, enrich_partitioned, enrich_merge,
        null_rates, numeric_profile, sample_values, catalog_tables, catalog_columns, catalog_documents, catalog_describe, catalog_profiles, catalog_upsert, catalog_search,
        vector_topk_cosine, vector_topk_l2, vector_topk_indexed, text_topk_tfidf, document_vectors,
        schema_history, schema_drift_pair, schema_drift_history, schema_drift_severity, schema_paths, schema_path_changes, schema_path_verdicts, schema_merge, snapshot_as_of, snapshot_rollback,
        table_history,
        freshness, freshness_by_commit, health_daily, incidents, dq_actions, alert_routing, prompt_batches, explained_reports, parse_responses,
    ]
}
