"""Physical plans: what is shuffled, read and pruned."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from plumbline.plans.queries import QUERIES
from plumbline.operators import anomalies as an
from plumbline.operators import profile as pr
from plumbline.plans.transactions import load_transactions, messages
from plumbline.sources.events import decode
from plumbline.sources.tables import append
from tests.conftest import DATA

STREAMS = {"stream_split", "stream_two_tables", "stream_distinct"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, flagged, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    append(flagged, path, partition_by=["date_part"])
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_query_joins_without_a_key_or_runs_python_per_row(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)


def test_decoding_and_flags_are_row_local(spark):
    from plumbline.operators.rules import flag_transactions

    text = plan(flag_transactions(decode(messages(load_transactions(spark, DATA).coalesce(1))), "2024-01-31 00:00:00").coalesce(1))
    assert "Exchange" not in text
    assert text.count("from_json(") == 1


def test_a_day_reads_one_partition_and_its_columns(stored):
    text = plan(an.summary_of_day(stored, "2024-01-15"))
    assert "PartitionFilters: [isnotnull(date_part" in text
    columns = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "event_id" not in columns
    assert "flag_null_user" in columns


def test_limits_come_before_the_shuffle(stored):
    ranked = plan(an.ranked_by_day(stored, 5))
    assert ranked.index("WindowGroupLimit") < ranked.index("Exchange") < ranked.rindex("WindowGroupLimit")
    assert "EqualTo(is_anomaly,true)" in ranked
    assert "TakeOrderedAndProject" in plan(an.top_anomalies(stored))


def test_counts_are_combined_before_the_shuffle(stored):
    text = plan(an.summary_by_type(stored))
    assert "partial_count" in text
    assert text.count("Exchange") == 1
    assert "Sort" not in text


def test_samples_filter_the_scan_by_key(spark):
    part = spark.read.parquet(f"{DATA}/part.parquet")
    assert "LessThanOrEqual(p_partkey,4)" in plan(pr.first_rows(part, "p_partkey", 5))
