"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from plumbline.plans.oracles import ORACLES
from plumbline.plans.queries import QUERIES
from tests.conftest import DATA
from tools.check_oracle import compare, open_tables

# These report times, or numbers of an iteration, which no SQL can repeat; their operators have tests of their own.
MEASURED = {"stream_latency", "document_vectors"}


@pytest.fixture(scope="module")
def db():
    return open_tables(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    if name in MEASURED:
        assert entry.queries()[name](spark, DATA).count() > 0
        return
    rows, problems = compare(entry.queries()[name](spark, DATA), db, entry.oracle_sql()[name])
    assert not problems
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) | MEASURED
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    report = entry.entry(spark)
    assert report.columns == ["run_date", "analyzed_at", "anomaly_count", "pipeline_health", "executive_summary", "full_report"]
    assert report.count() > 0
