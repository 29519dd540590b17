from __future__ import annotations

import pandas as pd
import pytest

from plumbline.operators import enrich as en
from plumbline.schemas import ENRICHMENT_DEFAULTS

NAMES = [name for name, _, _ in ENRICHMENT_DEFAULTS]
DDL = "event_id string, product_id string, amount double, currency string, event_type string, country string, payment_method string"


def enriched(spark, *row):
    return en.enrich(spark.createDataFrame([row], DDL)).select(NAMES).first()


@pytest.mark.parametrize(("row", "expected"), [
    (("e", "PRD-10", 299.0, "USD", "purchase", "US", "card"), ("medium", "planned_purchase", "electronics", False, 1.0, "amount above 200")),
    (("e", "PRD-95", 299.0, "JPY", "purchase", "US", "crypto"),
     ("high", "subscription", "grocery", True, 1.0, "amount above 200; paid with crypto; unusual country and currency")),
    (("e", "PRD-30", 5.0, "EUR", "purchase", "DE", None), ("low", "impulse_buy", "clothing", False, 0.75, "no payment method")),
    (("e", "XYZ", None, "EUR", "refund", "DE", "card"), ("unknown", "refund_request", "unknown", False, 0.75, "")),
    (("e", "PRD-100", 150.0, None, None, None, "card"), ("medium", "unknown", "unknown", True, 0.75, "amount above 100; unusual country and currency")),
])
def test_rules(spark, row, expected):
    assert tuple(enriched(spark, *row)) == expected


def test_chunks_are_full_and_complete(spark):
    def sizes(rows):
        return pd.DataFrame({"fraud_risk": ["low"] * len(rows), "enrichment_reasoning": [str(len(rows))] * len(rows)})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = en.enrich_partitions(spark.range(60).coalesce(1), sizes).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["id"] for r in rows] == list(range(60))
    assert [r["enrichment_reasoning"] for r in rows] == ["25"] * 50 + ["10"] * 10
    assert {r["customer_intent"] for r in rows} == {"unknown"}
    assert {r["geo_risk_flag"] for r in rows} == {False}


def test_failing_chunk_gets_defaults_in_the_same_schema(spark):
    def flaky(rows):
        if (rows["id"] < 25).any():
            raise RuntimeError("no answer")
        return pd.DataFrame({"fraud_risk": ["low"] * len(rows)})

    out = en.enrich_partitions(spark.range(50).coalesce(1), flaky)
    assert out.columns == ["id", *NAMES]
    assert out.groupBy("fraud_risk").count().orderBy("fraud_risk").collect() == [("low", 25), ("unknown", 25)]
    with pytest.raises(Exception, match="no answer"):
        en.enrich_partitions(spark.range(50).coalesce(1), flaky, on_error="raise").collect()


def test_merge_keeps_all_records_and_the_last_enrichment(spark):
    records = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "event_id string")
    given = spark.createDataFrame(
        [("a", "low", "x", "y", True, 0.5, "r1", 1), ("a", "high", "x", None, True, 0.9, "r2", 2), ("c", None, "x", "y", None, 0.1, None, 1),
         ("unknown id", "low", "x", "y", True, 0.5, "r", 1), (None, "low", "x", "y", True, 0.5, "r", 1)],
        "event_id string, fraud_risk string, customer_intent string, product_category string, geo_risk_flag boolean, "
        "enrichment_confidence double, enrichment_reasoning string, round int",
    )
    rows = sorted(map(tuple, en.merge_enrichments(records, given, "round").collect()), key=str)
    assert rows == sorted([
        ("a", "high", "x", "unknown", True, 0.9, "r2"), ("a", "high", "x", "unknown", True, 0.9, "r2"),
        ("b", "unknown", "unknown", "unknown", False, 0.0, ""), ("c", "unknown", "x", "y", False, 0.1, ""),
        (None, "unknown", "unknown", "unknown", False, 0.0, ""),
    ], key=str)


def test_column_rules_are_row_local(spark):
    plan = en.enrich(spark.createDataFrame([], DDL))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Python" not in plan
