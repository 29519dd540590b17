from __future__ import annotations

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline.operators.anomalies import TYPES
from plumbline.operators.rules import Rule, anomalous, apply_rules, clean, flag_transactions
from plumbline.sources.events import decode, drop_repeats

AS_OF = "2024-01-31 00:00:00"

NORMAL = {
    "event_id": "EVT-1", "user_id": "USR-1", "product_id": "PRD-1", "amount": 99.0, "currency": "USD", "event_type": "purchase",
    "timestamp": "2024-01-15T10:00:00.000000+00:00", "country": "US", "payment_method": "card",
}


def flag(spark, *values):
    return flag_transactions(decode(spark.createDataFrame([(v,) for v in values], "value string"), ingest_ts=AS_OF), AS_OF)


def one(spark, **changes):
    record = {k: v for k, v in {**NORMAL, **changes}.items() if v != "-"}
    return flag(spark, json.dumps(record)).first()


def hits(row):
    return [t for t in TYPES if row[f"flag_{t}"]]


@pytest.mark.parametrize(("changes", "expected", "score"), [
    ({}, [], 0.0),
    ({"user_id": None}, ["null_user"], 1.0),
    ({"amount": 50000.0}, ["extreme_amount"], 1.0),
    ({"amount": 10000.0}, [], 0.0),
    ({"amount": -10.0}, ["negative_amount"], 1.0),
    ({"currency": "XYZ"}, ["invalid_currency"], 1.0),
    ({"currency": None}, ["invalid_currency"], 1.0),
    ({"amount": None}, [], 0.0),
    ({"timestamp": "2099-01-01T00:00:00+00:00"}, ["future_ts"], 1.0),
    ({"timestamp": "garbage"}, [], 0.0),
    ({"timestamp": None}, [], 0.0),
    ({"user_id": None, "amount": -5.0, "currency": "XYZ"}, ["null_user", "negative_amount", "invalid_currency"], 3.0),
    ({"_anomaly_type": "other"}, [], 0.0),
    ({"_anomaly_type": "schema_drift"}, ["schema_drift"], 0.0),
    ({"payment_method": "-", "unexpected_field": "x"}, ["schema_drift"], 0.0),
    ({"payment_method": "-"}, ["schema_drift"], 0.0),
    ({"payment_method": None}, [], 0.0),
])
def test_flags_of_one_record(spark, changes, expected, score):
    row = one(spark, **changes)
    assert hits(row) == expected
    assert row["is_anomaly"] == bool(expected)
    assert row["anomaly_score"] == score


@pytest.mark.parametrize("value", ["not json", None, "[1, 2]", "{\"event_id\": "])
def test_undecodable_message_is_an_anomaly_and_not_lost(spark, value):
    row = flag(spark, value).first()
    assert row["user_id"] is None
    assert row["is_anomaly"]
    assert row["anomaly_score"] == 2.0  # no user, no currency
    assert row["date_part"] is None


def test_wrong_type_leaves_the_other_fields(spark):
    row = one(spark, amount="many")
    assert row["amount"] is None
    assert row["event_id"] == "EVT-1"


def test_keys_and_dates(spark):
    row = one(spark, payment_method="-", extra=1, timestamp="2099-01-01T00:00:00+00:00")
    assert row["missing_keys"] == ["payment_method"]
    assert row["unexpected_keys"] == ["extra"]
    assert row["date_part"] == date(2099, 1, 1)


def test_split_is_complete_and_disjoint(spark, flagged):
    good, bad = clean(flagged), anomalous(flagged)
    assert good.count() + bad.count() == flagged.count() == 1000
    assert good.join(bad, "event_id", "left_semi").isEmpty()
    assert bad.count() == 108


def test_no_null_flags_and_score_counts_five(flagged):
    flags = [f"flag_{t}" for t in TYPES]
    assert flagged.filter(" OR ".join(f"{c} IS NULL" for c in [*flags, "is_anomaly", "anomaly_score"])).isEmpty()
    total = sum((F.col(c).cast("int") for c in flags[:-1]), F.lit(0))
    assert flagged.filter(total != F.col("anomaly_score")).isEmpty()


def test_rules_on_any_frame(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, x int")
    rows = apply_rules(df, [Rule("low", "x < 0", 2.0), Rule("none", F.col("x").isNull(), 0.5), Rule("odd", "x % 2 = 1", 0.0, on_null=True)])
    got = {r["id"]: (r["flag_low"], r["flag_none"], r["flag_odd"], r["is_anomaly"], r["anomaly_score"]) for r in rows.collect()}
    assert got == {1: (False, False, True, True, 0.0), 2: (False, True, True, True, 0.5), 3: (True, False, False, True, 2.0)}


def test_repeats(spark):
    events = decode(spark.createDataFrame([(json.dumps(NORMAL),), (json.dumps(NORMAL),), ("junk",), ("junk",)], "value string"))
    assert events.count() == 4
    assert drop_repeats(events).count() == 3


def test_parsing_is_not_merged_into_filters(spark):
    plan = anomalous(flag(spark, "x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


# What may happen to a normal record, and the rules that it then breaks.
CHANGES = {
    "user": [({"user_id": None}, {"null_user"}), ({"user_id": ""}, set())],
    "amount": [
        ({"amount": 10000.01}, {"extreme_amount"}), ({"amount": 10000}, set()), ({"amount": -0.01}, {"negative_amount"}), ({"amount": 0}, set()),
        ({"amount": None}, set()), ({"amount": -3e5}, {"negative_amount"}),
    ],
    "currency": [({"currency": None}, {"invalid_currency"}), ({"currency": "usd"}, {"invalid_currency"}), ({"currency": "AUD"}, set())],
    "time": [
        ({"timestamp": "2024-01-31T00:00:01+00:00"}, {"future_ts"}), ({"timestamp": "2099-01-01T00:00:00+00:00"}, {"future_ts"}),
        ({"timestamp": "2024-01-31T00:00:00+00:00"}, set()), ({"timestamp": None}, set()), ({"timestamp": "garbage"}, set()),
    ],
    "label": [({"_anomaly_type": "schema_drift"}, {"schema_drift"}), ({"_anomaly_type": "other"}, set()), ({"_anomaly_type": None}, set())],
    "keys": [({"extra": 1}, {"schema_drift"}), ({"extra": None}, {"schema_drift"}), ({"country": None}, set())],
}


def test_random_changes_give_their_flags(spark):
    rng = random.Random(7)
    records, hits = [], {}
    for i in range(400):
        record, broken = {**NORMAL, "event_id": f"E{i}"}, set()
        for kind in rng.sample(sorted(CHANGES), rng.randint(0, 4)):
            change, rules = rng.choice(CHANGES[kind])
            record |= change
            broken |= rules
        records.append(record)
        hits[record["event_id"]] = broken
    for row in flag(spark, *map(json.dumps, records)).collect():
        broken = hits[row["event_id"]]
        assert {t for t in TYPES if row[f"flag_{t}"]} == broken
        assert row["is_anomaly"] == bool(broken)
        assert row["anomaly_score"] == len(broken - {"schema_drift"})


def test_missing_keys_are_drift(spark):
    records = [{k: v for k, v in NORMAL.items() if k != gone} | {"_anomaly_type": gone} for gone in NORMAL if gone not in ("user_id", "currency")]
    rows = flag(spark, *map(json.dumps, records)).collect()
    assert all({t for t in TYPES if r[f"flag_{t}"]} == {"schema_drift"} for r in rows)


def test_malformed_messages_are_anomalies_and_keep_their_text(spark):
    whole = json.dumps(NORMAL)
    texts = [
        "not json", "", None, "[1]", "7", whole + " junk", whole + " " + whole, whole + "," + whole, json.dumps({**NORMAL, "amount": "12.5 EUR"}),
        json.dumps({**NORMAL, "amount": [1]}), whole[:-1],
    ]
    rows = flag(spark, *texts).collect()
    assert len(rows) == len(texts)
    assert all(r["malformed"] and r["flag_schema_drift"] and r["is_anomaly"] for r in rows)
    assert sorted(r["raw_value"] or "" for r in rows) == sorted(t or "" for t in texts)
    fine = flag(spark, whole, json.dumps({**NORMAL, "amount": None}), f"  {whole}\n").collect()
    assert not any(r["malformed"] or r["raw_value"] for r in fine)
