"""Inputs derived from the `events` table for operators that need evolving payloads, a partition function, or service answers."""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.enrich import CATEGORIES, USUAL_PAIRS
from plumbline.schemas import ENRICHMENT_DEFAULTS

DAYS_PER_VERSION = 4


def evolving_messages(events: DataFrame) -> DataFrame:
    """(version, event_ts, value): JSON payloads whose fields change every four days.

    Version 3 adds `channel`, 4 makes `quantity` fractional, 5 sends `amount` as text, 6 lets `currency` be null, 7 drops
    `user_id`, 8 replaces `country` by `region`.
    """
    ts = F.col("ts").cast("timestamp")
    version = F.floor(F.date_diff(F.to_date(ts), F.to_date(F.lit("2024-01-01"))) / DAYS_PER_VERSION) + 1
    k = F.get_json_object("props", "$.k").cast("int")
    v = F.col("version")
    country = F.element_at(F.array(*map(F.lit, ["US", "UK", "DE", "FR", "CA"])), (F.col("user_id") % 5 + 1).cast("int"))

    def key(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), text)

    def quoted(column: Column) -> Column:
        return F.concat(F.lit('"'), column.cast("string"), F.lit('"'))

    amount = F.col("value").cast("string")
    parts = F.concat_ws(
        ",",
        key("event_id", quoted(F.col("event_id"))),
        F.when(v < 7, key("user_id", F.col("user_id").cast("string"))),
        key("amount", F.when(v < 5, amount).otherwise(quoted(amount))),
        key("currency", F.when((v >= 6) & (F.col("event_type") == "view"), "null").otherwise('"EUR"')),
        key("quantity", F.concat(k.cast("string"), F.when(v < 4, "").otherwise(".5"))),
        F.when(v >= 3, key("channel", quoted(F.col("event_type")))),
        F.when(v < 8, key("country", quoted(country))).otherwise(key("region", quoted(country))),
    )
    rows = events.select(version.cast("int").alias("version"), ts.alias("event_ts"), "event_id", "user_id", "event_type", "value", "props")
    return rows.select("version", "event_ts", F.concat(F.lit("{"), parts, F.lit("}")).alias("value"))


def nested_messages(events: DataFrame) -> DataFrame:
    """(version, event_ts, value): nested JSON payloads that change every four days.

    Version 3 adds `user.tier`, 4 makes `items[].q` fractional, 5 adds `items[].note`, null for views, 6 sends `user.id` as text, 7 drops
    `user.country` and 8 replaces `tags[]` by `meta.tags[]`.
    """
    ts = F.col("ts").cast("timestamp")
    version = F.floor(F.date_diff(F.to_date(ts), F.to_date(F.lit("2024-01-01"))) / DAYS_PER_VERSION) + 1
    k = F.get_json_object("props", "$.k").cast("int").cast("string")
    user, kind, v = F.col("user_id").cast("string"), F.col("event_type"), F.col("version")

    def text(column: Column) -> Column:
        return F.concat(F.lit('"'), column, F.lit('"'))

    person = F.concat_ws(
        ",", F.concat(F.lit('"id":'), F.when(v < 6, user).otherwise(text(user))),
        F.when(v < 7, F.concat(F.lit('"country":'), text(F.lit("DE")))),
        F.when(v >= 3, F.concat(F.lit('"tier":'), text(kind))),
    )
    item = F.concat_ws(
        ",", F.concat(F.lit('"q":'), k, F.when(v < 4, "").otherwise(".5")),
        F.when(v >= 5, F.concat(F.lit('"note":'), F.when(kind == "view", "null").otherwise(text(k)))),
    )
    tags = F.concat(F.lit('"tags":['), text(kind), F.lit("]"))
    value = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user":{'), person, F.lit('},"items":[{'), item, F.lit("}],"),
        F.when(v < 8, tags).otherwise(F.concat(F.lit('"meta":{'), tags, F.lit("}"))), F.lit("}"),
    )
    rows = events.select(version.cast("int").alias("version"), ts.alias("event_ts"), "event_id", "user_id", "event_type", "props")
    return rows.select("version", "event_ts", value.alias("value"))


def enrich_frame(rows: pd.DataFrame) -> pd.DataFrame:
    """The enrichment rules over the columns of a chunk, standing in for a user's partition function."""
    amount = rows["amount"].to_numpy(dtype=float)
    payment, kind = rows["payment_method"], rows["event_type"]
    known, unpaid, crypto = ~np.isnan(amount), payment.isna().to_numpy(), (payment == "crypto").to_numpy()
    above, far_above = known & (amount > 100), known & (amount > 200)
    pairs = rows["country"].fillna("").astype(str) + "/" + rows["currency"].fillna("").astype(str)
    risky = ~pairs.isin(["/".join(p) for p in USUAL_PAIRS]).to_numpy()
    number = rows["product_id"].astype(object).str.extract(r"^PRD-([0-9]+)$")[0].astype(float).fillna(-1).to_numpy()
    points = above.astype(int) + far_above + 2 * crypto + unpaid + risky
    bought = (kind == "purchase").to_numpy()
    text = np.where(far_above, "amount above 200", np.where(above, "amount above 100", "")).astype(object)
    for reason in (np.where(crypto, "paid with crypto", np.where(unpaid, "no payment method", "")), np.where(risky, "unusual country and currency", "")):
        text = text + np.where((text != "") & (reason != ""), "; ", "").astype(object) + reason.astype(object)
    values = [
        np.select([~known, points >= 4, points >= 2], ["unknown", "high", "medium"], "low"),
        np.select(
            [kind.isna().to_numpy(), (kind == "refund").to_numpy(), bought & (number >= 90) & (number <= 99), bought & known & (amount < 20)],
            ["unknown", "refund_request", "subscription", "impulse_buy"], "planned_purchase",
        ),
        np.select([(number >= low) & (number <= high) for low, high, _ in CATEGORIES], [name for _, _, name in CATEGORIES], "unknown"),
        risky,
        (known.astype(int) + rows["country"].notna().to_numpy() + ~unpaid + rows["product_id"].notna().to_numpy()) / 4,
        text,
    ]
    return pd.DataFrame({name: value for (name, _, _), value in zip(ENRICHMENT_DEFAULTS, values, strict=True)})


def service_answers(enriched: DataFrame) -> DataFrame:
    """(answer_id, text): answers of a text service about each event; some bare, some in prose, some broken, some without JSON."""
    fields = F.struct(
        "event_id", "fraud_risk", "geo_risk_flag", "enrichment_confidence", F.lit("fits {usual} values").alias("reasoning"),
    )
    answer = F.to_json(fields)
    text = (
        F.when(F.col("currency") == "XYZ", "I cannot judge this record.")
        .when(F.col("payment_method").isNull(), F.concat(F.lit("Result: "), F.expr("left(answer, length(answer) - 3)")))
        .when(F.col("country") == "DE", F.col("answer"))
        .otherwise(F.concat(F.lit("Here is the result:\n"), F.col("answer"), F.lit("\nThat is all.")))
    )
    return enriched.select("event_id", "currency", "payment_method", "country", answer.alias("answer")).select(
        F.col("event_id").alias("answer_id"), text.alias("text"),
    )


def explain_batches(prompts: list[str]) -> list[str]:
    """A stand-in for a text service: groups the records of each prompt by type; batches of three records it cannot explain."""
    answers = []
    for prompt in prompts:
        types = Counter(json.loads(line)["anomaly_type"] for line in prompt.splitlines() if line.startswith("{"))
        report = {
            "anomaly_groups": [{"anomaly_type": t, "count": n} for t, n in sorted(types.items())],
            "overall_pipeline_health": "critical" if any("," in t for t in types) else "degraded",
            "recommended_actions": sorted({t.split(",")[0] for t in types}),
        }
        answers.append("I cannot tell." if types.total() == 3 else f"Report: {json.dumps(report)}")
    return answers
