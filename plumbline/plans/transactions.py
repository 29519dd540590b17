"""Transactions as a projection of the `events` table, and their JSON messages.

`events` has no nulls, negative values or currencies; the projection derives records of every kind from the row itself, malformed
messages included, so SQL can state the same thing. It is a plain `select` and works on a batch or a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import iso_utc
from plumbline.operators.rules import flag_transactions
from plumbline.sources.events import decode
from plumbline.sources.tables import read_table

AS_OF = "2024-01-31 00:00:00"
MESSAGE_FIELDS = ["event_id", "user_id", "product_id", "amount", "currency", "event_type", "timestamp", "country"]


def project(events: DataFrame) -> DataFrame:
    n, user = F.col("event_id"), F.col("user_id")

    def every(k: int) -> Column:
        return n % k == 0

    by_user = user % 5
    return events.select(
        F.concat(F.lit("EVT-"), n.cast("string")).alias("event_id"),
        F.when(~every(97), F.concat(F.lit("USR-"), user.cast("string"))).alias("user_id"),
        F.concat(F.lit("PRD-"), F.get_json_object("props", "$.k")).alias("product_id"),
        F.when(every(127), None).when(every(89), F.col("value") + 50000).when(every(83), -F.col("value")).otherwise(F.col("value")).alias("amount"),
        F.when(every(113), None).when(every(79), "XYZ").when(every(13), "JPY").when(by_user.isin(0, 4), "USD").when(by_user == 1, "GBP")
        .otherwise("EUR").alias("currency"),
        F.when(F.col("event_type").isin("purchase", "signup"), "purchase").when(F.col("event_type") == "error", "refund")
        .otherwise("cart_add").alias("event_type"),
        F.when(every(109), None).when(every(73), F.to_timestamp(F.lit("2099-01-01 00:00:00"))).otherwise(F.col("ts").cast("timestamp"))
        .alias("event_ts"),
        F.element_at(F.array(*map(F.lit, ["US", "UK", "DE", "FR", "CA"])), (by_user + 1).cast("int")).alias("country"),
        F.when(~every(71), F.element_at(F.array(*map(F.lit, ["card", "paypal", "crypto"])), (n % 3 + 1).cast("int")))
        .alias("payment_method"),
        every(71).alias("drifted"),
        F.when(every(71), None).when(every(101), "undecodable").when(every(103), "amount_as_text").when(every(107), "two_objects").alias("defect"),
    )


def messages(transactions: DataFrame) -> DataFrame:
    """One JSON text per transaction; drifted ones lack `payment_method` and carry an unknown key, others have the defect they name."""
    rows = transactions.select("*", F.coalesce(iso_utc(F.col("event_ts")), F.lit("at noon")).alias("timestamp"))
    keep_nulls = {"ignoreNullFields": "false"}
    regular = F.to_json(F.struct(*MESSAGE_FIELDS, "payment_method"), keep_nulls)
    drifted = F.to_json(F.struct(*MESSAGE_FIELDS, F.lit("surplus").alias("unexpected_field")), keep_nulls)
    as_text = [F.concat(F.col(f).cast("string"), F.lit(" EUR")).alias(f) if f == "amount" else f for f in [*MESSAGE_FIELDS, "payment_method"]]
    value = (
        F.when(F.col("drifted"), drifted)
        .when(F.col("defect") == "undecodable", F.concat(F.lit("lost: "), F.col("event_id")))
        .when(F.col("defect") == "amount_as_text", F.to_json(F.struct(*as_text), keep_nulls))
        .when(F.col("defect") == "two_objects", F.concat(regular, F.lit(" "), regular))
        .otherwise(regular)
    )
    return rows.select(value.alias("value"))


def load_transactions(spark: SparkSession, directory: str) -> DataFrame:
    return project(read_table(spark, directory, "events"))


def load_decoded(spark: SparkSession, directory: str) -> DataFrame:
    return decode(messages(load_transactions(spark, directory)), ingest_ts=AS_OF)


def load_flagged(spark: SparkSession, directory: str) -> DataFrame:
    return flag_transactions(load_decoded(spark, directory), AS_OF)
