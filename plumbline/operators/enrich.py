"""Enrichment of transactions: by column rules, by a user's partition function, or by merging given enrichments."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import suffix_number, truth
from plumbline.schemas import ENRICHMENT_BATCH, ENRICHMENT_DDL, ENRICHMENT_DEFAULTS

logger = logging.getLogger(__name__)

# (country, currency) pairs that are usual; every other pair is a geographic risk.
USUAL_PAIRS = [("US", "USD"), ("UK", "GBP"), ("DE", "EUR"), ("FR", "EUR"), ("CA", "USD")]

# Product number ranges, bounds included.
CATEGORIES = [(0, 24, "electronics"), (25, 49, "clothing"), (50, 74, "home"), (75, 99, "grocery")]

CONFIDENCE_INPUTS = ["amount", "country", "payment_method", "product_id"]


def geo_risk() -> Column:
    usual = F.lit(False)
    for country, currency in USUAL_PAIRS:
        usual = usual | truth((F.col("country") == country) & (F.col("currency") == currency))
    return ~usual


def fraud_points() -> Column:
    amount = F.when(F.col("amount") > 200, 2).when(F.col("amount") > 100, 1).otherwise(0)
    payment = F.when(F.col("payment_method") == "crypto", 2).when(F.col("payment_method").isNull(), 1).otherwise(0)
    return amount + payment + geo_risk().cast("int")


def fraud_risk() -> Column:
    points = fraud_points()
    return F.when(F.col("amount").isNull(), "unknown").when(points >= 4, "high").when(points >= 2, "medium").otherwise("low")


def customer_intent() -> Column:
    kind, number = F.col("event_type"), suffix_number(F.col("product_id"), "PRD-")
    return (
        F.when(kind.isNull(), "unknown")
        .when(kind == "refund", "refund_request")
        .when((kind == "purchase") & number.between(90, 99), "subscription")
        .when((kind == "purchase") & (F.col("amount") < 20), "impulse_buy")
        .otherwise("planned_purchase")
    )


def product_category() -> Column:
    number = suffix_number(F.col("product_id"), "PRD-")
    low, high, name = CATEGORIES[0]
    chosen = F.when(number.between(low, high), name)
    for low, high, name in CATEGORIES[1:]:
        chosen = chosen.when(number.between(low, high), name)
    return chosen.otherwise("unknown")


def confidence() -> Column:
    present = sum((F.col(name).isNotNull().cast("int") for name in CONFIDENCE_INPUTS), F.lit(0))
    return present.cast("double") / len(CONFIDENCE_INPUTS)


def reasoning() -> Column:
    return F.concat_ws(
        "; ",
        F.when(F.col("amount") > 200, "amount above 200").when(F.col("amount") > 100, "amount above 100"),
        F.when(F.col("payment_method") == "crypto", "paid with crypto").when(F.col("payment_method").isNull(), "no payment method"),
        F.when(geo_risk(), "unusual country and currency"),
    )


def enrich(transactions: DataFrame) -> DataFrame:
    """Add the six enrichment columns in one projection."""
    return transactions.select(
        "*",
        fraud_risk().alias("fraud_risk"),
        customer_intent().alias("customer_intent"),
        product_category().alias("product_category"),
        geo_risk().alias("geo_risk_flag"),
        confidence().alias("enrichment_confidence"),
        reasoning().alias("enrichment_reasoning"),
    )


def _whole_chunks(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The rows of a partition in frames whose length is a multiple of `size`, the last one excepted."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None and len(rest):
            frame = pd.concat([rest, frame], ignore_index=True)
        whole = len(frame) - len(frame) % size
        if whole:
            yield frame.iloc[:whole]
        rest = frame.iloc[whole:]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def enrich_partitions(records: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], *, batch_size: int = ENRICHMENT_BATCH,
                      on_error: str = "default") -> DataFrame:
    """Call a user's function on chunks of a partition and append the enrichment columns it returns.

    `fn` gets at most `batch_size` rows and returns a frame with the enrichment columns, row by row in the same order; columns
    it leaves out and nulls get the defaults. A failing call gives its chunk the defaults, or ends the job with
    `on_error="raise"`.
    """
    kinds = {"string": object, "boolean": bool, "double": float}
    names = [name for name, _, _ in ENRICHMENT_DEFAULTS]
    base = records.select(*[c for c in records.columns if c not in names])
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields), ENRICHMENT_DDL])

    def call(chunk: pd.DataFrame) -> pd.DataFrame:
        try:
            found = fn(chunk)
            if len(found) != len(chunk):
                raise ValueError(f"got {len(found)} rows for {len(chunk)}")
            return found
        except Exception:
            if on_error == "raise":
                raise
            logger.exception("enrichment of a chunk failed; its rows get the defaults")
            return pd.DataFrame(index=chunk.index)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _whole_chunks(frames, batch_size):
            parts = [call(frame.iloc[start:start + batch_size].reset_index(drop=True)) for start in range(0, len(frame), batch_size)]
            found = pd.concat(parts, ignore_index=True)
            frame = frame.copy()
            for name, kind, default in ENRICHMENT_DEFAULTS:
                values = found[name].astype(object) if name in found else pd.Series(None, index=found.index, dtype=object)
                frame[name] = values.where(values.notna(), default).astype(kinds[kind]).to_numpy()
            yield frame

    return base.mapInPandas(run, out)


def latest_enrichment(enrichments: DataFrame, order_by: str, key: str = "event_id") -> DataFrame:
    """One enrichment per key, the one with the highest `order_by`; a repeated key is combined in the map tasks."""
    names = [name for name, _, _ in ENRICHMENT_DEFAULTS]
    best = F.max_by(F.struct(*names), order_by)
    return enrichments.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("e")).select(key, "e.*")


def merge_enrichments(records: DataFrame, enrichments: DataFrame, order_by: str, key: str = "event_id") -> DataFrame:
    """All records with their latest enrichment; defaults where there is none or a field is NULL.

    The right side has one row per key, so a key that repeats in the records grows nothing, and AQE may split its partition.
    """
    latest = latest_enrichment(enrichments, order_by, key)
    joined = records.join(latest, key, "left")
    filled = [F.coalesce(F.col(name), F.lit(default)).alias(name) for name, _, default in ENRICHMENT_DEFAULTS]
    return joined.select(*records.columns, *filled)
