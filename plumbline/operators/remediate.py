"""What to do with a flagged record: reject, filter, impute or alert, and the corrected values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import as_timestamp

# First match wins. Texts, so that the same policy can be applied by a frame or printed as SQL.
POLICY = [
    ("flag_null_user", "reject"),
    ("flag_negative_amount AND event_type IS DISTINCT FROM 'refund'", "reject"),
    ("flag_extreme_amount OR flag_invalid_currency", "filter"),
    ("flag_negative_amount OR flag_future_ts", "impute"),
    ("flag_schema_drift", "alert_upstream"),
]


def action() -> Column:
    chosen = F.when(F.expr(POLICY[0][0]), POLICY[0][1])
    for condition, name in POLICY[1:]:
        chosen = chosen.when(F.expr(condition), name)
    return chosen.otherwise("keep")


def remediate(flagged: DataFrame, as_of: str | datetime | Column | None = None) -> DataFrame:
    """Add the action and, where it is `impute`, the corrected amount and event time."""
    impute = F.col("action") == "impute"
    amount = F.when(impute & F.col("flag_negative_amount"), F.abs("amount")).otherwise(F.col("amount"))
    event_ts = F.when(impute & F.col("flag_future_ts"), as_timestamp(as_of)).otherwise(F.col("event_ts"))
    return flagged.select("*", action().alias("action")).select(
        "*", amount.alias("fixed_amount"), event_ts.alias("fixed_event_ts"),
    )


def remediation_sql(table: str) -> str:
    """The same policy as a Spark SQL statement over a flagged table."""
    branches = "\n".join(f"    WHEN {condition} THEN '{name}'" for condition, name in POLICY)
    return f"SELECT *,\n  CASE\n{branches}\n    ELSE 'keep'\n  END AS action\nFROM {table}"
