"""Quality rules as data: a list of named conditions compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.scalars import truth
from plumbline.schemas import DRIFT_LABEL, MAX_AMOUNT, VALID_CURRENCIES
from plumbline.session import as_timestamp


@dataclass(frozen=True)
class Rule:
    """`condition` is a column or an SQL text; `weight` is what a hit adds to the score; `on_null` decides NULL."""

    name: str
    condition: Column | str
    weight: float = 1.0
    on_null: bool = False

    def flag(self) -> Column:
        condition = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return truth(condition, self.on_null)


def apply_rules(df: DataFrame, rules: Sequence[Rule], *, prefix: str = "flag_", verdict: str = "is_anomaly",
                score: str = "anomaly_score") -> DataFrame:
    """Add one non-null flag per rule, their OR, and their weighted sum. No shuffle, no second pass."""
    flagged = df.select("*", *[rule.flag().alias(prefix + rule.name) for rule in rules])
    flags = [F.col(prefix + rule.name) for rule in rules]
    points = [flag.cast("int") * F.lit(rule.weight) for flag, rule in zip(flags, rules, strict=True) if rule.weight]
    total = reduce(add, points) if points else F.lit(0.0)
    return flagged.select("*", reduce(or_, flags).alias(verdict), total.cast("double").alias(score))


def transaction_rules(as_of: str | datetime | Column | None = None) -> list[Rule]:
    """The six rules for transaction events. Drift, malformed messages included, makes a record anomalous but adds nothing to its score."""
    drifted = (
        truth(F.size("unexpected_keys") > 0)
        | truth(F.size("missing_keys") > 0)
        | truth(F.col("_anomaly_type") == DRIFT_LABEL)
        | F.col("malformed")
    )
    return [
        Rule("null_user", F.col("user_id").isNull()),
        Rule("extreme_amount", F.col("amount") > MAX_AMOUNT),
        Rule("negative_amount", F.col("amount") < 0),
        Rule("invalid_currency", ~F.col("currency").isin(VALID_CURRENCIES), on_null=True),
        Rule("future_ts", F.col("event_ts") > as_timestamp(as_of)),
        Rule("schema_drift", drifted, weight=0.0),
    ]


def flag_transactions(events: DataFrame, as_of: str | datetime | Column | None = None) -> DataFrame:
    return apply_rules(events, transaction_rules(as_of))


def clean(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_anomaly"))


def anomalous(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("is_anomaly"))
