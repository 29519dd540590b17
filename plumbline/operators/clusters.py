"""Patterns across anomalies: bursts in time, and sets of values that occur together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.sources.tables import materialize

BURST_GAP_SECONDS = 7200
LEAST_BURST = 3
MICROS = 1_000_000


def bursts(events: DataFrame, *, keys: Sequence[str] = ("anomaly_type",), at: str = "event_ts", gap_seconds: int = BURST_GAP_SECONDS,
           least: int = LEAST_BURST) -> DataFrame:
    """(keys, burst_start, burst_end, n, score): runs of events of a key in which no two neighbours are more than the gap apart.

    Events are first counted in slots as wide as the gap, in the map tasks: within a slot they belong together, and slots that are not
    neighbours do not. Only the slots are put in order, so the work after the scan is bounded by time and not by the number of events.

    `score` is the scan statistic of the burst: the logarithm of how much more likely its n events are if its own rate differs from that
    of the rest of the key's time, and 0 if its rate is not higher. Keys may be null; events without a time take no part.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    gap = gap_seconds * MICROS
    rows = events.filter(F.col(at).isNotNull()).select(*keys, micros.alias("_t"))
    slots = rows.groupBy(*keys, F.floor(F.col("_t") / gap).alias("_slot")).agg(
        F.min("_t").alias("first"), F.max("_t").alias("last"), F.count(F.lit(1)).alias("n"),
    )
    order = Window.partitionBy(*keys).orderBy("_slot")
    apart = F.coalesce(F.col("first") - F.lag("last").over(order) > gap, F.lit(True)).cast("int")
    numbered = slots.withColumn("_new", apart).withColumn("_burst", F.sum("_new").over(order))
    runs = numbered.groupBy(*keys, "_burst").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    every = Window.partitionBy(*keys)
    spans = runs.withColumns({
        "_total": F.sum("n").over(every), "_span": F.max("last").over(every) - F.min("first").over(every) + gap,
    })
    expected = F.col("_total") * (F.col("last") - F.col("first") + gap) / F.col("_span")
    return spans.filter(F.col("n") >= least).select(
        *keys, F.timestamp_micros("first").alias("burst_start"), F.timestamp_micros("last").alias("burst_end"), "n",
        scan_score(F.col("n"), F.col("_total"), expected).alias("score"),
    )


def scan_score(n: Column, total: Column, expected: Column) -> Column:
    """Logarithm of the likelihood ratio of n events where `expected` of `total` were due, both with rates fitted; 0 if n is not above."""
    rest, due = total - n, total - expected
    outside = F.when(rest > 0, rest * F.log(rest / due)).otherwise(F.lit(0.0))
    return F.when(n > expected, F.round(n * F.log(n / expected) + outside, 6)).otherwise(F.lit(0.0))


def itemsets(records: DataFrame, fields: Sequence[str], *, support: float, several: str | None = None) -> DataFrame:
    """(size, items, n, support_pct, lift): values of different fields that occur together in at least `support` of the records.

    `fields` have one value a record; `several` may name one more field, an array of different values of which each counts. Null is no
    value. Lift is how many times more often the values meet than they would if the fields were independent.

    A field has at most 1 / support frequent values (a record may count for several, so `several` has more, but no more than times its
    length). Others are dropped before any combination is counted, so combinations cannot explode: records are folded into the
    combinations of frequent values that occur, in the map tasks, and all subsets are counted from those rows.
    """
    names = [*fields, *([several] if several else [])]
    texts = [F.col(f).cast("string").alias(f) for f in fields] + ([F.col(several).cast("array<string>").alias(several)] if several else [])
    slim = materialize(records.select(*texts), "records")
    total = slim.count()
    least = max(1, -(-total * support // 1))
    cells = F.flatten(F.array(
        *[F.array(F.struct(F.lit(f).alias("field"), F.col(f).alias("value"))) for f in fields],
        *([F.transform(_texts(several), lambda v: F.struct(F.lit(several).alias("field"), v.alias("value")))] if several else []),
    ))
    single = slim.select(F.inline(cells)).filter("value IS NOT NULL").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    frequent: dict[str, dict[str, int]] = {name: {} for name in names}
    for row in single.filter(F.col("n") >= least).collect():  # at most 1 / support values a field
        frequent[row["field"]][row["value"]] = row["n"]

    kept = [F.when(F.col(f).isin(list(frequent[f])), F.col(f)).alias(f) for f in fields]
    if several:
        kept.append(F.array_sort(F.array_intersect(_texts(several), F.array(*map(F.lit, frequent[several])).cast("array<string>"))).alias(several))
    folded = materialize(slim.select(*kept).groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "folded")
    flat = _subsets(folded.drop(several) if several else folded, list(fields), 2)
    if several:
        exploded = folded.withColumn(several, F.explode(several))
        flat = flat.unionByName(_subsets(exploded, list(fields), 1, always=several), allowMissingColumns=True)
    known = [(name, value, n) for name, values in frequent.items() for value, n in values.items()]
    sets = flat.groupBy("size", *names).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    if not known:
        shares = {name: F.lit(1.0) for name in names}
    else:
        share_of = F.create_map(*[F.lit(x) for name, value, n in known for x in (f"{name}={value}", n / total)])
        shares = {name: F.coalesce(F.element_at(share_of, F.concat(F.lit(f"{name}="), F.col(name))), F.lit(1.0)) for name in names}
    items = F.concat_ws(", ", *[F.when(F.col(name).isNotNull(), F.concat(F.lit(f"{name}="), F.col(name))) for name in sorted(names)])
    ratio = F.col("n") / F.lit(max(total, 1))
    return sets.select(
        "size", items.alias("items"), "n", F.round(ratio * 100, 2).alias("support_pct"),
        F.round(reduce(lambda a, name: a / shares[name], names, ratio), 4).alias("lift"),
    )


def _texts(column: str) -> Column:
    """An array of texts; null is empty."""
    return F.coalesce(F.col(column), F.array().cast("array<string>"))


def _subsets(folded: DataFrame, fields: list[str], least_size: int, always: str | None = None) -> DataFrame:
    """Counts for every subset of the fields in which each chosen one has a value; `always` is in all of them."""
    choices = [[f for k, f in enumerate(fields) if mask >> k & 1] for mask in range(1 << len(fields))]
    keep = [chosen for chosen in choices if len(chosen) >= least_size]
    extra = [F.col(always)] if always else []
    rows = F.array(*[
        F.when(
            reduce(and_, [F.col(f).isNotNull() for f in chosen], F.lit(True)),
            F.struct(F.lit(len(chosen) + len(extra)).alias("size"), *[(F.col(f) if f in chosen else F.lit(None).cast("string")).alias(f) for f in fields]),
        )
        for chosen in keep
    ])
    return folded.select(*[c.alias(always) for c in extra], "n", F.inline(F.array_compact(rows)))
