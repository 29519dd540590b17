"""Schema versions of a table, the changes between neighbours, and how severe they are.

A version is one row: (table_name, version, committed_at, record_count, columns), with `columns` an array of
(name, type, nullable) sorted by name. It is either observed in JSON payloads or declared by a frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.schemas import HISTORY_VERSIONS

# Type changes that keep every value readable.
WIDENING = [
    ("int", "bigint"), ("int", "double"), ("float", "double"), ("bigint", "double"), ("smallint", "int"), ("smallint", "bigint"),
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("date", "timestamp"), ("void", "string"),
    ("void", "bigint"), ("void", "double"), ("void", "boolean"),
]


def _json_type(value: Column) -> Column:
    """Name of a JSON value's type; nested values count as `struct` or `array` whatever they hold."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("DECIMAL"), "double")
        .when(kind.startswith("OBJECT"), "struct")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise(F.lower(kind))
    )


def _common_type(kinds: Column) -> Column:
    """One name for all types seen: the type itself, `double` for a mix of numbers, `string` for any other mix."""
    numbers = F.size(F.array_except(kinds, F.array(F.lit("bigint"), F.lit("double")))) == 0
    return F.when(F.size(kinds) == 0, "void").when(F.size(kinds) == 1, kinds[0]).when(numbers, "double").otherwise("string")


def observed_versions(messages: DataFrame, table: str, *, version: str = "version", at: str = "event_ts", value: str = "value") -> DataFrame:
    """The schema that the payloads of each version really have.

    Every message is parsed once; (version, key, type) is counted in the map tasks, so the shuffle carries a few rows per key.
    A key is nullable if some payload of the version lacks it or holds null. The first key of an object counts it, and so does the
    one row of an object without keys. What is no JSON object is no record; it counts in `unreadable_count`.
    """
    spark = messages.sparkSession
    known = F.json_object_keys(F.col(value)).isNotNull()
    parsed = messages.select(version, at, F.when(known, F.try_parse_json(F.col(value))).alias("payload"))
    cells = parsed.lateralJoin(spark.tvf.variant_explode(F.col("payload").outer()).alias("cell"))
    head = F.coalesce(F.col("pos"), F.lit(0)) == 0
    counts = cells.select(
        version, at, F.col("key").alias("name"), _json_type(F.col("cell.value")).alias("type"), (head & F.col("payload").isNotNull()).alias("head"),
        F.col("payload").isNull().alias("unreadable"),
    )
    counts = counts.groupBy(version, "name", "type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("head").alias("heads"), F.count_if("unreadable").alias("unreadable"), F.max(at).alias("at"),
    )
    named = F.col("type") != "void"
    keys = counts.groupBy(version, "name").agg(
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("present"),
        F.sum("heads").alias("heads"),
        F.sum("unreadable").alias("unreadable"),
        F.max("at").alias("at"),
        F.array_sort(F.collect_set(F.when(named, F.col("type")))).alias("kinds"),
    )
    rows = keys.groupBy(version).agg(
        F.sum("heads").alias("record_count"),
        F.sum("unreadable").alias("unreadable_count"),
        F.max("at").alias("committed_at"),
        F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("name", _common_type(F.col("kinds")).alias("type"), "present")))).alias("seen"),
    )
    columns = F.transform("seen", lambda c: F.struct(
        c["name"].alias("name"), c["type"].alias("type"), (c["present"] < F.col("record_count")).alias("nullable"),
    ))
    return rows.select(
        F.lit(table).alias("table_name"), F.col(version).cast("bigint").alias("version"), "committed_at", "record_count", columns.alias("columns"),
        "unreadable_count",
    )


def declared_columns(df: DataFrame) -> Column:
    """The schema of a frame as a literal `columns` value."""
    return F.array_sort(F.array(*[
        F.struct(
            F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"),
        )
        for f in df.schema.fields
    ]))


def history(versions: DataFrame, n: int = HISTORY_VERSIONS) -> DataFrame:
    """The newest n versions of each table."""
    rank = F.row_number().over(Window.partitionBy("table_name").orderBy(F.col("version").desc()))
    return versions.select("*", rank.alias("_rank")).filter(F.col("_rank") <= n).drop("_rank")


def _names(columns: str) -> Column:
    return F.col(f"{columns}.name")


def changes(versions: DataFrame) -> DataFrame:
    """One row per version that has a predecessor: columns added, removed, retyped, and of other nullability."""
    by_version = Window.partitionBy("table_name").orderBy("version")
    paired = versions.select(
        "table_name", F.col("version").alias("to_version"), F.col("committed_at").alias("to_timestamp"), "columns",
        F.lag("version").over(by_version).alias("from_version"),
        F.lag("committed_at").over(by_version).alias("from_timestamp"),
        F.lag("columns").over(by_version).alias("previous"),
    ).filter(F.col("from_version").isNotNull())

    def before(c: Column, field: str) -> Column:
        return F.element_at(F.filter("previous", lambda p: p["name"] == c["name"]), 1)[field]

    common = F.filter("columns", lambda c: F.array_contains(_names("previous"), c["name"]))
    retyped = F.transform(
        F.filter(common, lambda c: before(c, "type") != c["type"]),
        lambda c: F.struct(c["name"].alias("name"), before(c, "type").alias("from_type"), c["type"].alias("to_type")),
    )
    nullability = F.transform(F.filter(common, lambda c: before(c, "nullable") != c["nullable"]), lambda c: c["name"])
    return paired.select(
        "table_name", "from_version", "to_version", "from_timestamp", "to_timestamp",
        F.array_except(_names("columns"), _names("previous")).alias("added_columns"),
        F.array_except(_names("previous"), _names("columns")).alias("removed_columns"),
        retyped.alias("type_changes"),
        nullability.alias("nullability_changes"),
    )


def drift(versions: DataFrame) -> DataFrame:
    """Only the versions whose columns or types differ from the version before."""
    return changes(versions).filter(
        (F.size("added_columns") > 0) | (F.size("removed_columns") > 0) | (F.size("type_changes") > 0),
    )


def newest_drift(versions: DataFrame) -> DataFrame:
    """Drift between the newest two versions of each table; no row if there is none or only one version."""
    return drift(history(versions, 2))


def change_rows(changed: DataFrame) -> DataFrame:
    """One row per changed column."""
    null = F.lit(None).cast("string")

    def named(column: str, change: str) -> Column:
        return F.transform(column, lambda c: F.struct(
            F.lit(change).alias("change"), c.alias("column_name"), null.alias("from_type"), null.alias("to_type"),
        ))

    retyped = F.transform("type_changes", lambda c: F.struct(
        F.lit("type").alias("change"), c["name"].alias("column_name"), c["from_type"].alias("from_type"), c["to_type"].alias("to_type"),
    ))
    rows = F.concat(
        named("added_columns", "added"), named("removed_columns", "removed"), retyped, named("nullability_changes", "nullability"),
    )
    return changed.select("table_name", "from_version", "to_version", F.inline(rows))


def verdicts(drifts: DataFrame, key_columns: Sequence[str] = ()) -> DataFrame:
    """Is a drift breaking, how severe is it, and what to do.

    A removed column or a type change that may lose values is breaking: critical on a key column, high otherwise. Widening is
    medium; added columns alone are low.
    """
    keys = F.array(*map(F.lit, key_columns)) if key_columns else F.array().cast("array<string>")
    widened = F.array(*[F.lit(f"{a}>{b}") for a, b in WIDENING])
    narrowed = F.filter("type_changes", lambda c: ~F.array_contains(widened, F.concat(c["from_type"], F.lit(">"), c["to_type"])))
    lost = F.concat("removed_columns", F.col("narrowed.name"))
    breaking = F.size("lost") > 0
    severity = (
        F.when(breaking & F.arrays_overlap("lost", keys), "critical")
        .when(breaking, "high")
        .when(F.size("type_changes") > 0, "medium")
        .otherwise("low")
    )
    target = F.concat(F.col("table_name"), F.lit(" version "), F.col("to_version").cast("string"))
    steps = F.array_compact(F.array(
        F.when(F.size("removed_columns") > 0, F.concat(F.lit("restore or replace: "), F.array_join("removed_columns", ", "))),
        F.when(F.size("narrowed") > 0, F.concat(F.lit("check readers of: "), F.array_join(F.col("narrowed.name"), ", "))),
        F.when(F.size("added_columns") > 0, F.concat(F.lit("document: "), F.array_join("added_columns", ", "))),
    ))
    rollback = F.concat(
        F.lit("SELECT * FROM "), F.col("table_name"), F.lit(" VERSION AS OF "), F.col("from_version").cast("string"),
    )
    rows = drifts.select("*", narrowed.alias("narrowed")).select("*", lost.alias("lost")).select(
        *drifts.columns, "narrowed", "lost", breaking.alias("is_breaking_change"), severity.alias("severity"),
    )
    cause = (
        F.when(F.size("removed_columns") > 0, "a producer stopped sending columns")
        .when(F.size("type_changes") > 0, "a producer changed the type of values")
        .otherwise("a producer started sending new columns")
    )
    effect = F.when(F.col("is_breaking_change"), F.concat(F.lit("readers fail or lose values in: "), F.array_join("lost", ", "))).otherwise(
        "readers by name are not affected")
    message = F.concat(
        F.lit("Schema of "), target, F.lit(" changed with severity "), F.col("severity"), F.lit(". "),
        F.when(F.col("is_breaking_change"), "Readers must be adapted.").otherwise("No action is needed by readers."),
    )
    return rows.select(
        *drifts.columns, "is_breaking_change", "severity",
        effect.alias("impact_assessment"), cause.alias("root_cause_hypothesis"), steps.alias("recommended_actions"),
        F.when(F.col("is_breaking_change"), rollback).alias("rollback_sql"), message.alias("stakeholder_message"),
    )
