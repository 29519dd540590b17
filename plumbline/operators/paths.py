"""Nested schemas of JSON payloads, one row per version and path, and the changes between neighbouring versions.

A path is `a.b[].c`: the field c of the objects in the list b of the object a. Every payload is parsed once, to see that it is JSON, and
reduced to its form: its text with one value in place of all of a type. Forms are counted in the map tasks, and each different form is taken
apart level by level once; (version, path, type) is added up in the map tasks. Versions are never gathered into one row, so a version may have any
number of paths, as payloads that are maps by key have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.drift import WIDENING
from plumbline.schemas import HISTORY_VERSIONS

# What a form changes in valid JSON: strings that are no keys, booleans, plain numbers. Others stay as they are. Each match is replaced by MARK,
# which valid JSON does not hold, and what its groups caught: a key, two quotes, the last letter of a boolean, the point of a fraction.
MARK = "\x01"
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
VALUES = rf"""(?s)({STRING})(?=\s*:)|(")[^"\\]*+(?:\\.[^"\\]*+)*+(")|(?:tru|fals)(e)|(?<![0-9.eE+-])-?(?:0|[1-9][0-9]{{0,17}})(?:(\.)[0-9]{{1,18}})?(?![0-9.eE+-])"""
CAUGHT = MARK + "$1$2$3$4$5"

# Levels below the payload that are looked into; what is nested deeper counts as `struct` or `array`.
DEPTH = 5


def json_kind(value: Column) -> Column:
    """Name of a JSON value's type: `struct` and `array` whatever they hold, `void` for null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "struct")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("DECIMAL"), "double")
        .otherwise(F.lower(kind))
    )


def _cell(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"), F.lit(True).alias("whole"))


def _opened(cell: Column) -> Column:
    """A cell and what it holds; the cell itself is not opened again."""
    fields = F.try_variant_get(cell["value"], "$", "map<string,variant>")
    items = F.try_variant_get(cell["value"], "$", "array<variant>")
    inner = F.coalesce(
        F.transform(F.map_entries(fields), lambda e: _cell(F.concat_ws(".", cell["path"], e["key"]), e["value"])),
        F.transform(items, lambda v: _cell(F.concat(cell["path"], F.lit("[]")), v)),
        F.array().cast("array<struct<path:string,value:variant,whole:boolean>>"),
    )
    own = F.array(F.struct(cell["path"].alias("path"), cell["value"].alias("value"), F.lit(False).alias("whole")))
    return F.when(cell["whole"], F.concat(own, inner)).otherwise(own)


def json_form(text: Column) -> Column:
    """A valid JSON text with `""`, true, 0 and 0.5 in place of its strings, booleans, integers and fractions; keys, lists and nulls stay."""
    marked = F.regexp_replace(text, F.lit(VALUES), F.lit(CAUGHT))
    for caught, value in (('"', '"'), ("e", "true"), (".", "0.5"), ("", "0")):
        marked = F.replace(marked, F.lit(MARK + caught), F.lit(value))
    return marked


def observed_paths(messages: DataFrame, table: str, *, version: str = "version", at: str = "event_ts", value: str = "value",
                   depth: int = DEPTH) -> DataFrame:
    """(table_name, version, committed_at, record_count, path, type, nullable): what the payloads of each version really hold.

    The type is the one all values have, `double` for numbers of both kinds, `string` for any other mix, `void` if all are null. A path
    is nullable if some object that could have it lacks it or holds null there, or if a list holds null. A payload that is no JSON
    object is no record. An object without any key has no row but counts as a record.
    """
    told = messages.select(F.col(version).alias("version"), F.col(at).alias("at"), F.col(value).cast("string").alias("told"))
    # Generators keep the steps apart, so that no step is repeated for each use of its result.
    told = told.select("version", "at", F.inline(F.array(F.struct("told")))).filter(F.try_parse_json("told").isNotNull())
    forms = told.groupBy("version", json_form(F.col("told")).alias("form")).agg(F.count(F.lit(1)).alias("times"), F.max("at").alias("at"))
    parsed = forms.select("version", "at", "times", F.try_parse_json("form").alias("payload"))
    start = F.struct(F.lit(None).cast("string").alias("path"), F.col("payload").alias("value"), F.lit(True).alias("whole"))
    cells = parsed.select("version", "at", "times", F.inline(F.array(start)))
    cells = cells.filter(F.try_variant_get("value", "$", "map<string,variant>").isNotNull())
    for _ in range(depth):
        cell = F.struct("path", "value", "whole")
        cells = cells.select("version", "at", "times", F.inline(F.transform(F.array(cell), _opened)[0]))
    counts = cells.select("version", "at", "times", "path", json_kind(F.col("value")).alias("type")).groupBy("version", "path", "type").agg(
        F.sum("times").alias("n"), F.max("at").alias("at"),
    )
    return _merged(counts, table)


def _merged(counts: DataFrame, table: str) -> DataFrame:
    """One row per version and path from the counts of its types."""
    named, number = F.col("type") != "void", F.col("type").isin("bigint", "double")
    merged = counts.groupBy("version", "path").agg(
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("present"),
        F.sum(F.when(named, 0).otherwise(F.col("n"))).alias("nulls"),
        F.sum(F.when(F.col("type") == "struct", F.col("n")).otherwise(0)).alias("objects"),
        F.max("at").alias("at"),
        F.max(F.when(named, F.col("type"))).alias("most"), F.min(F.when(named, F.col("type"))).alias("least"),
        F.bool_and(F.when(named, number)).alias("numbers"),
    )
    kind = F.when(F.col("most").isNull(), "void").when(F.col("most") == F.col("least"), F.col("most")).when(F.col("numbers"), "double").otherwise("string")
    rows = merged.select("version", "path", "present", "nulls", "objects", "at", kind.alias("type"))
    # An item of a list has no object that could lack it.
    parent = F.when(~F.endswith("path", F.lit("[]")), _parent(F.col("path")))
    below = rows.filter("path IS NOT NULL").withColumn("parent", parent)
    above = rows.select(F.col("version").alias("_version"), F.coalesce("path", F.lit("")).alias("_path"), F.col("objects").alias("held"))
    met = (F.col("version") == F.col("_version")) & (F.col("parent") == F.col("_path"))
    records = rows.filter("path IS NULL").select(F.col("version").alias("_of"), F.col("objects").alias("record_count"), F.col("at").alias("committed_at"))
    nullable = F.coalesce(F.col("present") < F.col("held"), F.col("nulls") > 0)
    return below.join(above, met, "left").join(F.broadcast(records), F.col("version") == F.col("_of")).select(
        F.lit(table).alias("table_name"), F.col("version").cast("bigint").alias("version"), "committed_at", "record_count", "path", "type",
        nullable.alias("nullable"),
    )


def _parent(path: Column) -> Column:
    """The path without its last field; empty for a field of the payload itself."""
    return F.regexp_replace(path, r"\.?[^.]*$", "")


def newest_versions(paths: DataFrame, n: int = HISTORY_VERSIONS) -> DataFrame:
    """The paths of the newest n versions of each table."""
    versions = paths.select("table_name", "version").distinct()
    rank = F.row_number().over(Window.partitionBy("table_name").orderBy(F.col("version").desc()))
    kept = versions.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return paths.join(F.broadcast(kept), ["table_name", "version"])


def path_changes(paths: DataFrame) -> DataFrame:
    """(table_name, from_version, to_version, change, path, from_type, to_type): what differs from the version before.

    `change` is added, removed, type or nullability; a path whose type changed is not listed for nullability as well. Each path of a
    version meets itself in the next one, so the work is one shuffle of rows. A field whose parent was added or removed with it has a
    row of its own. Versions are known by their paths: one without any is passed over.
    """
    order = Window.partitionBy("table_name").orderBy("version")
    versions = paths.select("table_name", "version").distinct()
    steps = versions.select("table_name", F.lag("version").over(order).alias("from_version"), F.col("version").alias("to_version"))
    steps = steps.filter("from_version IS NOT NULL")
    sides = []
    for side in ("from", "to"):
        joined = paths.withColumnRenamed("version", f"{side}_version").join(F.broadcast(steps), ["table_name", f"{side}_version"])
        held = F.struct("type", "nullable")
        empty = F.lit(None).cast("struct<type:string,nullable:boolean>")
        sides.append(joined.select(
            "table_name", "from_version", "to_version", "path", (held if side == "from" else empty).alias("before"),
            (held if side == "to" else empty).alias("after"),
        ))
    both = sides[0].unionByName(sides[1]).groupBy("table_name", "from_version", "to_version", "path").agg(
        F.max("before").alias("before"), F.max("after").alias("after"),
    )
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .when(F.col("before.type") != F.col("after.type"), "type")
        .when(F.col("before.nullable") != F.col("after.nullable"), "nullability")
    )
    retyped = F.col("change") == "type"
    return both.withColumn("change", change).filter("change IS NOT NULL").select(
        "table_name", "from_version", "to_version", "change", "path", F.when(retyped, F.col("before.type")).alias("from_type"),
        F.when(retyped, F.col("after.type")).alias("to_type"),
    )


def path_verdicts(changes: DataFrame, key_paths: Sequence[str] = ()) -> DataFrame:
    """(table_name, from_version, to_version, n_added, n_removed, n_widened, n_narrowed, is_breaking_change, severity).

    A removed path or a type change that may lose values is breaking: critical on a key path, high otherwise. Widening is medium, added
    paths alone are low. Only counts are gathered, so a change of any number of paths is one small row.
    """
    widened = F.concat_ws(">", "from_type", "to_type").isin([f"{a}>{b}" for a, b in WIDENING])
    lost = (F.col("change") == "removed") | ((F.col("change") == "type") & ~widened)
    counts = changes.filter("change <> 'nullability'").groupBy("table_name", "from_version", "to_version").agg(
        F.count_if(F.col("change") == "added").alias("n_added"),
        F.count_if(F.col("change") == "removed").alias("n_removed"),
        F.count_if((F.col("change") == "type") & widened).alias("n_widened"),
        F.count_if((F.col("change") == "type") & ~widened).alias("n_narrowed"),
        F.count_if(lost & F.col("path").isin(list(key_paths))).alias("n_keys"),
    )
    breaking = (F.col("n_removed") > 0) | (F.col("n_narrowed") > 0)
    severity = F.when(F.col("n_keys") > 0, "critical").when(breaking, "high").when(F.col("n_widened") > 0, "medium").otherwise("low")
    return counts.withColumns({"is_breaking_change": breaking, "severity": severity}).drop("n_keys")
