"""Table profiles: row counts, null rates, numeric ranges, column lists and sample values.

A profile is one aggregation over one scan, whatever the number of columns; the single result row is turned into long rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import percent


def null_rates(df: DataFrame, table: str) -> DataFrame:
    """(table, column, rows, nulls, null_pct) for all columns; the rate is 0 for an empty table."""
    named = [(f"c{i}", name) for i, name in enumerate(df.columns)]
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count(F.col(f"`{name}`")).alias(alias) for alias, name in named],
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("column_name"), (F.col("row_count") - F.col(alias)).alias("null_count")) for alias, name in named
    ])
    return counts.select(F.lit(table).alias("table_name"), "row_count", F.inline(rows)).select(
        "table_name", "column_name", "row_count", "null_count", percent(F.col("null_count"), F.col("row_count")).alias("null_pct"),
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def numeric_profile(df: DataFrame, table: str) -> DataFrame:
    """(table, column, min, max, avg) for every numeric column, as DOUBLE; no rows for a table without one."""
    names = numeric_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, min double, max double, avg double")
    stats = df.agg(*[
        f(F.col(f"`{name}`")).cast("double").alias(f"{kind}{i}")
        for i, name in enumerate(names) for kind, f in [("min", F.min), ("max", F.max), ("avg", F.avg)]
    ])
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column_name"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"),
            F.round(F.col(f"avg{i}"), 4).alias("avg"),
        )
        for i, name in enumerate(names)
    ])
    return stats.select(F.lit(table).alias("table_name"), F.inline(rows))


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest keys, NULL keys last.

    The n-th key is found by reading the key column alone; the filter on it then reaches the scan, so other columns are read
    only where such keys lie.
    """
    k = F.col(f"`{key}`")
    last = df.select(k.alias("k")).orderBy(F.col("k").asc_nulls_last()).limit(n).agg(F.max("k")).first()[0]
    near = k.isNull() if last is None else (k <= F.lit(last)) | k.isNull()
    return df.filter(near).orderBy(k.asc_nulls_last()).limit(n)


def sample_values(df: DataFrame, table: str, key: str, n: int = 5, shown: int = 3) -> DataFrame:
    """The first values of each column by key order: `n` rows are taken, `shown` values are listed."""
    cells = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"`{name}`").cast("string").alias("value")) for name in df.columns
    ])
    rows = first_rows(df, key, n).select(F.col(f"`{key}`").alias("_key"), F.inline(cells))
    ordered = F.array_sort(F.collect_list(F.struct("_key", "value")))  # at most n entries
    return rows.groupBy("column_name").agg(F.slice(ordered, 1, shown).alias("cells")).select(
        F.lit(table).alias("table_name"), "column_name", F.col("cells.value").alias("samples"),
    )


def column_rows(df: DataFrame, table: str) -> DataFrame:
    """(table, position, column, type, nullable) from the schema alone."""
    rows = [(table, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, nullable boolean",
    )


def described_columns(df: DataFrame, table: str) -> DataFrame:
    """Column metadata beside the number of rows and non-null values found in the data."""
    meta = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"), F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema.fields)
    ])
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return counts.select(F.lit(table).alias("table_name"), "row_count", F.inline(meta))


def over_tables(profile, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Apply a profile to several tables and stack the results; Spark runs the scans side by side in one job."""
    return reduce(DataFrame.unionByName, [profile(df, name) for name, df in tables.items()])


def known_table(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    if name not in tables:
        raise ValueError(f"unknown table {name!r}; known tables: {sorted(tables)}")
    return tables[name]


def table_stats(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """Row count and null rates of one table by name."""
    return null_rates(known_table(tables, name), name)


def table_profile(df: DataFrame, table: str, path: str, key: str) -> DataFrame:
    """One row about a table: counts, columns, sample values by column, and min, max and avg by numeric column.

    The parts have one row each and are joined on the table's name.
    """
    columns = F.array(*[
        F.struct(
            F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(f.nullable).alias("nullable"),
        )
        for f in df.schema.fields
    ])
    base = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), F.lit(path).alias("table_path"), "row_count", F.lit(len(df.columns)).alias("column_count"),
        columns.alias("columns"),
    )
    samples = sample_values(df, table, key).groupBy("table_name").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "samples"))).alias("sample_values"),
    )
    named = F.explode(F.array(*[
        F.struct(F.concat_ws("_", "column_name", F.lit(kind)).alias("name"), F.col(kind).alias("value")) for kind in ("min", "max", "avg")
    ]))
    stats = numeric_profile(df, table).select("table_name", named.alias("stat")).groupBy("table_name").agg(
        F.map_from_entries(F.collect_list("stat")).alias("stats"),
    )
    return base.join(samples, "table_name", "left").join(stats, "table_name", "left")
