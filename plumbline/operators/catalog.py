"""A table catalog: one document and its metadata per table, upserts by table name, lookups."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import thousands

CATALOG_DDL = (
    "table_name string, table_path string, row_count bigint, column_count int, columns_json string, description string, "
    "document string, version bigint"
)


def _columns_json(df: DataFrame) -> str:
    columns = [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in df.schema.fields]
    return json.dumps(columns, separators=(",", ":"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of the tables that have rows. No column is read; counts are combined in the map tasks."""
    names = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, names).groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


def entries(tables: Mapping[str, DataFrame], paths: Mapping[str, str], *, descriptions: Mapping[str, str] | None = None,
            version: int = 1) -> DataFrame:
    """Catalog rows for some tables. A table without a given description gets one from a template."""
    given = descriptions or {}
    known = next(iter(tables.values())).sparkSession.createDataFrame(
        [(n, paths[n], len(df.columns), _columns_json(df), ", ".join(df.columns), given.get(n)) for n, df in tables.items()],
        "table_name string, table_path string, column_count int, columns_json string, column_names string, given string",
    )
    rows = known.join(row_counts(tables), "table_name", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    template = F.format_string("Table %s with %d rows and %d columns.", "table_name", "row_count", "column_count")
    described = rows.select("*", F.trim(F.coalesce("given", template)).alias("description"))
    # Fixed format of a catalog document.
    text = F.format_string(
        "TABLE: %s\nDESCRIPTION: %s\nCOLUMNS: %s\nROW COUNT: %s\nPATH: %s",
        "table_name", "description", "column_names", thousands(F.col("row_count")), "table_path",
    )
    return described.select(
        "table_name", "table_path", "row_count", "column_count", "columns_json", "description", text.alias("document"),
        F.lit(version).cast("bigint").alias("version"),
    )


def empty_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CATALOG_DDL)


def upsert(old: DataFrame, new: DataFrame, key: str = "table_name", version: str = "version") -> DataFrame:
    """Old and new rows with the highest version kept per key. `max_by` combines in the map tasks."""
    both = old.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("row")).select(key, "row.*")


def list_tables(catalog: DataFrame) -> DataFrame:
    return catalog.select("table_name", "table_path", "row_count", "column_count")


def describe(catalog: DataFrame, table: str) -> DataFrame:
    """The entry of one table with its columns parsed; no row if the catalog does not know it."""
    columns = F.from_json("columns_json", "array<struct<name:string,type:string,nullable:boolean>>")
    return catalog.filter(F.col("table_name") == table).select(
        "table_name", "table_path", "row_count", columns.alias("columns"), F.col("document").alias("description"),
    )
