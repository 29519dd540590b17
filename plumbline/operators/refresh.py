"""Profiles of partitioned tables that are kept up to date: only partitions whose files changed are read again.

A profile is stored in parts that can be merged: for each partition and column the rows, nulls, least and greatest number, sum, and the
first values by key. A refresh compares the files of every partition with what it saw last, reads the partitions that differ, and adds
their parts as a new run; the newest run of a partition counts, and partitions that are gone count no longer. Merging reads a few
numbers per partition and not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import percent
from plumbline.operators.profile import numeric_columns
from plumbline.session import path_exists
from plumbline.sources.tables import join_null_safe, materialize

SHOWN = 3
PARTS_DDL = (
    "run bigint, part string, column_name string, row_count bigint, null_count bigint, least double, greatest double, total double, "
    "numbers bigint, samples array<struct<key:string,value:string>>"
)
SEEN_DDL = "run bigint, part string, state bigint"


def states(table: DataFrame, by: str) -> DataFrame:
    """(part, state): a hash of the names and sizes of each partition's files. Only footers are read."""
    files = table.select(F.col(by).cast("string").alias("part"), "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy("part").agg(F.bit_xor(F.xxhash64("file_path", "file_size")).alias("state"))


def _stored(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    full = f"{path}/{name}"
    return spark.read.schema(schema).parquet(full) if path_exists(spark, full) else spark.createDataFrame([], schema)


def seen(spark: SparkSession, path: str) -> DataFrame:
    """(part, run, state) as the newest run saw the table; `run` is the one that read the partition last."""
    rows = _stored(spark, path, "seen", SEEN_DDL)
    newest = rows.agg(F.max("run")).first()[0]
    last = rows.filter(F.col("run") == F.lit(newest)).select("part", "state")
    read = _stored(spark, path, "parts", PARTS_DDL).groupBy("part").agg(F.max("run").alias("run"))
    return join_null_safe(last, read, ["part"])


def partial_profile(table: DataFrame, by: str, key: str) -> DataFrame:
    """(part, column_name, row_count, …, samples) of each partition: counts from one scan, samples from the rows with the least keys."""
    numeric = set(numeric_columns(table))
    columns = [c for c in table.columns if c != by]
    none = F.lit(None).cast("double")
    sums = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        number = value.cast("double") if c in numeric else none
        sums += [F.count(value).alias(f"n{i}"), F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"), F.sum(number).alias(f"s{i}")]
    part = F.col(f"`{by}`").cast("string").alias("part")
    counts = table.groupBy(part).agg(F.count(F.lit(1)).alias("row_count"), *sums)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), (F.col("row_count") - F.col(f"n{i}")).alias("null_count"), F.col(f"a{i}").alias("least"),
            F.col(f"b{i}").alias("greatest"), F.col(f"s{i}").alias("total"), F.col(f"n{i}").alias("numbers"),
        )
        for i, c in enumerate(columns)
    ])
    order = Window.partitionBy(F.col(f"`{by}`")).orderBy(F.col(f"`{key}`").asc_nulls_last())
    first = table.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= SHOWN)
    shown = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_rank").alias("rank"), F.col(f"`{key}`").cast("string").alias("key"),
                 F.col(f"`{c}`").cast("string").alias("value"))
        for c in columns
    ])
    lists = first.select(part, F.inline(shown)).groupBy("part", "column_name").agg(
        F.array_sort(F.collect_list(F.struct("rank", "key", "value"))).alias("samples"),  # at most SHOWN rows
    )
    samples = F.transform("samples", lambda s: F.struct(s["key"].alias("key"), s["value"].alias("value")))
    return join_null_safe(
        counts.select("part", "row_count", F.inline(cells)), lists.select("part", "column_name", samples.alias("samples")), ["part", "column_name"], "left",
    )


def refresh(table: DataFrame, path: str, *, by: str, key: str) -> int:
    """Bring the stored profile of a partitioned table up to date; the number of partitions that were read."""
    spark = table.sparkSession
    now = materialize(states(table, by), "states")
    before = seen(spark, path)
    changed = now.join(before, now["part"].eqNullSafe(before["part"]) & (now["state"] == before["state"]), "left_anti")
    parts = [r["part"] for r in changed.select("part").collect()]  # one row a partition
    run = (_stored(spark, path, "seen", SEEN_DDL).agg(F.max("run")).first()[0] or 0) + 1
    if parts:
        kind = table.schema[by].dataType
        wanted = F.col(by).isin([F.lit(p).cast(kind) for p in parts if p is not None])
        wanted = wanted | F.col(by).isNull() if None in parts else wanted
        own = partial_profile(table.filter(wanted), by, key)
        fields = [f.name for f in T._parse_datatype_string(PARTS_DDL).fields]
        own.withColumn("run", F.lit(run).cast("bigint")).select(*fields).write.mode("append").parquet(f"{path}/parts")
    now.select(F.lit(run).cast("bigint").alias("run"), "part", "state").write.mode("append").parquet(f"{path}/seen")
    return len(parts)


def profile(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(table_name, column_name, row_count, null_count, null_pct, min, max, avg, samples) merged from the stored parts."""
    rows = _stored(spark, path, "parts", PARTS_DDL)
    live = seen(spark, path).select(F.col("part").alias("_part"), F.col("run").alias("_run"))
    current = rows.join(F.broadcast(live), F.col("part").eqNullSafe(F.col("_part")) & (F.col("run") == F.col("_run")), "left_semi")
    merged = current.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.min("least").alias("min"), F.max("greatest").alias("max"),
        F.sum("total").alias("total"), F.sum(F.when(F.col("total").isNotNull(), F.col("numbers"))).alias("numbers"),
        F.flatten(F.collect_list(F.struct("part", "samples"))["samples"]).alias("samples"),  # SHOWN a partition
    )
    ordered = F.array_sort(F.transform("samples", lambda s: F.struct(
        s["key"].isNull().alias("none"), s["key"].try_cast("decimal(38,9)").alias("number"), s["key"].alias("key"), s["value"].alias("value"),
    )))
    return merged.select(
        F.lit(table).alias("table_name"), "column_name", "row_count", "null_count", percent(F.col("null_count"), F.col("row_count")).alias("null_pct"),
        "min", "max", F.round(F.try_divide("total", "numbers"), 4).alias("avg"), F.slice(ordered, 1, SHOWN)["value"].alias("samples"),
    )
