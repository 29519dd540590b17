"""Batch tables: reading, appending, merging schemas, and intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import new_work_path


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def append(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append a batch. For a partitioned target AQE sizes the output files and splits a hot partition."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("append")
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files have different columns; absent ones are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def merge_rows(*parts: DataFrame) -> DataFrame:
    """Stack frames by column name; a column one lacks is NULL there."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result that several passes read, so it is computed once and survives lost executors."""
    spark = df.sparkSession
    path = new_work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, order: Sequence[Column | str], number: str) -> DataFrame:
    """Add 0, 1, 2, … in the given order without sorting in one task.

    The rows are range-partitioned, numbered inside each partition, and shifted by the sizes of the partitions before. The numbered
    rows are written to the shared folder, so that a lost task cannot number them another way. Rows that tie get any order.
    """
    low = F.monotonically_increasing_id()  # the partition in the upper bits, the place in it in the lower 33
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumns({"_part": F.shiftright(low, 33), "_place": low.bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = {r["_part"]: r["n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per partition
    offsets, before = [], 0
    for part in sorted(sizes):
        offsets += [F.lit(part).cast("bigint"), F.lit(before).cast("bigint")]
        before += sizes[part]
    shift = F.element_at(F.create_map(*offsets), F.col("_part")) if offsets else F.lit(0)
    return placed.withColumn(number, (shift + F.col("_place")).cast("bigint")).drop("_part", "_place")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join by name in which NULL keys meet; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    met = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, met, how).drop(*[f"_r_{k}" for k in keys])
