"""Numbered snapshots of a table as partition folders with a manifest table; Delta tables use their own time travel.

A version is written to a folder of its own and its manifest row last; readers go by the manifest, so a failed write is never seen,
and a rollback is one manifest row that names an older version's folder.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.drift import declared_columns
from plumbline.schemas import HISTORY_VERSIONS
from plumbline.session import as_timestamp, path_exists


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest").withColumn("version", F.col("version").cast("bigint"))


def publish(df: DataFrame, path: str, version: int, *, committed_at: str | datetime | Column | None = None, operation: str = "write") -> None:
    """Write one version and record it; a version that exists is refused. The row count is observed during the write."""
    folder, observed = uuid.uuid4().hex, Observation()
    _free(df.sparkSession, path, version)
    df.observe(observed, F.count(F.lit(1)).alias("row_count")).write.parquet(f"{path}/data/{folder}")
    row = df.sparkSession.range(1).select(
        as_timestamp(committed_at).alias("committed_at"),
        F.lit(operation).alias("operation"),
        F.lit(observed.get["row_count"]).cast("bigint").alias("row_count"),
        declared_columns(df).alias("columns"),
        F.lit(folder).alias("folder"),
    )
    _record(row, path, version)


def _free(spark: SparkSession, path: str, version: int) -> None:
    if path_exists(spark, f"{path}/manifest/version={version}"):
        raise ValueError(f"version {version} of {path} exists")


def _record(row: DataFrame, path: str, version: int) -> None:
    """Add a manifest row; of two writers of one version the second fails."""
    row.coalesce(1).write.mode("error").parquet(f"{path}/manifest/version={version}")


def history(spark: SparkSession, path: str, n: int = HISTORY_VERSIONS) -> DataFrame:
    """The newest n commits."""
    return manifest(spark, path).orderBy(F.col("version").desc()).limit(n)


def schema_versions(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Manifest rows in the form the drift operators take."""
    return manifest(spark, path).select(
        F.lit(table).alias("table_name"), "version", "committed_at", F.col("row_count").alias("record_count"), "columns",
    )


def read_as_of(spark: SparkSession, path: str, version: int | None = None, *, at: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A snapshot by version, by commit time (the last one not after `at`), or the newest."""
    if fmt == "delta":
        reader = spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        elif at is not None:
            reader = reader.option("timestampAsOf", at)
        return reader.load(path)
    known = manifest(spark, path)
    if version is not None:
        known = known.filter(F.col("version") == version)
    elif at is not None:
        known = known.filter(F.col("committed_at") <= F.to_timestamp(F.lit(at)))
    chosen = known.agg(F.max_by("folder", "version")).first()[0]
    if chosen is None:
        raise ValueError(f"no such snapshot of {path}: version={version}, at={at}")
    return spark.read.parquet(f"{path}/data/{chosen}")


def rollback(spark: SparkSession, path: str, to_version: int, *, committed_at: str | datetime | Column | None = None) -> int:
    """Make an earlier snapshot the newest version: a manifest row that names its folder. No data is read, written or removed."""
    known = manifest(spark, path)
    newest = known.agg(F.max("version")).first()[0]
    if known.filter(F.col("version") == to_version).isEmpty():
        raise ValueError(f"no such snapshot of {path}: version={to_version}")
    row = known.filter(F.col("version") == to_version).select(
        as_timestamp(committed_at).alias("committed_at"), F.lit(f"rollback to {to_version}").alias("operation"), "row_count", "columns", "folder",
    )
    _record(row, path, newest + 1)
    return newest + 1
