"""Profiles that are refreshed by partition."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline.operators import refresh as re
from plumbline.sources.tables import append


@pytest.fixture
def days(spark):
    rows = [(i, i / 2 if i % 5 else None, f"t{i}", None if i % 50 == 49 else date(2024, 1, 1 + i // 40)) for i in range(200)]
    return spark.createDataFrame(rows, "id long, x double, name string, day date")


def told(rows):
    return {r["column_name"]: tuple(r)[2:] for r in rows.collect()}


def test_only_new_partitions_are_read(spark, days, tmp_path):
    table, stored = f"{tmp_path}/t", f"{tmp_path}/p"
    append(days.filter("day < '2024-01-03'"), table, partition_by=["day"])
    assert re.refresh(spark.read.parquet(table), stored, by="day", key="id") == 2
    append(days.filter("day >= '2024-01-03' OR day IS NULL"), table, partition_by=["day"])
    assert re.refresh(spark.read.parquet(table), stored, by="day", key="id") == 4
    parts = spark.read.parquet(f"{stored}/parts")
    assert {r["run"]: r["n"] for r in parts.groupBy("run").agg(F.count_distinct(F.coalesce("part", F.lit("none"))).alias("n")).collect()} == {1: 2, 2: 4}
    assert re.refresh(spark.read.parquet(table), stored, by="day", key="id") == 0
    assert told(re.profile(spark, stored, "t")) == {
        "id": (200, 0, 0.0, 0.0, 199.0, 99.5, ["0", "1", "2"]), "x": (200, 40, 20.0, 0.5, 99.5, 50.0, [None, "0.5", "1.0"]),
        "name": (200, 0, 0.0, None, None, None, ["t0", "t1", "t2"]),
    }


def test_a_partition_that_grows_counts_once_and_one_that_goes_no_more(spark, days, tmp_path):
    table, stored = f"{tmp_path}/t", f"{tmp_path}/p"
    append(days.filter("id < 20 AND day IS NOT NULL"), table, partition_by=["day"])
    re.refresh(spark.read.parquet(table), stored, by="day", key="id")
    append(days.filter("id BETWEEN 20 AND 39 AND day IS NOT NULL"), table, partition_by=["day"])
    append(days.filter("id BETWEEN 40 AND 48 AND day IS NOT NULL"), table, partition_by=["day"])
    assert re.refresh(spark.read.parquet(table), stored, by="day", key="id") == 2
    assert told(re.profile(spark, stored, "t"))["id"][:2] == (49, 0)
    for file in (tmp_path / "t/day=2024-01-02").iterdir():
        file.unlink()
    (tmp_path / "t/day=2024-01-02").rmdir()
    assert re.refresh(spark.read.parquet(table), stored, by="day", key="id") == 0
    assert told(re.profile(spark, stored, "t"))["id"][0] == 40
    only = re.partial_profile(spark.read.parquet(table).filter("day = '2024-01-01'"), "day", "id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in only
