"""Profiles, catalog, appends, merges and snapshots."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import catalog as ca
from plumbline.operators import profile as pr
from plumbline.operators import search as se
from plumbline.plans import jobs
from plumbline.session import shared_base
from plumbline.sources import snapshots as sn
from plumbline.sources.tables import append, join_null_safe, materialize, merge_rows, number_rows, read_merged

TABLE = "id bigint, x double, n int, s string"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, 1.5, 10, "a"), (2, None, 20, None), (3, -4.0, None, None), (4, 2.5, 5, "d")], TABLE)


def test_null_rates(spark, table):
    rates = {r["column_name"]: (r["null_count"], r["null_pct"]) for r in pr.null_rates(table, "t").collect()}
    assert rates == {"id": (0, 0.0), "x": (1, 25.0), "n": (1, 25.0), "s": (2, 50.0)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], TABLE)
    assert {r["null_pct"] for r in pr.null_rates(empty, "t").collect()} == {0.0}
    assert all(r["min"] is None for r in pr.numeric_profile(empty, "t").collect())
    assert pr.sample_values(empty, "t", "id").isEmpty()
    assert pr.numeric_profile(empty.select("s"), "t").isEmpty()


def test_numeric_profile_takes_every_numeric_type(table):
    rows = {r["column_name"]: tuple(r)[2:] for r in pr.numeric_profile(table, "t").collect()}
    assert rows == {"id": (1.0, 4.0, 2.5), "x": (-4.0, 2.5, 0.0), "n": (5.0, 20.0, 11.6667)}


def test_samples_follow_the_key(table):
    rows = {r["column_name"]: r["samples"] for r in pr.sample_values(table, "t", "id", n=4, shown=2).collect()}
    assert rows["id"] == ["1", "2"]
    assert rows["s"] == ["a", None]


def test_first_rows(spark):
    rows = spark.createDataFrame([(3, "c"), (None, "n"), (1, "a"), (2, "b"), (None, "m")], "k int, v string")
    assert [r["k"] for r in pr.first_rows(rows, "k", 2).collect()] == [1, 2]
    assert [r["k"] for r in pr.first_rows(rows, "k", 4).collect()] == [1, 2, 3, None]
    assert pr.first_rows(rows.filter("k IS NULL"), "k", 4).count() == 2


def test_profile_is_one_scan(table):
    plan = pr.null_rates(table, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_columns_and_unknown_table(table):
    assert [tuple(r)[1:] for r in pr.column_rows(table, "t").collect()][2] == (2, "n", "int", True)
    with pytest.raises(ValueError, match=r"known tables: \['t'\]"):
        pr.known_table({"t": table}, "u")


def test_table_profile(spark, table):
    row = pr.table_profile(table, "t", "/w/t", "id").first()
    assert (row["table_name"], row["table_path"], row["row_count"], row["column_count"]) == ("t", "/w/t", 4, 4)
    assert row["stats"] == {
        "id_min": 1.0, "id_max": 4.0, "id_avg": 2.5, "x_min": -4.0, "x_max": 2.5, "x_avg": 0.0, "n_min": 5.0, "n_max": 20.0, "n_avg": 11.6667}
    assert row["sample_values"]["s"] == ["a", None, None]
    assert [c["type"] for c in row["columns"]] == ["bigint", "double", "int", "string"]
    empty = pr.table_profile(spark.createDataFrame([], "s string"), "e", "/w/e", "s").first()
    assert (empty["row_count"], empty["sample_values"], empty["stats"]) == (0, None, None)
    assert pr.table_stats({"t": table}, "t").count() == 4


def test_catalog_entry_and_lookup(table):
    catalog = ca.entries({"t": table}, {"t": "/w/t"})
    row = catalog.first()
    assert row["document"].splitlines() == [
        "TABLE: t", "DESCRIPTION: Table t with 4 rows and 4 columns.", "COLUMNS: id, x, n, s", "ROW COUNT: 4", "PATH: /w/t"]
    assert json.loads(row["columns_json"])[1] == {"name": "x", "type": "double", "nullable": True}
    assert [c["name"] for c in ca.describe(catalog, "t").first()["columns"]] == ["id", "x", "n", "s"]
    assert ca.describe(catalog, "missing").isEmpty()


def test_upsert_is_idempotent_and_newest_wins(spark, table):
    old = ca.entries({"t": table, "u": table}, {"t": "1", "u": "1"})
    new = ca.entries({"t": table}, {"t": "2"}, version=2)
    once = ca.upsert(old, new)
    assert sorted((r["table_name"], r["table_path"]) for r in once.collect()) == [("t", "2"), ("u", "1")]
    assert sorted(map(tuple, ca.upsert(once, new).collect())) == sorted(map(tuple, once.collect()))
    assert ca.upsert(ca.empty_catalog(spark), new).count() == 1


def test_catalog_refresh_and_search(spark, table, tmp_path):
    people = spark.createDataFrame([(1,)], "user_email int")
    path = f"{tmp_path}/catalog"
    jobs.refresh_catalog({"t": table}, {"t": "/w/t"}, path, 1)
    catalog = jobs.refresh_catalog({"people": people}, {"people": "/w/p"}, path, 2, descriptions={"people": "Contact data of persons."})
    assert sorted(r["table_name"] for r in ca.list_tables(catalog).collect()) == ["people", "t"]
    questions = spark.createDataFrame([(1, "Which table has contact persons?"), (2, "unknown words only")], "question_id int, text string")
    hits = jobs.ask_catalog(spark, path, questions).collect()
    assert hits == se.search_catalog(catalog, questions).collect()
    assert [(r["question_id"], r["rank"], r["table_name"], r["table_path"]) for r in hits] == [(1, 1, "people", "/w/p")]
    assert 0 < hits[0]["relevance_score"] <= 1
    assert se.search_catalog(ca.empty_catalog(spark), questions).isEmpty()


def test_append_and_merge(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    append(table.select("id", "s"), path)
    append(table.select("id", "x"), path)
    merged = read_merged(spark, path)
    assert sorted(merged.columns) == ["id", "s", "x"]
    assert merged.count() == 8
    assert merge_rows(table.select("id"), table.select("id", "n")).filter("n IS NULL").count() == 5
    append(table, f"{tmp_path}/p", partition_by=["s"])
    assert spark.read.parquet(f"{tmp_path}/p").count() == 4


def test_work_tables_lie_in_the_shared_folder(spark, table):
    copy = materialize(table, "copy")
    assert copy.inputFiles()[0].removeprefix("file://").startswith(shared_base(spark))
    assert sorted(copy.collect(), key=str) == sorted(table.collect(), key=str)


def test_numbers_follow_the_order_over_many_partitions(spark):
    rows = spark.range(5000).selectExpr("pmod(xxhash64(id), 700) AS k", "id").repartition(13)
    numbered = number_rows(rows, [F.col("k").desc(), "id"], "n")
    got = [(r["k"], r["id"]) for r in numbered.orderBy("n").collect()]
    assert got == sorted(((r["k"], r["id"]) for r in rows.collect()), key=lambda x: (-x[0], x[1]))
    assert [r["n"] for r in numbered.select("n").orderBy("n").collect()] == list(range(5000))
    assert number_rows(rows.limit(0), ["id"], "n").count() == 0


def test_null_keys_meet(spark):
    left, right = spark.createDataFrame([(1, "a"), (None, "b")], "k int, x string"), spark.createDataFrame([(None, "z")], "k int, y string")
    assert sorted(map(tuple, join_null_safe(left, right, ["k"], "left").collect()), key=str) == [(1, "a", None), (None, "b", "z")]


def test_snapshots(spark, table, tmp_path):
    path = f"{tmp_path}/s"
    sn.publish(table.limit(1), path, 1, committed_at="2024-01-01 00:00:00")
    sn.publish(table, path, 2, committed_at="2024-01-02 00:00:00")
    with pytest.raises(ValueError, match="version 2 of .* exists"):
        sn.publish(table.limit(2), path, 2)
    folders = len(list((tmp_path / "s" / "data").iterdir()))
    assert sn.read_as_of(spark, path, 1).count() == 1
    assert sn.read_as_of(spark, path).count() == 4
    assert sn.read_as_of(spark, path, at="2024-01-01 23:00:00").count() == 1
    assert sn.rollback(spark, path, 1) == 3
    assert len(list((tmp_path / "s" / "data").iterdir())) == folders  # one manifest row, no data
    with pytest.raises(ValueError, match="no such snapshot"):
        sn.rollback(spark, path, 7)
    assert sn.read_as_of(spark, path).count() == 1
    assert [(r["version"], r["operation"], r["row_count"]) for r in sn.history(spark, path, 2).collect()] == [(3, "rollback to 1", 1), (2, "write", 4)]
    with pytest.raises(ValueError, match="no such snapshot"):
        sn.read_as_of(spark, path, 9)
    with pytest.raises(ValueError, match="no such snapshot"):
        sn.read_as_of(spark, path, at="2023-01-01 00:00:00")
