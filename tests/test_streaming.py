from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from plumbline.plans.transactions import load_transactions, messages
from plumbline.sources.events import decode, drop_repeats, read_messages
from plumbline.streaming import batches, split, watch
from tests.conftest import DATA

AS_OF = "2024-01-31 00:00:00"


def write_messages(spark, path, part, parts):
    rows = messages(load_transactions(spark, DATA).filter(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == part))
    rows.coalesce(2).write.mode("append").text(path)


def counts(df):
    return {(r["date_part"], r["is_anomaly"]): r["n"] for r in df.groupBy("date_part", "is_anomaly").agg(F.count(F.lit(1)).alias("n")).collect()}


def run(spark, source, target):
    stream = split.flagged_stream(read_messages(spark, "text", path=source), as_of=AS_OF)
    split.split_once(stream, f"{target}/table", f"{target}/checkpoint", trigger=None).awaitTermination()


def both_sides(spark, target):
    return split.read_side(spark, f"{target}/table", split.CLEAN).unionByName(split.read_side(spark, f"{target}/table", split.ANOMALIES))


def test_stream_equals_batch_and_restart_repeats_nothing(spark, flagged, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    write_messages(spark, source, 0, 2)
    run(spark, source, target)
    first = both_sides(spark, target).count()
    assert 0 < first < 1000
    run(spark, source, target)  # nothing new
    assert both_sides(spark, target).count() == first
    write_messages(spark, source, 1, 2)
    run(spark, source, target)
    assert counts(both_sides(spark, target)) == counts(flagged)
    assert split.read_side(spark, f"{target}/table", split.ANOMALIES).filter("NOT is_anomaly").isEmpty()


def test_reading_one_side_and_date_prunes(spark, flagged, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    write_messages(spark, source, 0, 1)
    run(spark, source, target)
    day = split.read_side(spark, f"{target}/table", split.ANOMALIES).filter("date_part = date'2099-01-01'")
    assert day.count() == 13
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan


def test_two_sinks_and_few_files(spark, flagged, tmp_path):
    source = f"{tmp_path}/in"
    write_messages(spark, source, 0, 1)
    stream = split.flagged_stream(read_messages(spark, "text", path=source), as_of=AS_OF)
    for query in split.split_in_two(stream, f"{tmp_path}/clean", f"{tmp_path}/bad", f"{tmp_path}/cp", trigger=None):
        query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/clean").count() == 892
    assert spark.read.parquet(f"{tmp_path}/bad").count() == 108
    split.write_sink(stream, f"{tmp_path}/few", f"{tmp_path}/cp/few", trigger=None, files=1).awaitTermination()
    few = spark.read.parquet(f"{tmp_path}/few")
    assert few.count() == 1000
    assert few.select(F.input_file_name().alias("f"), "date_part").distinct().count() == 32


def test_rows_without_a_date_are_kept(spark, tmp_path):
    spark.createDataFrame([("junk",), ('{"event_id": "a", "timestamp": "garbage"}',)], "value string").coalesce(1).write.text(f"{tmp_path}/in")
    run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    kept = split.read_side(spark, f"{tmp_path}/out/table", split.ANOMALIES)
    assert kept.count() == 2
    assert kept.filter("date_part IS NULL").count() == 2


def test_repeats_on_a_stream(spark, tmp_path):
    record = json.dumps({"event_id": "a", "timestamp": "2024-01-01T00:00:00+00:00"})
    spark.createDataFrame([(record,), (record,), ("junk",), ("junk",)], "value string").write.text(f"{tmp_path}/in")
    stream = drop_repeats(decode(read_messages(spark, "text", path=f"{tmp_path}/in")), watermark="10 minutes")
    split.write_sink(stream, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None).awaitTermination()
    assert sorted(str(r[0]) for r in spark.read.parquet(f"{tmp_path}/out").select("event_id").collect()) == ["None", "None", "a"]


def stream_of(spark, path, **options):
    return split.flagged_stream(read_messages(spark, "text", path=path, options=options), as_of=AS_OF)


def rows_of(spark, path, schema):
    return sorted(str(r) for r in batches.read_batches(spark, path, schema).select("event_id", "amount", "date_part", "malformed").collect())


def test_replayed_batches_add_nothing(spark, flagged, tmp_path):
    clean, bad = f"{tmp_path}/clean", f"{tmp_path}/bad"
    for number, part in enumerate((flagged.filter("amount < 100"), flagged.filter("amount >= 100 OR amount IS NULL"))):
        for _ in range(2):
            batches.split_batch(part, number, clean, bad, "s")
    assert counts(batches.read_batches(spark, clean).unionByName(batches.read_batches(spark, bad))) == counts(flagged)
    assert batches.append_once(flagged, 2, clean, "s") and not batches.append_once(flagged, 2, clean, "s")
    assert batches.append_once(flagged, 0, clean, "another")  # a query with another checkpoint has batches of its own


def test_an_interrupted_batch_is_replaced_and_not_read(spark, flagged, tmp_path):
    path = f"{tmp_path}/table"
    flagged.limit(10).write.partitionBy("date_part").parquet(f"{path}/stream=s/batches=0")
    (tmp_path / "table/stream=s/batches=0/_SUCCESS").unlink()
    assert batches.read_batches(spark, path, flagged.schema).isEmpty()
    assert batches.append_once(flagged, 0, path, "s")
    assert counts(batches.read_batches(spark, path)) == counts(flagged)


def test_two_tables_from_one_query_and_compaction(spark, flagged, tmp_path):
    source = f"{tmp_path}/in"
    write_messages(spark, source, 0, 2)
    write_messages(spark, source, 1, 2)
    clean, bad = f"{tmp_path}/clean", f"{tmp_path}/bad"
    batches.split_by_batch(stream_of(spark, source, maxFilesPerTrigger="1"), clean, bad, f"{tmp_path}/cp", trigger=None).awaitTermination()
    before = rows_of(spark, clean, flagged.schema)
    old = batches.read_batches(spark, clean)
    files = batches.files_of(old).count()
    assert (len(before), old.count(), batches.read_batches(spark, bad).count()) == (892, 892, 108)
    assert batches.compact(spark, clean) >= 2
    assert batches.compact(spark, clean) == 0  # one folder is left
    assert old.count() == 892  # a reader goes on with the files that it has listed
    assert rows_of(spark, clean, flagged.schema) == before
    assert batches.files_of(batches.read_batches(spark, clean)).count() < files
    assert batches.drop_covered(spark, clean) >= 2
    assert rows_of(spark, clean, flagged.schema) == before

    batches.split_by_batch(stream_of(spark, source), clean, bad, f"{tmp_path}/cp", trigger=None).awaitTermination()
    assert rows_of(spark, clean, flagged.schema) == before
    stream = next(p.name for p in (tmp_path / "clean").iterdir() if p.name.startswith("stream=")).removeprefix("stream=")
    assert not batches.append_once(flagged, 0, clean, stream)  # a batch that a compacted folder stands for


def test_compaction_leaves_large_files_alone_and_fills_files_by_bytes(spark, flagged, tmp_path):
    path = f"{tmp_path}/table"
    some = flagged.filter("date_part < '2024-01-04'").coalesce(1)
    for number in range(4):
        batches.append_once(some, number, path, "s")
    size = batches.files_of(batches.read_batches(spark, path)).agg(F.max("bytes")).first()[0]
    assert batches.compact(spark, path, target_bytes=2 * size) == 4
    table = batches.read_batches(spark, path)
    assert table.count() == 4 * some.count()
    per_day = batches.files_of(table, "date_part").groupBy("date_part").count().collect()
    assert len(per_day) == 3 and all(r["count"] <= 3 for r in per_day)
    batches.append_once(some, 4, path, "s")
    batches.append_once(some, 5, path, "s")
    assert batches.compact(spark, path, target_bytes=100) == 2  # the first four have files of that size


def test_bins_follow_bytes(spark):
    files = spark.createDataFrame([("a", f"f{k}", 40) for k in range(10)] + [("b", "g", 500), (None, "h", 1)], "d string, path string, bytes long")
    bins = {r["path"]: r["bin"] for r in batches.packed(files, ["d"], 100).collect()}
    assert [bins[f"f{k}"] for k in range(10)] == [40 * k // 100 for k in range(10)]
    assert bins["g"] == bins["h"] == 0


def test_reports_of_batches(spark, tmp_path):
    source = f"{tmp_path}/in"
    write_messages(spark, source, 0, 2)
    write_messages(spark, source, 1, 2)
    arriving = watch.observe_arrivals(read_messages(spark, "text", path=source, options={"maxFilesPerTrigger": "1"}), "_metadata.file_modification_time")
    flagged = watch.observe_verdicts(split.flagged_stream(arriving, as_of=AS_OF))
    times = watch.BatchTimes()
    spark.streams.addListener(times)
    try:
        query = split.split_once(flagged, f"{tmp_path}/out", f"{tmp_path}/cp", trigger=None)
        watch.wait_for_all([query])
        times.settle(query)
    finally:
        spark.streams.removeListener(times)
    rows = times.table(spark).collect()
    assert sum(r["n_messages"] for r in rows) == 1000 and sum(r["n_anomalies"] for r in rows) == 108
    assert len(rows) == len({r["batch"] for r in rows}) >= 2
    for r in rows:
        assert 0 < r["batch_seconds"] <= r["latency_seconds"] + 1
        assert r["committed_at"] - r["first_arrival"] < timedelta(minutes=5)


def test_a_failing_query_stops_the_others(spark, tmp_path):
    source = f"{tmp_path}/in"
    write_messages(spark, source, 0, 1)
    failing = stream_of(spark, source).select(F.raise_error(F.lit("broken sink")).alias("x"))
    bad = failing.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp1").trigger(processingTime="1 second").start(f"{tmp_path}/o1")
    good = split.split_once(stream_of(spark, source), f"{tmp_path}/o2", f"{tmp_path}/cp2", trigger="1 second")
    with pytest.raises(StreamingQueryException):
        watch.wait_for_all([good, bad])
    assert not good.isActive and not bad.isActive
