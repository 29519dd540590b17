"""Continuous split of flagged events into clean and anomalous tables, partitioned by date."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from plumbline.operators.rules import flag_transactions
from plumbline.schemas import TRIGGER
from plumbline.sources.events import decode

CLEAN, ANOMALIES = "clean", "anomalies"


def flagged_stream(messages: DataFrame, *, as_of: str | datetime | Column | None = None) -> DataFrame:
    """Decode and flag; `as_of=None` compares event times with the time of the micro-batch."""
    return flag_transactions(decode(messages, ingest_ts=as_of), as_of)


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """A processing-time interval, or everything available now when `trigger` is None."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def write_sink(events: DataFrame, path: str, checkpoint: str, *, where: Column | str | None = None, fmt: str = "parquet",
               partition_by: tuple[str, ...] = ("date_part",), trigger: str | None = TRIGGER, files: int | None = None,
               options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Append a stream to a partitioned table with its own checkpoint; `where` filters before writing.

    Without `files` every task writes its own rows and nothing is shuffled, which suits a live stream of one or two dates. For
    a backfill over many dates set `files`: rows are then gathered into at most that many files per partition and micro-batch,
    by a hash of the event id, so that one large date is still written by several tasks.
    """
    out = events.filter(where) if where is not None else events
    if files is not None:
        out = out.repartition(*partition_by, F.pmod(F.xxhash64("event_id"), F.lit(files)))
    writer = (
        out.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    )
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    return with_trigger(writer, trigger).start(path)


def split_once(flagged: DataFrame, path: str, checkpoint: str, *, trigger: str | None = TRIGGER, fmt: str = "parquet",
               files: int | None = None) -> StreamingQuery:
    """Both sides in one query: the source is read and decoded once and the side is a partition of the table.

    `read_side` prunes to one side. The file sink's own log makes a repeated micro-batch harmless.
    """
    sided = flagged.select("*", F.when(F.col("is_anomaly"), ANOMALIES).otherwise(CLEAN).alias("side"))
    return write_sink(sided, path, checkpoint, fmt=fmt, partition_by=("side", "date_part"), trigger=trigger, files=files)


def read_side(spark: SparkSession, path: str, side: str, *, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).filter(F.col("side") == side).drop("side")


def split_in_two(flagged: DataFrame, clean_path: str, anomaly_path: str, checkpoint: str, *, trigger: str | None = TRIGGER,
                 fmt: str = "parquet") -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent queries with a table and a checkpoint each; each reads the source for itself."""
    return (
        write_sink(flagged, clean_path, f"{checkpoint}/{CLEAN}", where=~F.col("is_anomaly"), fmt=fmt, trigger=trigger),
        write_sink(flagged, anomaly_path, f"{checkpoint}/{ANOMALIES}", where=F.col("is_anomaly"), fmt=fmt, trigger=trigger),
    )
