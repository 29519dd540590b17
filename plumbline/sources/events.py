"""Event records: reading a message source, and decoding JSON messages into typed columns."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.scalars import truth
from plumbline.schemas import ALLOWED_KEYS, EVENT_DDL, REQUIRED_KEYS
from plumbline.session import as_timestamp


def read_messages(spark: SparkSession, fmt: str = "kafka", *, path: str | None = None, schema: str | None = None,
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """An unbounded source of messages.

    For `kafka` pass `kafka.bootstrap.servers` and `subscribe` in `options`; reading starts at the latest offset unless
    `startingOffsets` says otherwise. File formats take a `path` (and a `schema` where the format needs one).
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "latest")
    if schema:
        reader = reader.schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path) if path else reader.load()


def payload_keys(value: Column) -> Column:
    """Top-level keys of a JSON object; NULL for anything else."""
    return F.json_object_keys(value)


def _texts(names: list[str]) -> Column:
    return F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")


def _if_unusual(keys: Column, found: Column) -> Column:
    """Most payloads hold exactly the required keys in order; those need no set difference."""
    return F.when(keys == _texts(REQUIRED_KEYS), _texts([])).otherwise(F.array_sort(found))


def unexpected_keys(keys: Column) -> Column:
    return _if_unusual(keys, F.array_except(keys, _texts(ALLOWED_KEYS)))


def missing_keys(keys: Column) -> Column:
    return _if_unusual(keys, F.array_except(_texts(REQUIRED_KEYS), keys))


def decode(messages: DataFrame, *, value: str = "value", ingest_ts: str | datetime | Column | None = None) -> DataFrame:
    """The event columns of each message, plus time, date and payload-key columns.

    A message that is no single JSON object, and one whose amount is no number, is `malformed`: it keeps its text in `raw_value` and
    reaches the anomaly side, so nothing is lost or taken for clean. What cannot be read is NULL; of several objects in one message
    the first is read. Keys are read from the text itself: a fixed schema would silently drop the ones it does not know.
    """
    text = F.col(value).cast("string")
    # As a one-row generator the parsing is not merged into later filters, which would repeat it for every field they use.
    one_value = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    record = F.struct(F.from_json(text, EVENT_DDL).alias("d"), payload_keys(text).alias("keys"), one_value.alias("one"), text.alias("text"))
    parsed = messages.select(F.inline_outer(F.array(record))).select("d.*", "keys", "one", "text")
    event_ts = F.try_to_timestamp(F.col("timestamp"))
    lost_amount = F.when(F.col("amount").isNull(), F.get_json_object("text", "$.amount").isNotNull())
    malformed = ~truth(F.col("one")) | F.col("keys").isNull() | truth(lost_amount)
    return parsed.select(
        *[F.col(name) for name in ALLOWED_KEYS],
        event_ts.alias("event_ts"),
        as_timestamp(ingest_ts).alias("ingest_ts"),
        F.to_date(event_ts).alias("date_part"),
        unexpected_keys(F.col("keys")).alias("unexpected_keys"),
        missing_keys(F.col("keys")).alias("missing_keys"),
        malformed.alias("malformed"),
        F.when(malformed, F.col("text")).alias("raw_value"),
    )


def drop_repeats(events: DataFrame, *, watermark: str | None = None) -> DataFrame:
    """Optional de-duplication by event id. Records without an id are kept; each gets a key of its own, so that they do not
    meet in one task.

    On a stream pass a watermark delay: the ids seen are then forgotten once it has passed.
    """
    keyed = events.withColumn("_key", F.coalesce(F.col("event_id"), F.uuid()))
    if watermark is None:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    return keyed.withWatermark("ingest_ts", watermark).dropDuplicatesWithinWatermark(["_key"]).drop("_key")
