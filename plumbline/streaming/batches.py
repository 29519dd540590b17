"""Tables written batch by batch: a replayed micro-batch adds nothing, and small files are gathered while readers go on.

Each micro-batch has a folder of its own, `stream=<query>/batches=<number>`. The query's id lasts as long as its checkpoint, so the
folder's name is the write key: a batch that is complete (its folder holds `_SUCCESS`) is not written again, one that was interrupted is
replaced. Compaction writes the rows of neighbouring batches to `batches=<first>-<last>` in files of about a given size; such a
folder stands for the batches inside its range from the moment it is complete. Readers that listed the old folders keep them until
`drop_covered`. Delta tables have all this themselves; there the batch number is given as the transaction's version.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.schemas import TRIGGER
from plumbline.session import delete_path, list_folder, path_exists
from plumbline.streaming.split import with_trigger

DONE = "_SUCCESS"
FILE_BYTES = 128 << 20
# Files whose bins are sent to all tasks; more meet their bins in a shuffle.
FEW_FILES = 100_000

Range = tuple[int, int]


def _ranges(spark: SparkSession, folder: str) -> list[Range]:
    """The complete folders of a stream, as ranges of batch numbers."""
    names = [re.fullmatch(r"batches=(\d+)(?:-(\d+))?", name) for name in list_folder(spark, folder)]
    found = [(int(m[1]), int(m[2] or m[1])) for m in names if m]
    return sorted(r for r in found if path_exists(spark, f"{folder}/{_name(r)}/{DONE}"))


def _name(batches: Range) -> str:
    first, last = batches
    return f"batches={first}" if first == last else f"batches={first}-{last}"


def _inside(small: Range, wide: Range) -> bool:
    return small != wide and wide[0] <= small[0] and small[1] <= wide[1]


def _live(ranges: Sequence[Range]) -> list[Range]:
    """Those that no wider complete folder stands for."""
    return [r for r in ranges if not any(_inside(r, other) for other in ranges)]


def _streams(spark: SparkSession, path: str) -> list[str]:
    return [f"{path}/{name}" for name in sorted(list_folder(spark, path)) if name.startswith("stream=")]


def append_once(batch: DataFrame, number: int, path: str, stream: str, *, partition_by: Sequence[str] = ("date_part",),
                fmt: str = "parquet") -> bool:
    """Add a micro-batch to a table unless it is there; whether it was written."""
    spark = batch.sparkSession
    if fmt == "delta":
        writer = batch.write.format("delta").mode("append").option("mergeSchema", "true")
        writer.option("txnAppId", stream).option("txnVersion", number).partitionBy(*partition_by).save(path)
        return True
    folder = f"{path}/stream={stream}"
    if any(first <= number <= last for first, last in _ranges(spark, folder)):
        return False
    batch.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(f"{folder}/{_name((number, number))}")
    return True


def split_batch(batch: DataFrame, number: int, clean_path: str, anomaly_path: str, stream: str, *, fmt: str = "parquet") -> None:
    """Add the clean and the anomalous rows of one micro-batch to their tables. The batch is computed once for both."""
    batch.persist()
    try:
        append_once(batch.filter("NOT is_anomaly"), number, clean_path, stream, fmt=fmt)
        append_once(batch.filter("is_anomaly"), number, anomaly_path, stream, fmt=fmt)
    finally:
        batch.unpersist()


def split_by_batch(flagged: DataFrame, clean_path: str, anomaly_path: str, checkpoint: str, *, trigger: str | None = TRIGGER,
                   fmt: str = "parquet") -> StreamingQuery:
    """Both tables from one query, so that the source is read and decoded once; a batch replayed after a failure adds nothing to either."""

    def write(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        split_batch(batch, number, clean_path, anomaly_path, stream, fmt=fmt)

    return with_trigger(flagged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write), trigger).start()


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a table of batches. A table without a complete batch needs its schema."""
    folders = [f"{s}/{_name(r)}" for s in _streams(spark, path) for r in _live(_ranges(spark, s))]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(*folders).drop("stream", "batches")


def files_of(table: DataFrame, *by: str) -> DataFrame:
    """(path, bytes, the columns `by`): the files behind a table that have rows. Only their footers are read."""
    return table.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), *by).distinct()


def packed(files: DataFrame, by: Sequence[str], target_bytes: int) -> DataFrame:
    """(path, bin): files of one partition share a bin until it holds about `target_bytes`."""
    before = Window.partitionBy(*by).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    return files.select("path", F.floor(filled / target_bytes).alias("bin"))


def _tail(spark: SparkSession, folder: str, target_bytes: int) -> list[Range]:
    """The newest folders back to the last one whose files are large already."""
    chosen: list[Range] = []
    for batches in reversed(_live(_ranges(spark, folder))):
        if batches[0] != batches[1]:
            table = spark.read.parquet(f"{folder}/{_name(batches)}")
            if not table.columns or (files_of(table).agg(F.avg("bytes")).first()[0] or 0) >= target_bytes / 2:
                break
        chosen.append(batches)
    return chosen[::-1]


def compact(spark: SparkSession, path: str, *, partition_by: Sequence[str] = ("date_part",), target_bytes: int = FILE_BYTES) -> int:
    """Gather the small files of each stream's newest batches, by partition and bytes; the number of folders replaced.

    Older folders with large files are left alone, so that a row is rewritten only while its file is small.
    """
    replaced = 0
    for folder in _streams(spark, path):
        batches = _tail(spark, folder, target_bytes)
        if len(batches) < 2:
            continue
        sources = [f"{folder}/{_name(r)}" for r in batches]
        target = f"{folder}/{_name((batches[0][0], batches[-1][1]))}"
        rows = spark.read.option("basePath", folder).parquet(*sources).drop("batches")
        files = files_of(rows, *partition_by)
        bins = packed(files, partition_by, target_bytes)
        bins = F.broadcast(bins) if files.count() <= FEW_FILES else bins
        placed = rows.select("*", F.col("_metadata.file_path").alias("path")).join(bins, "path")
        placed.repartition(*partition_by, "bin").drop("path", "bin").write.mode("overwrite").partitionBy(*partition_by).parquet(target)
        replaced += len(batches)
    return replaced


def drop_covered(spark: SparkSession, path: str) -> int:
    """Delete the folders that a compacted one stands for, once no reader uses them; how many these were."""
    dropped = 0
    for folder in _streams(spark, path):
        ranges = _ranges(spark, folder)
        for old in set(ranges) - set(_live(ranges)):
            delete_path(spark, f"{folder}/{_name(old)}")
            dropped += 1
    return dropped
