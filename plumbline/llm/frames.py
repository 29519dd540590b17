"""Frame helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of one Arrow batch: with few long texts the bytes bound the memory of a Python worker.
BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that tasks exchange with their Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it many times in `body`: a column expression alone would be repeated for each use."""
    return F.element_at(F.transform(F.array(value), body), 1)
