"""Session settings, the shared work folder, and the clock argument used across the library."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Set at session start. Shuffle partitions are set from the number of cores on a cluster, see `build_session`.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_base: str | None = None
_shipped_to: set[str] = set()


SHUFFLE_BYTES = 128 << 20


def build_session(app: str = "plumbline", master: str | None = None, conf: Mapping[str, str] | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Create or get a session with the library's settings; `conf` overrides them.

    On a cluster shuffles start with a partition per SHUFFLE_BYTES of input if that is given, and at least four per core; AQE merges
    them to its advisory size and splits what is skewed.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CLUSTER_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    if not context.master.startswith("local") and context.getConf().get("spark.sql.shuffle.partitions") is None:
        spark.conf.set("spark.sql.shuffle.partitions", str(max(200, 4 * context.defaultParallelism, (input_bytes or 0) // SHUFFLE_BYTES)))
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application, for the functions that run in them."""
    application = spark.sparkContext.applicationId
    if application in _shipped_to:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="plumbline-code-"), "plumbline")
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped_to.add(application)


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A local session without that setting gets one temporary folder; a cluster session must name one.
    """
    global _local_base
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="plumbline-")
    return _local_base


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_base(spark)}/plumbline/{spark.sparkContext.applicationId}"


def new_work_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), named


def path_exists(spark: SparkSession, path: str) -> bool:
    files, named = _file_system(spark, path)
    return files.exists(named)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, named = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(named)] if files.exists(named) else []


def delete_path(spark: SparkSession, path: str) -> bool:
    files, named = _file_system(spark, path)
    return files.delete(named, True)


def drop_work(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this application, once no result that reads them is needed any more."""
    return delete_path(spark, _application_folder(spark))


def as_timestamp(as_of: str | datetime | Column | None) -> Column:
    """The reference time of a run; `None` means now (fixed per batch or micro-batch by Spark)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.to_timestamp(F.lit(str(as_of)))


def as_date(run_date: str | date) -> Column:
    """A run date; a malformed string raises here and not inside a job."""
    if isinstance(run_date, str):
        run_date = date.fromisoformat(run_date)
    return F.lit(run_date)
