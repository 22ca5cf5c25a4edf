"""What the operators need from a cluster: a shared folder, and values kept per Python worker."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ridemart.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """URI of a new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, uri: str) -> None:
    """Remove a folder made by ``shared_folder`` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The rows as a table below a shared folder, read again: lineage ends here and Spark knows the true size."""
    df.write.option("compression", "lz4").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def per_worker(key: str, make: Callable[[], object]) -> object:
    """A value made once per Python worker process and reused by its later tasks."""
    store = sys.modules.setdefault("_ridemart_worker_values", types.ModuleType("_ridemart_worker_values"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)


def release_memory() -> None:
    """Give freed memory back to the system: a worker that Spark keeps for later tasks would otherwise hold on to its largest task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)
