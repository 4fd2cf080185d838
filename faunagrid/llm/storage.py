"""Shared scratch storage, tables, and Python steps that leave their workers lean."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faunagrid.scratch import drop_path, new_path

#: What Spark hands to a Python worker at a time: texts are whole, so both bounds are below its own.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to shared storage and read again: computed once, and not lost with an executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def dropped(*frames: DataFrame) -> None:
    """Deletes what ``stored`` wrote for frames that nothing reads any more."""
    for df in frames:
        drop_path(df.sparkSession, df._stored_at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release() -> None:
    """Gives freed memory back to the system. Workers live on between tasks, so what they keep adds up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def arrow_map(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``, after each task of which the worker gives back what it freed."""

    @functools.wraps(step)
    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            release()

    return df.mapInArrow(lean, schema)


def with_long(df: DataFrame, key: str, into: str) -> DataFrame:
    """``df`` with ``into``: whole numbers in the order of ``key``, which are the key itself where it is one. Null stays null.

    Other keys are sorted in ranges and numbered by range and place, once for each different key.
    """
    if isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df.withColumn(into, F.col(key).cast("long"))
    keys = df.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    numbered = stored(keys.repartitionByRange("_key").sortWithinPartitions("_key").withColumn(into, F.monotonically_increasing_id()), "keys")
    return df.join(numbered, F.col(key) == F.col("_key"), "left").drop("_key")
