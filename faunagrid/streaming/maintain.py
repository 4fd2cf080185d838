"""A species store kept up to date from a stream of occurrence files.

Records are additive, so that each micro-batch adds its own counts; the indicators of a cell
depend on all its records and are recomputed from the counts when they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faunagrid.plans.store import KEYS, CellFunction, base_records


def follow(source: DataFrame, path: str, checkpoint: str, box: Sequence[float] | None = None, cell_fn: CellFunction | None = None) -> StreamingQuery:
    """Starts adding a stream's records to ``path``. A batch that is repeated replaces its own folder."""

    def add(batch: DataFrame, number: int) -> None:
        base_records(batch, box, cell_fn).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return source.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def base_of(spark: SparkSession, path: str) -> DataFrame:
    """All batches' records, summed: the base of both layers."""
    return spark.read.parquet(path).groupBy(*KEYS).agg(F.sum("records").alias("records"))
