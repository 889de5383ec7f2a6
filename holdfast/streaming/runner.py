"""Running streams to the end of their input, and sinks that survive a replayed batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH = "batch_id"


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Writes one micro-batch under its own id; a replay replaces it instead of adding to it."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None, before: int | None = None) -> DataFrame:
    """Everything the batches wrote, with the batch id; only batches before one when given."""
    try:
        found = spark.read.parquet(path)
    except Exception as e:  # the analysis error class differs between session kinds
        # partitioned folders of empty batches hold no file
        if schema is None or not any(kind in str(e) for kind in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())]))
    return found if before is None else found.where(f"{BATCH} < {before}")


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What one batch wrote; empty when it wrote nothing there."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id}")
    except Exception as e:  # the analysis error class differs between session kinds
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def run_available(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Processes all input there is, batch by batch, and stops.

    Progress lives in the checkpoint, and a failing batch fails the query, so the next
    run repeats exactly that batch under the same id.
    """
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
