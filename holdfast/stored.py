"""The tables a metrics worker keeps for the dashboards: ledger by day, current orders, metrics windows by day.

Dashboards read them instead of rolling the ledger up per request, and of the windows only the days of their range.
A worker's run is repeated when the files of its source have changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import binding
from holdfast.operators.rollup import rollup
from holdfast.session import scratch_path
from holdfast.sources.tables import DAY, append_table, read_table, write_metrics


@dataclass(frozen=True)
class Stored:
    """Where the tables of one worker run are, and the times they cover."""

    path: str
    times: binding.Times

    def metrics(self, spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Metrics windows; with a range those of its days, and of the days beside them for other time zones."""
        windows = spark.read.parquet(f"{self.path}/metrics_window")
        if start is not None:
            windows = windows.where(F.col(DAY) >= F.lit((start - timedelta(days=1)).date()))
        if end is not None:
            windows = windows.where(F.col(DAY) <= F.lit((end + timedelta(days=1)).date()))
        return windows.drop(DAY)

    def orders(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/orders")

    def ledger(self, spark: SparkSession, start: datetime | None = None) -> DataFrame:
        """Ledger rows; with a start those of its day and later ones."""
        rows = spark.read.parquet(f"{self.path}/ledger")
        return (rows if start is None else rows.where(F.col(DAY) >= F.lit(start.date()))).drop(DAY)


_runs: dict[tuple, Stored] = {}


def version(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a table's files from another: their names, sizes and times; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return tuple(files.agg(F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first())


def run_worker(spark: SparkSession, sf_dir: str) -> Stored:
    """Writes the tables: the ledger once, everything else from it."""
    path = scratch_path(spark, "stored")
    append_table(binding.ledger(spark, sf_dir), f"{path}/ledger", "occurred_at")
    rows = read_table(spark, f"{path}/ledger")
    binding.order_state(rows).write.parquet(f"{path}/orders")
    orders = spark.read.parquet(f"{path}/orders")
    times = binding.times(rows)
    write_metrics(spark, rollup(rows, orders, times.start, times.as_of, times.as_of), f"{path}/metrics_window")
    return Stored(path, times)


def stored(spark: SparkSession, sf_dir: str) -> Stored:
    """The tables of the newest worker run over a folder, which runs first if its events have changed."""
    key = (spark.sparkContext.applicationId, sf_dir, *version(spark, f"{sf_dir}/events.parquet"))
    if key not in _runs:
        _runs[key] = run_worker(spark, sf_dir)
    return _runs[key]
