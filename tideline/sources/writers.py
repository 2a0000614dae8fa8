"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def write_panel(
    panel: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet table, partitioned if asked.

    Rows are first brought together by partition, so a partition gets few files; adaptive
    execution splits a partition that is far larger than the others and merges small ones.
    """
    keys = list(partition_by)
    if keys:
        panel = panel.hint("rebalance", *keys)
    writer = panel.write.mode(mode)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def save_result(result: DataFrame, base: str, short: bool = True) -> None:
    """A result table as Parquet under ``base`` and as headed CSV under ``base_csv``.

    ``short`` results have a row per label, threshold or the like, and go to one file each.
    Others grow with the entities or dates and keep the partitions they come in, which
    adaptive execution makes as few as their size allows. The CSV form is written from the
    Parquet form, so the result is computed once.
    """
    spark = result.sparkSession
    (result.coalesce(1) if short else result).write.mode("overwrite").parquet(base)
    saved = spark.read.schema(result.schema).parquet(base)
    (saved.coalesce(1) if short else saved).write.mode("overwrite").option("header", True).csv(
        base + "_csv"
    )


class Results:
    """Named result tables saved under one folder.

    Saving a short table is mostly waiting, so tables that nothing else waits for are saved
    a few at a time.
    """

    def __init__(self, out: str, at_once: int = 4) -> None:
        self.out = out
        self.at_once = at_once
        self.names: list[str] = []
        self._pending: list[tuple[DataFrame, str, bool]] = []

    def save(self, name: str, result: DataFrame, short: bool = True) -> None:
        """Notes a result, to be saved by :meth:`flush`."""
        self.names.append(name)
        self._pending.append((result, f"{self.out}/{name}", short))

    def save_now(self, name: str, result: DataFrame, short: bool = True) -> DataFrame:
        """Saves a result and returns it as saved."""
        self.names.append(name)
        save_result(result, f"{self.out}/{name}", short)
        return self.read(name, result.sparkSession)

    def flush(self) -> None:
        pending, self._pending = self._pending, []
        with ThreadPoolExecutor(self.at_once) as pool:
            for saving in [pool.submit(save_result, *task) for task in pending]:
                saving.result()

    def read(self, name: str, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.out}/{name}")


def save_csv(result: DataFrame, path: str) -> None:
    """A short result as one headed CSV file."""
    result.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_json(summary: DataFrame, path: str) -> None:
    """A one-row summary as one JSON record, NULL fields included."""
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
