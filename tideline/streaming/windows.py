"""Event-time windows over a stream or a table: breadth per window, sessions per entity.

All operators take a DataFrame that streams or one that does not, and return the same rows for
both as far as no row is late: a row that comes when the watermark, the latest time seen less the
allowed delay, has passed the end of its window is dropped by the stream, by Spark's definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _watched(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """Rows that have a time, as an instant in the session's time zone; watched for late ones in a stream."""
    timed = rows.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, delay) if rows.isStreaming else timed
    return timed.where(F.col(time).isNotNull())


def breadth_per_window(
    labels: DataFrame, size: str, slide: str | None = None, delay: str = "0 seconds", entity: str = "symbol", time: str = "Date"
) -> DataFrame:
    """``window_start, window_end, regime, entities, rows`` of tumbling windows, or sliding ones.

    ``entities`` counts different ones, exactly: rows are first reduced to one per window, regime
    and entity, so the state of a window is as large as its entities and not its rows. Append mode.
    """
    kept = _watched(labels, time, delay)
    windows = F.window(time, size, slide) if slide else F.window(time, size)
    by_entity = kept.groupBy(windows.alias("w"), "regime", entity).agg(F.count(F.lit(1)).alias("rows"))
    counted = by_entity.groupBy("w", "regime").agg(
        F.count(entity).alias("entities"), F.sum("rows").alias("rows")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "regime", "entities", "rows"
    )


def sessions(rows: DataFrame, gap: str, delay: str = "0 seconds", entity: str = "symbol", time: str = "Date") -> DataFrame:
    """``entity, session_start, session_end, rows``: rows of an entity closer to each other than ``gap``.

    A session ends ``gap`` after its last row. Append mode.
    """
    kept = _watched(rows, time, delay)
    grouped = kept.groupBy(F.session_window(time, gap).alias("w"), entity)
    return grouped.agg(F.count(F.lit(1)).alias("rows")).select(
        entity, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "rows"
    )


def bring_in(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a stream over all that its source has now into Parquet files, and stops.

    Called again with the same checkpoint it goes on where it stopped.
    """
    query = (
        stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", path).option("checkpointLocation", checkpoint).start()
    )
    query.awaitTermination()
