"""Rows per time window, as a stream and as its batch twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counted(rows: DataFrame, width: str) -> DataFrame:
    counts = rows.groupBy(F.window("at", width)).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "n",
                         F.round(F.col("n") / (F.unix_timestamp("window.end") - F.unix_timestamp("window.start")), 6)
                         .alias("rate_per_sec"))


def throughput(rows: DataFrame, time: Column, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows per window of a stream; a window is final once the watermark has passed its end."""
    return _counted(rows.select(time.cast("timestamp").alias("at")).withWatermark("at", delay), width)


def throughput_batch(rows: DataFrame, time: Column, width: str = "1 hour") -> DataFrame:
    """The same figures over a stored table, the last window included."""
    return _counted(rows.select(time.cast("timestamp").alias("at")), width)


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Read what is there, append the final windows to ``path`` and stop."""
    query = (stream.writeStream.trigger(availableNow=True).outputMode("append").format("parquet")
             .option("checkpointLocation", checkpoint).option("path", path).start())
    query.awaitTermination()
