"""Alerts counted per event-time window over a folder that keeps growing.

State is kept per window until the watermark passes its end.  Each batch writes the windows that it
changed into a folder of its own, so that a repeated batch replaces its own rows and nothing else; the
latest counts of a window are those of the last batch that wrote it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WINDOW = "1 hour"
LATENESS = "10 minutes"


def alert_counts(events: DataFrame, alert: Column, *, time: str, group: str, value: str, width: str = WINDOW, late: str = LATENESS) -> DataFrame:
    """``start, <group>, alerts, peak`` of a batch table or a stream: rows for which ``alert`` is true.

    Rows without a time are in no window.  In a stream, a row whose window ended before the watermark
    (the latest time of the batches before, less ``late``) is dropped; all other late rows count.
    """
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, late).filter(alert)
    counted = timed.groupBy(F.window(time, width), group).agg(F.count(F.lit(1)).alias("alerts"), F.max(value).alias("peak"))
    return counted.select(F.col("window.start").alias("start"), group, "alerts", "peak")


def follow_alerts(counts: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Count what has arrived since the last run, then stop."""

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/batch={batch}")

    writer = counts.writeStream.outputMode("update").foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_counts(spark: SparkSession, output: str, group: str) -> DataFrame:
    """``start, <group>, alerts, peak`` as of the last batch of each window."""
    newest = F.max_by(F.struct("alerts", "peak"), "batch").alias("newest")
    return spark.read.parquet(output).groupBy("start", group).agg(newest).select("start", group, "newest.*")
