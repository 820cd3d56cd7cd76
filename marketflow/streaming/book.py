"""Order-book metrics as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.operators.book import message_snapshots
from marketflow.operators.depth import depth_messages


def stream_orderbook(raw: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """One row per snapshot. Metrics come from the arrays of the message itself;
    only the removal of repeated messages keeps state."""
    # a watermark wants a zoned timestamp; the session zone is UTC
    timed = depth_messages(raw).withColumn("_received", F.col("ingest_time").cast("timestamp"))
    unique = timed.withWatermark("_received", delay).dropDuplicatesWithinWatermark(
        ["symbol", "last_update_id"]
    )
    return message_snapshots(unique)
