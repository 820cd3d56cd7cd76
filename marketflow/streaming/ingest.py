"""Unbounded input: read, route and store raw messages."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marketflow.sources.messages import MESSAGE_SCHEMA, route
from marketflow.sources.tables import append_batch, read_table


def stream_messages(
    spark: SparkSession, path: str, max_files: int = 100, fmt: str = "parquet"
) -> DataFrame:
    """Messages that arrive as files, a bounded number per batch."""
    return (
        spark.readStream.format(fmt)
        .schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )


def stream_kafka(spark: SparkSession, servers: str, topics: str, max_offsets: int = 5_000_000) -> DataFrame:
    """Messages of Kafka topics (needs the connector on the cluster); the broker's time is the receipt time."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select(
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").cast("timestamp_ntz").alias("ingest_time"),
        )
    )


COUNTERS = ["received", "accepted", "written", "ignored", "failed"]


def _outcomes() -> list:
    kind = F.col("route")
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(kind.isin("trades", "depth")).alias("accepted"),
        F.count_if(kind == "unknown").alias("ignored"),
        F.count_if(kind == "malformed").alias("failed"),
    ]


class IngestCounters(StreamingQueryListener):
    """Counters of a running ``write_raw``: what its batches observed, and what their sinks put in place.

    Register it with ``spark.streams.addListener``. A batch that is run again
    replaces its own figures, so nothing is counted twice.
    """

    def __init__(self) -> None:
        self.batches: dict[int, dict[str, int]] = {}
        self.state = "waiting"

    def wrote(self, batch_id: int, rows: int) -> None:
        self.batches.setdefault(batch_id, {})["written"] = rows

    def onQueryStarted(self, event) -> None:
        self.state = "running"

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("ingest")
        if seen is not None:
            self.batches.setdefault(event.progress.batchId, {}).update(seen.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.state = "failed" if event.exception else "ended"

    def totals(self) -> dict[str, int]:
        return {name: sum(b.get(name, 0) for b in list(self.batches.values())) for name in COUNTERS}


def counters(spark: SparkSession, path: str) -> DataFrame:
    """The counters of all batches that a stream stored at ``path``, added up; a restart goes on with them."""
    return read_table(spark, path).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS))


def write_raw(
    messages: DataFrame,
    trades_path: str,
    depth_path: str,
    checkpoint: str,
    unit: str = "day",
    counters_path: str | None = None,
    live: IngestCounters | None = None,
    **trigger,
) -> StreamingQuery:
    """One input, two append-only tables. A repeated batch replaces its own rows.

    ``unit`` is the span of one folder: days for a live feed, longer for a backfill of years.
    Counters per batch are observed on the stream itself (``ingest`` in its progress);
    ``live`` collects them, ``counters_path`` stores a row per batch, which a repeated
    batch replaces. Written rows are those of the files that were put in place.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        routed = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            written = 0
            for target, path in (("trades", trades_path), ("depth", depth_path)):
                rows = routed.filter(F.col("route") == target).select("record", "ingest_time")
                written += append_batch(rows, path, batch_id, unit)
            if live is not None:
                live.wrote(batch_id, written)
            if counters_path is not None:
                newest = F.max("ingest_time").alias("ingest_time")
                told = routed.agg(*_outcomes(), newest).withColumn("written", F.lit(written).cast("bigint"))
                append_batch(told.withColumn("batch_id", F.lit(batch_id).cast("bigint")), counters_path, batch_id, unit)
        finally:
            routed.unpersist()

    return (
        route(messages)
        .select("record", "ingest_time", "route")  # a batch is kept while its sinks read it, without the text
        .observe("ingest", *_outcomes())
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
