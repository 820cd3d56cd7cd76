"""Trades and bars as streams."""

from __future__ import annotations

from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketflow.operators.bars import bar_aggregates, ohlcv
from marketflow.operators.trades import enrich_trades, flatten_trades, stg_trades
from marketflow.sources.tables import affected, insert_first, upsert_table


def _unique(raw: DataFrame, delay: str) -> DataFrame:
    # a watermark wants a zoned timestamp; the session zone is UTC
    timed = flatten_trades(raw).withColumn("_event", F.col("traded_at").cast("timestamp"))
    return timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark(["symbol", "trade_id"])


def unique_trades(raw: DataFrame, delay: str = "15 minutes") -> DataFrame:
    """One copy of each trade, of the first micro-batch that has it; of copies inside a batch any one.

    State is dropped once the watermark has passed a trade by ``delay``.
    """
    return _unique(raw, delay).drop("_event")


def stream_ohlcv(raw: DataFrame, delay: str = "15 minutes", width: str = "1 minute") -> DataFrame:
    """Bars of a stream: the open bar is updated until the watermark closes it."""
    bars = (
        _unique(raw, delay)
        .groupBy("symbol", F.window("_event", width).alias("_bucket"))
        .agg(*bar_aggregates())
    )
    start = F.col("_bucket.start").cast("timestamp_ntz").alias("minute")
    return bars.select("symbol", start, *[c for c in bars.columns if c not in ("symbol", "_bucket")])


def closed_bars(raw: DataFrame, delay: str = "15 minutes", width: str = "1 minute") -> DataFrame:
    """(symbol, minute, close) of each bar once the watermark has closed it, for a query in append mode.

    A symbol's bars come in order: those that close together are in one batch,
    later ones in a later batch.
    """
    return stream_ohlcv(raw, delay, width).select("symbol", "minute", "close")


def upsert_bars(bars: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep a table of bars by (symbol, minute) from a stream in update mode."""

    def store(batch: DataFrame, _batch_id: int) -> None:
        dated = batch.withColumn("bar_date", F.to_date("minute"))
        upsert_table(dated, path, ["symbol", "minute"], "bar_date")

    return (
        bars.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def maintain_facts(
    raw: DataFrame, trades_path: str, bars_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Upsert trades, then recompute the touched minutes from the trades table.

    Needs no watermark: a late trade still corrects its minute.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        trades = (
            enrich_trades(stg_trades(batch))
            .withColumn("trade_date", F.to_date("traded_at"))
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        try:
            insert_first(trades, trades_path, ["symbol", "trade_id"], "trade_date")
            minute = F.date_trunc("minute", "traded_at")
            touched = trades.select("symbol", "trade_date", minute.alias("_minute")).distinct()
            # the batch's days and its span of minutes reach the scan, the join picks the minutes
            low, high = trades.agg(F.min(minute), F.max(minute)).first()
            stored = affected(trades, trades_path, "trade_date").withColumn("_minute", minute)
            if low is not None:
                after = F.lit(high + timedelta(minutes=1)).cast("timestamp_ntz")
                stored = stored.filter((F.col("traded_at") >= F.lit(low).cast("timestamp_ntz")) & (F.col("traded_at") < after))
            whole = stored.join(touched, ["symbol", "trade_date", "_minute"], "left_semi")
            bars = ohlcv(whole).withColumn("bar_date", F.to_date("minute"))
            upsert_table(bars, bars_path, ["symbol", "minute"], "bar_date")
        finally:
            trades.unpersist()

    return (
        raw.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
