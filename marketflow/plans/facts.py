"""Fact tables as compositions of operators.

``incremental_*`` give the content of a fact after one more incremental build;
on disk the same is done by ``sources.tables.upsert_table``, which rewrites only
the touched partitions.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.operators.bars import ohlcv
from marketflow.operators.book import orderbook_snapshots
from marketflow.operators.depth import depth_messages, enrich_levels, explode_levels, unique_depth_levels, unique_messages
from marketflow.operators.merge import incremental_slice, upsert, upsert_first
from marketflow.operators.trades import enrich_trades, stg_trades
from marketflow.sources.tables import affected, append, exists, insert_first, newest, persisted, upsert_table

LEVEL_KEYS = ["symbol", "last_update_id", "side", "level"]
ID_RANGE = 10_000_000


def fct_trades(raw_trades: DataFrame) -> DataFrame:
    return enrich_trades(stg_trades(raw_trades))


def fct_depth_snapshots(raw_depth: DataFrame) -> DataFrame:
    """Levels with notional; a repeated message counts once."""
    return enrich_levels(unique_depth_levels(raw_depth))


def fct_ohlcv_1min(trades: DataFrame) -> DataFrame:
    return ohlcv(trades)


def fct_orderbook_snapshots(raw_depth: DataFrame) -> DataFrame:
    return orderbook_snapshots(unique_depth_levels(raw_depth))


def incremental_trades(target: DataFrame, raw_trades: DataFrame, minutes: int = 5) -> DataFrame:
    """The slice comes before the dedup; of a stored and a new copy the earlier stays.

    A copy older than the slice that was never stored stays out.
    """
    recent = fct_trades(incremental_slice(raw_trades, target, "ingest_time", "ingest_time", minutes))
    return upsert_first(target, recent, ["trade_uid"], ["ingest_time"])


def incremental_depth(target: DataFrame, raw_depth: DataFrame, minutes: int = 5) -> DataFrame:
    recent = fct_depth_snapshots(
        incremental_slice(raw_depth, target, "ingest_time", "ingest_time", minutes)
    )
    return upsert_first(target, recent, LEVEL_KEYS, ["ingest_time"])


def incremental_bars(target: DataFrame, trades: DataFrame, minutes: int = 5) -> DataFrame:
    """The slice starts at a whole minute, so every touched minute is recomputed completely."""
    recent = incremental_slice(trades, target, "traded_at", "minute", minutes)
    return upsert(target, ohlcv(recent), ["symbol", "minute"])


def _since(df: DataFrame, time_col: str, path: str, partition: str, target_time: str, minutes: int) -> DataFrame:
    """Rows from ``minutes`` before the newest row of the table on.

    The newest time is read from the last partition and goes into the plan as a
    literal, so that the filter reaches the scan.
    """
    spark = df.sparkSession
    last = newest(spark, path, partition, target_time) if exists(spark, path) else None
    if last is None:
        return df
    return df.filter(F.col(time_col) >= F.lit(last - timedelta(minutes=minutes)).cast("timestamp_ntz"))


def refresh_trades_table(raw_trades: DataFrame, path: str, minutes: int = 5) -> None:
    """One incremental build of the trades table, by trade date.

    Only raw rows received since are read and deduplicated. The partition is a
    function of the trade, so a copy with another trade time counts as another
    day's row; ``quality`` finds such ids.
    """
    recent = _since(raw_trades, "ingest_time", path, "trade_date", "ingest_time", minutes)
    dated = fct_trades(recent).withColumn("trade_date", F.to_date("traded_at"))
    insert_first(dated, path, ["symbol", "trade_id"], "trade_date")


def _id_range() -> Column:
    return F.floor(F.col("last_update_id") / ID_RANGE)


def refresh_depth_table(raw_depth: DataFrame, path: str, minutes: int = 5) -> None:
    """One incremental build of the depth table.

    Partitioned by ranges of the snapshot id: a copy received on another day
    still meets its first version.
    """
    recent = _since(raw_depth, "ingest_time", path, "id_range", "ingest_time", minutes)
    spark = raw_depth.sparkSession
    messages = unique_messages(depth_messages(recent)).withColumn("id_range", _id_range())
    if not exists(spark, path):
        insert_first(_dealt_levels(messages), path, LEVEL_KEYS, "id_range", spread=True)
        return
    with persisted(messages):
        ids = affected(messages, path, "id_range").select(F.col("symbol").alias("_symbol"), F.col("last_update_id").alias("_id")).distinct()
        known = ids.withColumn("_known", F.lit(True))
        told = messages.join(known, (F.col("symbol") == F.col("_symbol")) & (F.col("last_update_id") == F.col("_id")), "left")
        # a message without a key may meet levels without one
        meets = F.col("_known").isNotNull() | F.col("symbol").isNull() | F.col("last_update_id").isNull()
        # of the others no level is stored: they move as messages, and come first, since the rest may replace files that tell what is known
        append(_dealt_levels(told.filter(~meets)), path, "id_range")
        insert_first(_levels(told.filter(meets)), path, LEVEL_KEYS, "id_range")


def _levels(messages: DataFrame) -> DataFrame:
    return enrich_levels(explode_levels(messages)).withColumn("id_range", _id_range())


def _dealt_levels(messages: DataFrame) -> DataFrame:
    """Levels dealt to the table's partitions as whole messages, which move half of what their levels would."""
    return _levels(messages.hint("rebalance", "id_range"))


def refresh_bars_table(trades: DataFrame, path: str, minutes: int = 5) -> None:
    """One incremental build of the minute bars, by date."""
    recent = _since(trades, "traded_at", path, "bar_date", "minute", minutes)
    dated = ohlcv(recent).withColumn("bar_date", F.to_date("minute"))
    upsert_table(dated, path, ["symbol", "minute"], "bar_date")
