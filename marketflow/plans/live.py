"""Live views: computed on read, for an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions import labels
from marketflow.functions.timecols import at, before
from marketflow.operators.bars import ohlcv
from marketflow.operators.metrics import latest_per_symbol, market_metrics
from marketflow.operators.trades import live_window, stg_trades

LIVE_MINUTES = 120


def raw_live_trades(
    raw_trades: DataFrame, as_of: datetime | Column, minutes: int = LIVE_MINUTES
) -> DataFrame:
    """Deduplicated trades of the window. The window is applied before the dedup."""
    return stg_trades(raw_trades, traded_since=before(as_of, minutes=minutes), traded_until=at(as_of))


def ohlcv_live(trades: DataFrame, as_of: datetime | Column, minutes: int = LIVE_MINUTES) -> DataFrame:
    return ohlcv(live_window(trades, "traded_at", as_of, minutes))


def market_metrics_live(
    trades: DataFrame, as_of: datetime | Column, minutes: int = LIVE_MINUTES
) -> DataFrame:
    """Metrics over the bars of the window."""
    return market_metrics(ohlcv_live(trades, as_of, minutes))


def kpi_strip(bars: DataFrame, metrics: DataFrame, books: DataFrame) -> DataFrame:
    """Latest close, RSI, volatility, spread and imbalance per symbol.

    One row per symbol on every side when they are joined.
    """
    last_close = latest_per_symbol(bars).select("symbol", F.col("close").alias("price"))
    last = latest_per_symbol(metrics).select(
        "symbol", "price_change_pct_5min", "rsi_14", "realized_volatility"
    )
    book = books.select("symbol", "spread_bps", "imbalance")
    return last_close.join(last, "symbol", "left").join(book, "symbol", "left")


def trader_verdict(movers: DataFrame, pressure: DataFrame) -> DataFrame:
    """Plain reading of the flow, the RSI and the volume per symbol."""
    zone = labels.rsi_zone(F.col("rsi_14"))
    label = F.coalesce(F.col("pressure"), F.lit("balanced"))
    return movers.join(pressure, "symbol", "left").select(
        "symbol",
        label.alias("pressure"),
        zone.alias("rsi_zone"),
        F.when(F.col("is_volume_anomaly"), "abnormal").otherwise("normal").alias("volume_state"),
        labels.verdict(label, zone, F.col("is_volume_anomaly")).alias("verdict"),
    )


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a plan as a view for SQL users: nothing is computed until it is read."""
    df.createOrReplaceTempView(name)
    return df
