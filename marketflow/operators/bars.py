"""OHLCV bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.numbers import NARROW_SUM, PRODUCT, narrow_product, published, quotient, total, wide_product
from marketflow.functions.timecols import bucket


def bar_aggregates():
    """The aggregates of one bar; batch and streaming bars share them.

    Every buffer has a fixed width, so Spark aggregates by hash, partly before
    the shuffle: a bucket that holds a third of all trades travels as one row
    per map task.
    """
    price, quantity, order = F.col("price"), F.col("quantity"), F.col("trade_id")
    exact = narrow_product(price, quantity)
    # rows too large for an exact product are added apart, rounded one by one
    value, large = F.sum(exact), F.sum(F.when(exact.isNull(), wide_product(price, quantity)))
    whole = F.coalesce(total(published(value), large), published(value), large)
    return [
        published(F.min_by(price, order)).alias("open"),
        published(F.max_by(price, order)).alias("close"),
        published(F.max(price)).alias("high"),
        published(F.min(price)).alias("low"),
        published(F.sum(quantity)).alias("volume"),
        published(whole).alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.when(large.isNull(), quotient(value, F.sum(quantity), PRODUCT, NARROW_SUM)).otherwise(quotient(whole, F.sum(quantity))).alias("vwap"),
    ]


def ohlcv(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """Bars per (symbol, minute); ``minute`` is the start of the bucket of any ``width``."""
    return (
        trades.select(
            "symbol", bucket(F.col("traded_at"), width).alias("minute"), "trade_id", "price", "quantity"
        )
        .groupBy("symbol", "minute")
        .agg(*bar_aggregates())
    )


def for_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """The rows of one symbol; on a stored table the filter reaches the scan."""
    return df.filter(F.col("symbol") == symbol)


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct().orderBy("symbol")


def bars_with_dim(bars: DataFrame, dim_symbols: DataFrame) -> DataFrame:
    """Bars with the names of the symbol dimension; unknown symbols stay, without names.

    Spark broadcasts the dimension when its file is small, and joins by shuffle
    when it is not.
    """
    return bars.join(dim_symbols, "symbol", "left")
