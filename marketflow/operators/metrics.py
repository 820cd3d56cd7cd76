"""Market metrics per bar: changes, rolling statistics, RSI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.numbers import difference, published, quotient, ratio
from marketflow.operators.rsi import gains_losses, rsi_value, wilder
from marketflow.operators.series import BLOCK_ROWS, block_window, in_blocks, numbered, own_rows
from marketflow.operators.trades import first_received

# Frame lengths in rows and the anomaly threshold in deviations.
CHANGE_ROWS = (1, 5, 15)
VOLUME_ROWS = 30
VOLATILITY_ROWS = 14
ANOMALY_DEVIATIONS = 3


def log_return() -> Column:
    """Natural log of the ratio to the previous bar (the previous row, not the previous minute)."""
    return F.ln(ratio(F.col("close"), F.lag("close").over(block_window())))


def change_pct(rows: int) -> Column:
    earlier = F.lag("close", rows).over(block_window())
    return quotient(difference(F.col("close"), earlier), earlier, scale=100)


def volume_statistics() -> list[Column]:
    frame = block_window().rowsBetween(-(VOLUME_ROWS - 1), 0)
    volume = F.col("volume").cast("double")
    return [
        F.avg(volume).over(frame).alias("volume_avg_30"),
        F.stddev_samp(volume).over(frame).alias("volume_std_30"),
    ]


def zscore() -> Column:
    """NULL where the deviation is unknown or zero."""
    return (F.col("volume").cast("double") - F.col("volume_avg_30")) / F.nullif(
        F.col("volume_std_30"), F.lit(0.0)
    )


def is_volume_anomaly() -> Column:
    return F.coalesce(F.abs(zscore()) > ANOMALY_DEVIATIONS, F.lit(False))


def _blocks(bars: DataFrame, block_rows: int) -> DataFrame:
    return in_blocks(numbered(bars), block_rows)


def log_returns(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    blocks = _blocks(bars.select("symbol", "minute", "close"), block_rows)
    delta = difference(F.col("close"), F.lag("close").over(block_window()))
    return own_rows(
        blocks.select(
            "symbol", "minute", "rn", "close", log_return().alias("log_return"), delta.alias("delta"), "_own"
        )
    )


def price_changes(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    blocks = _blocks(bars.select("symbol", "minute", "close"), block_rows)
    changes = [change_pct(k).alias(f"price_change_pct_{k}min") for k in CHANGE_ROWS]
    return own_rows(blocks.select("symbol", "minute", "close", *changes, "_own"))


def rolling_volume(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rolling volume statistics with the z-score and the anomaly flag of the bar itself."""
    blocks = _blocks(bars.select("symbol", "minute", "volume"), block_rows)
    rolled = own_rows(blocks.select("symbol", "minute", "volume", *volume_statistics(), "_own"))
    return rolled.select(
        "*", zscore().alias("volume_zscore"), is_volume_anomaly().alias("is_volume_anomaly")
    )


def realized_volatility(
    bars: DataFrame, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    blocks = _blocks(bars.select("symbol", "minute", "close"), block_rows)
    returns = blocks.withColumn("log_return", log_return())
    frame = block_window().rowsBetween(-(VOLATILITY_ROWS - 1), 0)
    return own_rows(
        returns.select(
            "symbol",
            "minute",
            F.stddev_samp("log_return").over(frame).alias("realized_volatility"),
            "_own",
        )
    )


def market_metrics(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All metrics of a bar in one row.

    Every window shares the partitioning (symbol, block), so after the split
    into blocks the whole view is one shuffle.
    """
    blocks = _blocks(bars.select("symbol", "minute", "close", "volume"), block_rows)
    returns = gains_losses(blocks.withColumn("_log_return", log_return()))
    volatility = block_window().rowsBetween(-(VOLATILITY_ROWS - 1), 0)
    rolled = own_rows(
        returns.select(
            "*",
            *[change_pct(k).alias(f"_change_{k}") for k in CHANGE_ROWS],
            *volume_statistics(),
            F.stddev_samp("_log_return").over(volatility).alias("_volatility"),
        )
    )
    smoothed = wilder(rolled, block_rows=block_rows)
    return smoothed.select(
        "symbol",
        "minute",
        "close",
        "volume",
        *[F.col(f"_change_{k}").alias(f"price_change_pct_{k}min") for k in CHANGE_ROWS],
        published(zscore()).alias("volume_zscore"),
        is_volume_anomaly().alias("is_volume_anomaly"),
        published(F.col("_volatility")).alias("realized_volatility"),
        published(rsi_value(F.col("avg_gain"), F.col("avg_loss"))).alias("rsi_14"),
    )


def latest_per_symbol(df: DataFrame) -> DataFrame:
    """The row of the newest minute of each symbol."""
    newest_first = [F.col("minute").desc()]
    return first_received(df, ["symbol"], newest_first)


def top_movers(metrics: DataFrame, rows: int = 5) -> DataFrame:
    """Latest row per symbol, the largest absolute change first, unknown changes last."""
    change = f"price_change_pct_{rows}min"
    return (
        latest_per_symbol(metrics)
        .select("symbol", change, "rsi_14", "is_volume_anomaly")
        .orderBy(F.abs(change).desc_nulls_last(), "symbol")
    )


def recent_bars(bars: DataFrame, n: int = 5) -> DataFrame:
    return bars.orderBy(F.col("minute").desc(), "symbol").limit(n)


def cross_performance(bars: DataFrame) -> DataFrame:
    """Close of every bar as percent of the symbol's first close.

    The first close is an aggregate with a small result; Spark joins it by
    broadcast or splits the skewed side, whichever the sizes call for.
    """
    first = bars.groupBy("symbol").agg(F.min_by("close", "minute").alias("_first"))
    return bars.join(first, "symbol").select(
        "symbol", "minute", (ratio(F.col("close"), F.col("_first")) * 100).alias("perf_100")
    )
