"""Order flow: what takers bought and sold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions import labels
from marketflow.functions.numbers import EXACT, difference, published
from marketflow.functions.timecols import bucket, day
from marketflow.operators.series import running_total


def taker_flow(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """Taker volume per (symbol, minute) and side, with the difference."""
    quantity, passive_buyer = F.col("quantity"), F.col("is_buyer_market_maker")
    # an unknown flag is neither side here
    bought = F.sum(F.when(~passive_buyer, quantity).otherwise(0))
    sold = F.sum(F.when(passive_buyer, quantity).otherwise(0))
    return (
        trades.groupBy("symbol", bucket(F.col("traded_at"), width).alias("minute"))
        .agg(
            published(bought).alias("taker_buy"),
            published(sold).alias("taker_sell"),
            published(difference(bought, sold)).alias("delta"),
        )
    )


def cumulative_delta(flow: DataFrame) -> DataFrame:
    """Running sum of the difference per symbol."""
    summed = running_total(
        flow, ["symbol"], "minute", day(F.col("minute")), F.col("delta"), "cvd", EXACT
    )
    return summed.select(*flow.columns, published(F.col("cvd")).alias("cvd"))


def order_pressure(flow: DataFrame, minutes: int = 10) -> DataFrame:
    """Net flow of each symbol's last rows and its label.

    The rank limit is applied before the shuffle, so a busy symbol sends few rows.
    """
    newest = Window.partitionBy("symbol").orderBy(F.col("minute").desc())
    last = flow.withColumn("_nth", F.row_number().over(newest)).filter(F.col("_nth") <= minutes)
    return (
        last.groupBy("symbol")
        .agg(published(F.sum("delta")).alias("net_flow"))
        .withColumn("pressure", labels.pressure(F.col("net_flow")))
    )
