"""Volume anomalies per symbol.

The model is a seasonal profile: mean and sample deviation of the bar volume per
(symbol, hour of day) over the training span, or over the whole symbol where a
cell has fewer than three bars or no spread. The interval is that of a normal
distribution.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.timecols import at, before

# Interval of 99 %, and the least number of bars of a cell.
Z_99 = 2.5758
MIN_CELL = 3


def split(
    bars: DataFrame, as_of: datetime | Column, train_days: int = 7, score_hours: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Training and scoring bars: disjoint, the scored ones later."""
    minute = F.col("minute")
    cut = before(as_of, hours=score_hours)
    train = bars.filter((minute >= before(as_of, days=train_days)) & (minute < cut))
    return train, bars.filter((minute >= cut) & (minute <= at(as_of)))


def _moments() -> list[Column]:
    volume = F.col("volume").cast("double")
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(volume).alias("mean"),
        F.stddev_samp(volume).alias("deviation"),
    ]


def train(bars: DataFrame) -> DataFrame:
    """Profile per (symbol, hour): one pass with subtotals, cells and whole symbols together.

    The row with a NULL hour is the symbol's own.
    """
    hourly = bars.select("symbol", F.hour("minute").alias("hour"), "volume")
    return (
        hourly.groupingSets([["symbol", "hour"], ["symbol"]], "symbol", "hour")
        .agg(*_moments())
        .select("symbol", "hour", "n", "mean", "deviation")
    )


def score(bars: DataFrame, model: DataFrame, scored_at: datetime | Column) -> DataFrame:
    """Forecast, bounds, flag and distance of each bar; those of a symbol without a model have the flag alone, false."""
    whole = model.filter(F.col("hour").isNull()).select(
        "symbol", F.col("mean").alias("_mean"), F.col("deviation").alias("_deviation")
    )
    cells = model.filter(F.col("hour").isNotNull() & (F.col("n") >= MIN_CELL) & (F.col("deviation") > 0))
    cells = cells.select("symbol", "hour", "mean", "deviation")
    joined = (
        bars.select("symbol", "minute", F.col("volume").cast("double").alias("volume"))
        .withColumn("hour", F.hour("minute"))
        .join(cells, ["symbol", "hour"], "left")
        .join(whole, "symbol", "left")
    )
    fits = F.col("mean").isNotNull()
    sigma = F.nullif(F.when(fits, F.col("deviation")).otherwise(F.col("_deviation")), F.lit(0.0))
    forecasted = joined.select(
        "symbol",
        "minute",
        "volume",
        F.when(fits, F.col("mean")).otherwise(F.col("_mean")).alias("forecast"),
        sigma.alias("_sigma"),
    )
    reach = F.lit(Z_99) * F.col("_sigma")
    bounded = forecasted.withColumn(
        "lower_bound", F.greatest(F.col("forecast") - reach, F.lit(0.0))
    ).withColumn("upper_bound", F.col("forecast") + reach)
    # greatest() ignores NULL: without a deviation there are no bounds
    lower = F.when(F.col("_sigma").isNotNull(), F.col("lower_bound"))
    outside = (F.col("volume") < lower) | (F.col("volume") > F.col("upper_bound"))
    return bounded.select(
        at(scored_at).alias("scored_at"),
        "symbol",
        "minute",
        "volume",
        "forecast",
        lower.alias("lower_bound"),
        "upper_bound",
        F.coalesce(outside, F.lit(False)).alias("is_anomaly"),
        ((F.col("volume") - F.col("forecast")) / F.col("_sigma")).alias("distance"),
    )


def counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("symbol").agg(
        F.count_if("is_anomaly").alias("anomalies"), F.count(F.lit(1)).alias("points")
    )


def alert(scored: DataFrame, as_of: datetime | Column, minutes: int = 15) -> DataFrame:
    """A log row with the number of recent anomalies; no row when there is none."""
    minute = F.col("minute")
    recent = scored.filter(F.col("is_anomaly") & (minute >= before(as_of, minutes=minutes)) & (minute <= at(as_of)))
    found = recent.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0)
    return found.select(
        at(as_of).alias("checked_at"),
        F.lit("volume_anomaly").alias("metric"),
        F.col("_n").cast("decimal(38,0)").alias("value"),
        F.lit("ANOMALY").alias("status"),
    )


def panel(scored: DataFrame, symbol: str, as_of: datetime | Column, hours: int = 2) -> DataFrame:
    """Recent scored bars of one symbol in order."""
    minute = F.col("minute")
    return (
        scored.filter((F.col("symbol") == symbol) & (minute >= before(as_of, hours=hours)) & (minute <= at(as_of)))
        .select("minute", "volume", "lower_bound", "upper_bound", "is_anomaly", "distance")
        .orderBy("minute")
    )


def evaluate(scored: DataFrame) -> DataFrame:
    """Mean absolute and root mean square error, and the share of bars inside the interval."""
    error = F.col("volume") - F.col("forecast")
    inside = F.when(F.col("volume").between(F.col("lower_bound"), F.col("upper_bound")), 1.0).when(
        F.col("lower_bound").isNotNull(), 0.0
    )
    return scored.groupBy("symbol").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(inside).alias("coverage"),
    )
