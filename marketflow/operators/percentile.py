"""Exact percentiles of whole numbers without gathering a group.

Equal values are counted first (partly before the shuffle). The counts are then
summed over coarse ranges of values; only the ranges that hold the wanted ranks
are looked at value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = 1000


def percentile_cont(df: DataFrame, keys: list[str], value: str, share: float, name: str) -> DataFrame:
    """Interpolated percentile of an integer column per key; NULL values do not count."""
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("bigint").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_range", F.floor(F.col("_value") / RANGE))
    )
    ranges = counts.groupBy(*keys, "_range").agg(F.sum("_n").alias("_in_range"))
    whole = Window.partitionBy(*keys)
    upward = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    rank = (F.col("_size") - 1) * F.lit(share)
    placed = (
        ranges.select(
            "*",
            F.coalesce(F.sum("_in_range").over(upward), F.lit(0)).alias("_below"),
            F.sum("_in_range").over(whole).alias("_size"),
        )
        .withColumn("_lower", F.floor(rank))
        .withColumn("_upper", F.ceil(rank))
        .withColumn("_part", rank - F.floor(rank))
    )

    def holds(wanted: str):
        return (F.col(wanted) >= F.col("_below")) & (
            F.col(wanted) < F.col("_below") + F.col("_in_range")
        )

    hit = placed.filter(holds("_lower") | holds("_upper"))
    inside = (
        Window.partitionBy(*keys, "_range")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        counts.join(hit, [*keys, "_range"])
        .withColumn("_first", F.col("_below") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .withColumn("_last", F.col("_first") + F.col("_n") - 1)
    )

    def value_at(wanted: str):
        return F.max(F.when(F.col(wanted).between(F.col("_first"), F.col("_last")), F.col("_value")))

    low, high = value_at("_lower"), value_at("_upper")
    return ranked.groupBy(*keys).agg(
        (low + (high - low) * F.max("_part")).cast("double").alias(name)
    )
