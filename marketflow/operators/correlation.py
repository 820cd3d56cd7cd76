"""Correlation of log returns across symbols on the common grid of minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.numbers import ratio
from marketflow.functions.timecols import day
from marketflow.operators.series import running_total

GRID_BLOCK = 512


def grid(series: DataFrame) -> DataFrame:
    """``slot``: the position of the minute among all minutes that any symbol traded in, from 1."""
    minutes = series.select("minute").distinct()
    slots = running_total(
        minutes.withColumn("_all", F.lit(0)),
        ["_all"],
        "minute",
        day(F.col("minute")),
        F.lit(1),
        "slot",
    ).drop("_all")
    return series.join(slots, "minute")


def grid_returns(performance: DataFrame) -> DataFrame:
    """Log returns between neighbouring slots; a missing minute leaves out two of them."""
    rows = grid(performance).select("symbol", "slot", "minute", "perf_100")
    # a block of slots begins with a copy of the last row before it
    block = F.floor(F.col("slot") / GRID_BLOCK)
    edge = F.col("slot") % GRID_BLOCK == GRID_BLOCK - 1
    blocks = F.when(edge, F.array(block, block + 1)).otherwise(F.array(block))
    before = Window.partitionBy("symbol", "_block").orderBy("slot")
    paired = rows.select("*", block.alias("_own"), F.explode(blocks).alias("_block")).select(
        "*", F.lag("slot").over(before).alias("_slot"), F.lag("perf_100").over(before).alias("_prev")
    )
    neighbours = (F.col("_own") == F.col("_block")) & (F.col("_slot") == F.col("slot") - 1)
    return paired.filter(neighbours).select(
        "symbol", "slot", "minute", F.ln(ratio(F.col("perf_100"), F.col("_prev"))).alias("log_return")
    )


def cross_grid(performance: DataFrame, names: list[str]) -> DataFrame:
    """One row per minute, one column per named symbol, NULL where it did not trade."""
    return performance.groupBy("minute").pivot("symbol", names).agg(F.first("perf_100"))


def return_correlation(performance: DataFrame) -> DataFrame:
    """Pearson correlation of each ordered pair over their common slots, two decimals.

    A block of slots is a matrix slots x symbols; its products with itself give
    the sums of all pairs at once, so pairs leave a block as one row each and
    are never formed per minute. Only one of (a, b) and (b, a) does; the other is
    read off the sums at the end.
    """
    schema = "symbol_a string, symbol_b string, n double, sa double, sb double, saa double, sbb double, sab double"

    def products(block):
        import numpy as np
        import pandas as pd

        table = block.pivot(index="slot", columns="symbol", values="log_return")
        names = np.asarray(table.columns, dtype=object)
        known = table.notna().to_numpy(dtype="float64")
        value = table.fillna(0.0).to_numpy(dtype="float64")
        square = value * value
        pairs = {
            "n": known.T @ known,
            "sa": value.T @ known,
            "sb": known.T @ value,
            "saa": square.T @ known,
            "sbb": known.T @ square,
            "sab": value.T @ value,
        }
        upper = np.triu_indices(len(names))
        out = {"symbol_a": names[upper[0]], "symbol_b": names[upper[1]]}
        out.update({name: matrix[upper] for name, matrix in pairs.items()})
        frame = pd.DataFrame(out)
        return frame[frame["n"] > 0]

    partial = (
        grid_returns(performance)
        .filter(F.col("log_return").isNotNull())
        .select("symbol", "slot", "log_return", F.floor(F.col("slot") / GRID_BLOCK).alias("_block"))
        .groupBy("_block")
        .applyInPandas(lambda block: products(block.drop(columns="_block")), schema)
    )
    sums = partial.groupBy("symbol_a", "symbol_b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")]
    )
    n = F.col("n")
    covariance = F.col("sab") - F.col("sa") * F.col("sb") / n
    spread_a = F.col("saa") - F.col("sa") * F.col("sa") / n
    spread_b = F.col("sbb") - F.col("sb") * F.col("sb") / n
    scale = F.sqrt(F.greatest(spread_a, F.lit(0.0)) * F.greatest(spread_b, F.lit(0.0)))
    a, b = F.col("symbol_a"), F.col("symbol_b")
    one, other = F.struct(a, b), F.struct(b.alias("symbol_a"), a.alias("symbol_b"))
    half = sums.select(
        F.explode(F.when(a == b, F.array(one)).otherwise(F.array(one, other))).alias("pair"),
        n.cast("bigint").alias("common"),
        F.when(n > 1, F.round(covariance / F.nullif(scale, F.lit(0.0)), 2)).alias("correlation"),
    )
    return half.select("pair.symbol_a", "pair.symbol_b", "common", "correlation")
