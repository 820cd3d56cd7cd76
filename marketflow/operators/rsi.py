"""Wilder's relative strength index without recursion.

avg = (prev * 13 + x) / 14 is an affine step, and affine steps compose. Inside a
block of rows the contribution of the block's own values is one running sum;
the average at the end of the previous block then enters with the factor
(13/14)^(rows since). Only the block ends, one row per 2048 bars, meet per
symbol, and even there the frame is limited: a factor that underflows to zero
needs no row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.numbers import difference, published
from marketflow.operators.series import BLOCK_ROWS, block_window, in_blocks, numbered, own_rows


def gains_losses(blocks: DataFrame) -> DataFrame:
    """Adds ``gain`` and ``loss`` of the close against the previous bar, both non-negative."""
    change = difference(F.col("close"), F.lag("close").over(block_window()))
    zero = F.lit(0)
    return blocks.withColumn("_change", change).select(
        *blocks.columns,
        F.when(F.col("_change") > 0, F.col("_change")).otherwise(zero).alias("gain"),
        F.when(F.col("_change") < 0, -F.col("_change")).otherwise(zero).alias("loss"),
    )


def rsi_gains_losses(bars: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    split = gains_losses(in_blocks(numbered(bars), block_rows, halo=1))
    return own_rows(split).select("symbol", "minute", "rn", "gain", "loss")


def seed(gl: DataFrame, n: int = 14) -> DataFrame:
    """Mean of the first ``n`` changes per symbol, placed at row ``n + 1``."""
    return (
        gl.filter(F.col("rn").between(2, n + 1))
        .groupBy("symbol")
        .agg(
            F.avg(F.col("gain").cast("double")).alias("avg_gain"),
            F.avg(F.col("loss").cast("double")).alias("avg_loss"),
            F.count(F.lit(1)).alias("changes"),
        )
        .filter(F.col("changes") >= n)
        .select("symbol", F.lit(n + 1).cast("bigint").alias("rn"), "avg_gain", "avg_loss")
    )


def rsi_value(avg_gain: Column, avg_loss: Column) -> Column:
    strength = avg_gain / F.nullif(avg_loss, F.lit(0.0))
    return (
        F.when(avg_gain.isNull(), None)
        .when((avg_loss == 0) & (avg_gain == 0), F.lit(50.0))
        .when(avg_loss == 0, F.lit(100.0))
        .otherwise(100 - 100 / (1 + strength))
    )


def wilder(gl: DataFrame, n: int = 14, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Smoothed ``avg_gain`` and ``avg_loss`` per row from row ``n + 1`` on; NULL before.

    Input: the own rows of ``gains_losses`` with ``_block``.
    """
    keep = (n - 1) / n
    if block_rows < n + 1:
        raise ValueError("the seed must lie in the first block")

    inside = block_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("symbol", "_block")
    position = (F.col("rn") - 1) % block_rows
    seeding = F.col("rn").between(2, n + 1)

    def smoothed(name: str) -> list[Column]:
        x = F.when(F.col("rn") > n + 1, F.col(name).cast("double") / n).otherwise(0.0)
        # x * keep^-position stays far inside DOUBLE for the block sizes used
        own = F.sum(x * F.pow(F.lit(keep), -position)).over(inside) * F.pow(F.lit(keep), position)
        first = F.avg(F.when(seeding, F.col(name).cast("double"))).over(whole)
        return [own.alias(f"_own_{name}"), first.alias(f"_seed_{name}")]

    changes = F.count(F.when(seeding, F.lit(1))).over(whole)
    rows = gl.select(
        *gl.columns, position.alias("_pos"), *smoothed("gain"), *smoothed("loss"), changes.alias("_changes")
    )
    # rows of the first block start from the seed, provided it is complete
    seeded = (F.col("_block") == 0) & (F.col("_changes") >= n)
    since_seed = F.pow(F.lit(keep), F.col("rn") - (n + 1))

    def from_seed(name: str) -> Column:
        return F.when(seeded, F.col(f"_own_{name}") + since_seed * F.col(f"_seed_{name}"))

    ends = (
        rows.filter(F.col("_pos") == block_rows - 1)
        .select(
            "symbol",
            (F.col("_block") + 1).alias("_block"),
            *[
                F.coalesce(from_seed(name), F.col(f"_own_{name}")).alias(f"_end_{name}")
                for name in ("gain", "loss")
            ],
        )
    )
    # keep^(block_rows * d) is exactly zero in DOUBLE beyond this distance
    reach = math.ceil(-1080 * math.log(2) / (block_rows * math.log(keep)))
    earlier = Window.partitionBy("symbol").orderBy("_block").rowsBetween(-reach, 0)

    def carried(name: str) -> Column:
        recent_ends = F.collect_list(f"_end_{name}").over(earlier)
        decay = math.pow(keep, block_rows)
        return F.aggregate(recent_ends, F.lit(0.0), lambda acc, end: acc * decay + end).alias(
            f"_carry_{name}"
        )

    carry = ends.select("symbol", "_block", carried("gain"), carried("loss"))
    rows = rows.join(carry, ["symbol", "_block"], "left")
    since_block = F.pow(F.lit(keep), F.col("_pos") + 1)
    averages = {
        name: F.coalesce(
            from_seed(name), F.col(f"_own_{name}") + since_block * F.col(f"_carry_{name}")
        )
        for name in ("gain", "loss")
    }
    ready = F.col("rn") > n
    return rows.select(
        *[c for c in gl.columns if c != "_block"],
        F.when(ready, averages["gain"]).alias("avg_gain"),
        F.when(ready, averages["loss"]).alias("avg_loss"),
    )


def rsi_wilder(
    bars: DataFrame, n: int = 14, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Per bar: the smoothed averages and the index, NULL during the first ``n`` bars."""
    gl = own_rows(gains_losses(in_blocks(numbered(bars), block_rows, halo=1)))
    averaged = wilder(gl, n, block_rows)
    return averaged.select(
        "symbol",
        "minute",
        "rn",
        "avg_gain",
        "avg_loss",
        published(rsi_value(F.col("avg_gain"), F.col("avg_loss"))).alias(f"rsi_{n}"),
    )


def rsi_range(metrics: DataFrame) -> DataFrame:
    """Lowest and highest index per symbol, warm-up rows aside."""
    rsi = F.col("rsi_14").cast("double")
    return (
        metrics.filter(F.col("rsi_14").isNotNull())
        .groupBy("symbol")
        .agg(F.round(F.min(rsi), 2).alias("rsi_min"), F.round(F.max(rsi), 2).alias("rsi_max"))
    )
