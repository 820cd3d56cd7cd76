"""Ordered series per symbol, split so that no symbol is one task.

A window partitioned by symbol has as many tasks as there are symbols. Here a
series is numbered exactly and cut into blocks of consecutive rows; each block
carries a copy of the few rows before it (its halo), which is all that lags and
sliding frames look at. Windows then run per (symbol, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketflow.functions.timecols import day

BLOCK_ROWS = 2048
HALO_ROWS = 32


def running_total(
    df: DataFrame,
    keys: list[str],
    order: str,
    chunk: Column,
    value: Column,
    name: str,
    kind: str = "bigint",
) -> DataFrame:
    """Sum of ``value`` up to and including the row, per key in the order of ``order``.

    ``chunk`` is a coarse, order-preserving bucket of ``order``. Rows are summed
    inside their chunk, and the totals of the earlier chunks - one row each - are
    added to that.
    """
    chunked = df.withColumn("_value", value).withColumn("_chunk", chunk)
    totals = chunked.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_total"))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(*keys, "_chunk", F.sum("_total").over(earlier).cast(kind).alias("_offset"))
    inside = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = chunked.withColumn("_inside", F.sum("_value").over(inside).cast(kind))
    total = F.col("_inside") + F.coalesce(F.col("_offset"), F.lit(0).cast(kind))
    return (
        summed.join(offsets, [*keys, "_chunk"])
        .withColumn(name, total)
        .drop("_value", "_chunk", "_inside", "_offset")
    )


def numbered(df: DataFrame) -> DataFrame:
    """``rn``: the exact position of the row in its symbol's series, from 1."""
    return running_total(df, ["symbol"], "minute", day(F.col("minute")), F.lit(1), "rn")


def in_blocks(series: DataFrame, block_rows: int = BLOCK_ROWS, halo: int = HALO_ROWS) -> DataFrame:
    """Adds ``_block`` and ``_own``; rows near a block's end appear again in the next one's halo."""
    if halo > block_rows:
        raise ValueError("the halo must fit into one block")
    block = F.expr(f"(rn - 1) div {block_rows}")
    position = (F.col("rn") - 1) % block_rows
    blocks = F.when(position >= block_rows - halo, F.array(block, block + 1)).otherwise(F.array(block))
    return series.select("*", F.explode(blocks).alias("_block")).withColumn(
        "_own", F.col("_block") == block
    )


def block_window() -> WindowSpec:
    return Window.partitionBy("symbol", "_block").orderBy("rn")


def own_rows(df: DataFrame) -> DataFrame:
    """Drops the halo again."""
    return df.filter("_own").drop("_own")
