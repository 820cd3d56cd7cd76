"""Trades: from raw records to deduplicated, enriched rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions import labels
from marketflow.functions.numbers import STAGED, product
from marketflow.functions.timecols import at, before, from_millis
from marketflow.sources.messages import path


def stream_symbol(stream: Column) -> Column:
    """``btcusdt@trade`` is a message of symbol BTCUSDT."""
    return F.upper(F.split_part(stream, F.lit("@"), F.lit(1)))


def flatten_trades(raw: DataFrame, extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Typed columns out of the record. ``extra`` adds nullable columns: name -> (JSON key, type)."""
    added = [path(f"data.{key}", kind).alias(name) for name, (key, kind) in (extra or {}).items()]
    return raw.select(
        stream_symbol(path("stream", "string")).alias("symbol"),
        path("data.t", "bigint").alias("trade_id"),
        path("data.p", STAGED).alias("price"),
        path("data.q", STAGED).alias("quantity"),
        from_millis(path("data.T", "bigint")).alias("traded_at"),
        from_millis(path("data.E", "bigint")).alias("event_time"),
        path("data.m", "boolean").alias("is_buyer_market_maker"),
        *added,
        "ingest_time",
    )


def first_received(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so a
    key with very many copies leaves each map task as one row.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(ordered)).filter("_nth = 1").drop("_nth")


def stg_trades(
    raw: DataFrame,
    extra: dict[str, tuple[str, str]] | None = None,
    traded_since: datetime | Column | None = None,
    traded_until: datetime | Column | None = None,
) -> DataFrame:
    """Flattened trades, first received copy per (symbol, trade_id).

    ``traded_since`` and ``traded_until`` narrow the input before the dedup: copies of a trade share
    their trade time, so the result is that of filtering afterwards.
    """
    flat = flatten_trades(raw, extra)
    if traded_since is not None:
        flat = flat.filter(F.col("traded_at") >= traded_since)
    if traded_until is not None:
        flat = flat.filter(F.col("traded_at") <= traded_until)
    # the payload after the receipt time decides ties, so reruns agree
    tie_break = ["ingest_time", "traded_at", "event_time", "price", "quantity", "is_buyer_market_maker"]
    unique = first_received(flat, ["symbol", "trade_id"], tie_break)
    uid = F.concat(F.col("symbol"), F.lit("-"), F.col("trade_id").cast("string"))
    return unique.select(uid.alias("trade_uid"), *flat.columns)


def enrich_trades(trades: DataFrame) -> DataFrame:
    """Adds the traded value and the side of the taker."""
    return trades.select(
        "trade_uid",
        "symbol",
        "trade_id",
        "price",
        "quantity",
        product(F.col("price"), F.col("quantity")).alias("trade_value"),
        labels.taker_side(F.col("is_buyer_market_maker")).alias("taker_side"),
        "traded_at",
        "event_time",
        "is_buyer_market_maker",
        "ingest_time",
    )


def live_window(
    df: DataFrame, time_col: str, as_of: datetime | Column, minutes: int = 120
) -> DataFrame:
    """Rows of the last ``minutes`` up to ``as_of``; the edges are not bucket-aligned."""
    return df.filter((F.col(time_col) >= before(as_of, minutes=minutes)) & (F.col(time_col) <= at(as_of)))
