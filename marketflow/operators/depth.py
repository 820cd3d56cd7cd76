"""Order-book depth: one message holds the best levels of both sides."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions.numbers import STAGED, product
from marketflow.functions.timecols import at, before
from marketflow.operators.trades import first_received, stream_symbol
from marketflow.sources.messages import path

SIDE_ARRAY = "array<array<string>>"


def depth_messages(raw: DataFrame) -> DataFrame:
    """One row per message with both sides as arrays of [price, qty]."""
    return raw.select(
        stream_symbol(path("stream", "string")).alias("symbol"),
        path("data.lastUpdateId", "bigint").alias("last_update_id"),
        path("data.bids", SIDE_ARRAY).alias("bids"),
        path("data.asks", SIDE_ARRAY).alias("asks"),
        "ingest_time",
    )


def unique_messages(messages: DataFrame) -> DataFrame:
    """First received copy per (symbol, last_update_id).

    Done on whole messages, not on exploded levels: one narrow shuffle, after
    which levels and book aggregates of a message are already in place.
    """
    return first_received(messages, ["symbol", "last_update_id"], ["ingest_time", "bids", "asks"])


def received_messages(raw: DataFrame, since: datetime | Column, until: datetime | Column, copies_within: int = 15) -> DataFrame:
    """First received copies whose receipt lies in the span; the span is cut out of ``raw`` before anything is shuffled.

    ``copies_within``: minutes within which a message's copies arrive. So far
    before the span ``raw`` is looked at too, since a later copy must not count.
    """
    received = F.col("ingest_time")
    near = raw.filter((received >= before(since, minutes=copies_within)) & (received <= at(until)))
    return unique_messages(depth_messages(near)).filter(received >= at(since))


def explode_levels(messages: DataFrame) -> DataFrame:
    """One row per level, numbered from 0; empty or missing sides give no row."""
    # both sides in one generator: a single pass over the messages
    sides = F.array(
        F.struct(F.lit("bid").alias("side"), F.col("bids").alias("levels")),
        F.struct(F.lit("ask").alias("side"), F.col("asks").alias("levels")),
    )
    by_side = messages.select("symbol", "last_update_id", "ingest_time", F.explode(sides).alias("s"))
    levels = by_side.select(
        "symbol",
        "last_update_id",
        "ingest_time",
        "s.side",
        F.posexplode("s.levels").alias("level", "pair"),
    )
    return levels.select(
        "symbol",
        "side",
        "level",
        F.get("pair", F.lit(0)).try_cast(STAGED).alias("price"),
        F.get("pair", F.lit(1)).try_cast(STAGED).alias("qty"),
        "last_update_id",
        "ingest_time",
    )


def stg_depth_levels(raw: DataFrame) -> DataFrame:
    """Levels of every message as received, copies included."""
    return explode_levels(depth_messages(raw))


def unique_depth_levels(raw: DataFrame) -> DataFrame:
    """Levels of the first received copy of every message."""
    return explode_levels(unique_messages(depth_messages(raw)))


def enrich_levels(levels: DataFrame) -> DataFrame:
    """Adds the notional value of the level."""
    return levels.select(
        "symbol",
        "side",
        "level",
        "price",
        "qty",
        product(F.col("price"), F.col("qty")).alias("notional"),
        "last_update_id",
        "ingest_time",
    )
