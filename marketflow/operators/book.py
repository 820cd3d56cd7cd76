"""Order-book metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.numbers import EXACT, NARROW_SUM, PRODUCT, PUBLISHED, STAGED, difference, long_quotient, narrow_product, product, published, quotient, total
from marketflow.operators.trades import live_window


def book_agg(levels: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Best prices and total volume of both sides per ``keys``, in one pass."""
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    return levels.groupBy(*keys).agg(
        *extra,
        F.max(F.when(bid, F.col("price"))).alias("best_bid"),
        F.min(F.when(ask, F.col("price"))).alias("best_ask"),
        F.sum(F.when(bid, F.col("qty")).otherwise(0)).alias("bid_vol"),
        F.sum(F.when(ask, F.col("qty")).otherwise(0)).alias("ask_vol"),
    )


def _total() -> Column:
    return total(F.col("bid_vol"), F.col("ask_vol"))


def mid() -> Column:
    return total(F.col("best_bid"), F.col("best_ask")) / F.lit(2).cast("decimal(2,0)")


def spread_bps() -> Column:
    spread = difference(F.col("best_ask"), F.col("best_bid"))
    twice_mid = total(F.col("best_bid"), F.col("best_ask"))
    return quotient(spread, twice_mid, scale=20_000)


def imbalance() -> Column:
    return quotient(F.col("bid_vol"), _total())


def microprice() -> Column:
    """Mid weighted towards the side with less volume; beyond NARROW the weighted prices are published numbers."""
    bid, ask, bids, asks = (F.col(c) for c in ("best_bid", "best_ask", "bid_vol", "ask_vol"))
    exact = narrow_product(bid, asks) + narrow_product(ask, bids)
    return F.coalesce(
        quotient(exact, _total(), PRODUCT, NARROW_SUM), long_quotient(total(product(bid, asks), product(ask, bids)), _total())
    )


def snapshot_metrics(agg: DataFrame) -> DataFrame:
    """History row of a snapshot; a missing side leaves mid and spread NULL."""
    return agg.select(
        "symbol",
        "last_update_id",
        "ingest_time",
        published(F.col("best_bid")).alias("best_bid"),
        published(F.col("best_ask")).alias("best_ask"),
        published(mid()).alias("mid"),
        spread_bps().alias("spread_bps"),
        imbalance().alias("imbalance"),
    )


def orderbook_snapshots(levels: DataFrame) -> DataFrame:
    """One row per (symbol, last_update_id)."""
    received = F.max("ingest_time").alias("ingest_time")
    return snapshot_metrics(book_agg(levels, ["symbol", "last_update_id"], received))


def message_books(messages: DataFrame) -> DataFrame:
    """Best prices and total volume of both sides straight from the arrays of each message: no explode, no shuffle.

    Messages without any level give no row, as they have none when exploded.
    """

    def prices(side: str) -> Column:
        return F.transform(F.col(side), lambda pair: F.get(pair, F.lit(0)).try_cast(STAGED))

    levels = F.coalesce(F.size("bids"), F.lit(0)) + F.coalesce(F.size("asks"), F.lit(0))
    return messages.filter(levels > 0).select(
        "symbol",
        "last_update_id",
        "ingest_time",
        F.array_max(prices("bids")).alias("best_bid"),
        F.array_min(prices("asks")).alias("best_ask"),
        _volume(F.col("bids")).alias("bid_vol"),
        _volume(F.col("asks")).alias("ask_vol"),
    )


def _volume(side: Column) -> Column:
    """Sum of the quantities of an array of [price, qty]."""
    added = F.aggregate(
        F.transform(side, lambda pair: F.get(pair, F.lit(1)).try_cast(STAGED)),
        F.lit(0).cast(EXACT),
        lambda acc, qty: (acc + F.coalesce(qty, F.lit(0).cast(STAGED))).cast(EXACT),
    )
    return F.coalesce(added, F.lit(0).cast(EXACT))


def message_snapshots(messages: DataFrame) -> DataFrame:
    """``orderbook_snapshots`` from the messages themselves."""
    return snapshot_metrics(message_books(messages))


def message_depth_within(messages: DataFrame, bps: float) -> DataFrame:
    """``depth_within`` from the messages themselves."""
    def price(pair: Column) -> Column:
        return F.get(pair, F.lit(0)).try_cast(STAGED)

    levels = F.coalesce(F.size("bids"), F.lit(0)) + F.coalesce(F.size("asks"), F.lit(0))
    priced = messages.filter(levels > 0).select(
        "symbol",
        "last_update_id",
        "bids",
        "asks",
        F.array_max(F.transform("bids", price)).alias("best_bid"),
        F.array_min(F.transform("asks", price)).alias("best_ask"),
    )
    priced = priced.withColumn("_mid", mid().cast("double"))

    # rounding keeps levels that lie exactly on the edge
    def near(pair: Column) -> Column:
        return F.round(F.abs(price(pair).cast("double") - F.col("_mid")) - F.col("_mid") * bps / 10000, 9) <= 0

    return priced.select(
        "symbol",
        "last_update_id",
        _volume(F.filter("bids", near)).cast(PUBLISHED).alias("bid_depth"),
        _volume(F.filter("asks", near)).cast(PUBLISHED).alias("ask_depth"),
    )


def latest_levels(levels: DataFrame) -> DataFrame:
    """The levels of each symbol's newest snapshot.

    Spark turns the rank into a group limit before the shuffle: each task passes
    on the levels of the newest snapshot it has seen, and they are read once.
    """
    newest = Window.partitionBy("symbol").orderBy(F.col("last_update_id").desc())
    return levels.withColumn("_rank", F.rank().over(newest)).filter("_rank = 1 AND last_update_id IS NOT NULL").drop("_rank")


def orderbook_live(levels: DataFrame, as_of: datetime | Column, minutes: int = 120) -> DataFrame:
    """Book metrics of the newest snapshot inside the live window, per symbol."""
    latest = latest_levels(live_window(levels, "ingest_time", as_of, minutes))
    return live_metrics(book_agg(latest, ["symbol"]))


def live_metrics(agg: DataFrame) -> DataFrame:
    """Row of the live view, of best prices and volumes per symbol."""
    return agg.select(
        "symbol",
        published(F.col("best_bid")).alias("best_bid"),
        published(F.col("best_ask")).alias("best_ask"),
        published(mid()).alias("mid"),
        spread_bps().alias("spread_bps"),
        published(F.col("bid_vol")).alias("bid_vol"),
        published(F.col("ask_vol")).alias("ask_vol"),
        imbalance().alias("imbalance"),
        microprice().alias("microprice"),
    )


def shown(levels: DataFrame) -> DataFrame:
    """Levels as (symbol, side, level, price, qty), ordered by price."""
    return levels.select(
        "symbol",
        "side",
        "level",
        F.col("price").cast("double").alias("price"),
        F.col("qty").cast("double").alias("qty"),
    ).orderBy("symbol", "price", "side", "level")


def ladder(levels: DataFrame) -> DataFrame:
    """The newest snapshot of each symbol."""
    return shown(latest_levels(levels))


def crossed_books(books: DataFrame) -> DataFrame:
    return books.filter(F.col("best_bid") > F.col("best_ask")).agg(
        F.count(F.lit(1)).alias("crossed_books")
    )


def depth_within(levels: DataFrame, bps: float) -> DataFrame:
    """Volume of each side within ``bps`` of the mid, per snapshot."""
    keys = ["symbol", "last_update_id"]
    snapshot = Window.partitionBy(*keys)
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    priced = levels.select(
        *keys,
        "side",
        "price",
        "qty",
        F.max(F.when(bid, F.col("price"))).over(snapshot).alias("best_bid"),
        F.min(F.when(ask, F.col("price"))).over(snapshot).alias("best_ask"),
    ).withColumn("_mid", mid().cast("double"))
    price, reach = F.col("price").cast("double"), F.col("_mid") * bps / 10000
    # rounding keeps levels that lie exactly on the edge
    near = F.round(F.abs(price - F.col("_mid")) - reach, 9) <= 0

    def volume(side: str) -> Column:
        return F.sum(F.when((F.col("side") == side) & near, F.col("qty")).otherwise(0)).cast(PUBLISHED)

    return (
        priced.groupBy(*keys)
        .agg(volume("bid").alias("bid_depth"), volume("ask").alias("ask_depth"))
    )
