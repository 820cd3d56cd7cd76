"""Service levels: latency, throughput, freshness, counts, feed health."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.functions import labels
from marketflow.functions.numbers import ratio
from marketflow.functions.timecols import (
    at,
    before,
    hour_of,
    millis_between,
    minute_of,
    seconds_between,
)
from marketflow.operators.percentile import percentile_cont
from marketflow.operators.trades import stream_symbol
from marketflow.sources.messages import path


def recent(df: DataFrame, as_of: datetime | Column, minutes: int) -> DataFrame:
    received = F.col("ingest_time")
    return df.filter((received >= before(as_of, minutes=minutes)) & (received <= at(as_of)))


def latency(trades: DataFrame, as_of: datetime | Column, minutes: int = 5) -> DataFrame:
    """Per symbol: trades, mean and exact 95th percentile from trade to receipt, in seconds."""
    delays = recent(trades, as_of, minutes).select(
        "symbol", millis_between(F.col("traded_at"), F.col("ingest_time")).alias("_ms")
    )
    means = delays.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trades"), F.round(F.avg("_ms") / 1000, 3).alias("avg_latency_s")
    )
    p95 = percentile_cont(delays, ["symbol"], "_ms", 0.95, "_p95")
    return means.join(p95, "symbol", "left").select(
        "symbol",
        "trades",
        "avg_latency_s",
        F.round(F.col("_p95") / 1000, 3).alias("p95_latency_s"),
    )


def latency_global(
    trades: DataFrame, raw_ingest: DataFrame, as_of: datetime | Column, minutes: int = 5
) -> DataFrame:
    """One row: mean and 95th percentile latency, trades per second, age of the newest raw row."""
    delays = recent(trades, as_of, minutes).select(
        F.lit(0).alias("_all"), millis_between(F.col("traded_at"), F.col("ingest_time")).alias("_ms")
    )
    totals = delays.agg(
        F.round(F.avg("_ms") / 1000, 3).alias("avg_s"),
        F.round(F.count(F.lit(1)) / F.lit(60.0 * minutes), 1).alias("trades_per_s"),
    )
    p95 = percentile_cont(delays, ["_all"], "_ms", 0.95, "_p95").select("_p95").scalar()
    age = raw_ingest.agg(seconds_between(F.max("ingest_time"), at(as_of))).scalar()
    return totals.select(
        "avg_s", F.round(p95 / 1000, 3).alias("p95_s"), "trades_per_s", age.alias("freshness_s")
    )


def throughput(trades: DataFrame, as_of: datetime | Column, minutes: int = 15) -> DataFrame:
    """Trades received per minute, newest first."""
    return (
        recent(trades, as_of, minutes)
        .groupBy(minute_of(F.col("ingest_time")).alias("minute"))
        .agg(F.count(F.lit(1)).alias("trades"))
        .orderBy(F.col("minute").desc())
    )


def freshness(trades: DataFrame, levels: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Newest event and receipt per source; depth messages carry no event time."""
    received = F.max("ingest_time")

    def measures(*event: Column) -> list[Column]:
        return [
            *event,
            received.alias("last_ingest_time"),
            seconds_between(received, at(as_of)).alias("freshness_seconds"),
        ]

    of_trades = trades.agg(*measures(F.max("traded_at").alias("last_event_time")))
    of_depth = levels.agg(*measures())
    both = of_trades.select(F.lit("trades").alias("source"), "*").unionByName(
        of_depth.select(F.lit("depth").alias("source"), "*"), allowMissingColumns=True
    )
    return both


def freshness_labels(fresh: DataFrame) -> DataFrame:
    age = F.col("freshness_seconds")
    return fresh.select(
        "source",
        "freshness_seconds",
        labels.freshness_status(age).alias("status"),
        labels.freshness_tier(age).alias("tier"),
    )


def freshness_alert(
    trades: DataFrame, as_of: datetime | Column, limit_seconds: int = labels.FRESH_ERROR_SECONDS
) -> DataFrame:
    """A log row when the newest trade is too old; no row otherwise, nor for an empty table."""
    age = trades.agg(seconds_between(F.max("ingest_time"), at(as_of)).alias("_age"))
    return age.filter(F.col("_age") > limit_seconds).select(
        at(as_of).alias("checked_at"),
        F.lit("freshness_seconds").alias("metric"),
        F.col("_age").cast("decimal(38,0)").alias("value"),
        F.lit("STALE").alias("status"),
    )


def dedup_rate(raw: DataFrame) -> DataFrame:
    """Share of raw trades that the dedup removes, in percent: rows and keys in one pass over ``raw``."""
    copies = raw.select(stream_symbol(path("stream", "string")).alias("symbol"), path("data.t", "bigint").alias("trade_id"))
    keys = copies.groupBy("symbol", "trade_id").agg(F.count(F.lit(1)).alias("_n"))
    share = ratio(F.col("dedup_trades"), F.col("raw_trades"))
    rows = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("raw_trades"), F.count(F.lit(1)).alias("dedup_trades"))
    return rows.withColumn("duplicate_pct", F.round((1 - share) * 100, 1))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("model"), "n")
        for name, df in layers.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result


def raw_extent(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and oldest receipt per raw table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.min("ingest_time").alias("oldest")).select(
            F.lit(name).alias("table_name"), "n", "oldest"
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def hourly_rollup(
    usage: DataFrame, ts: str, amount: str, as_of: datetime | Column | None = None, hours: int = 24
) -> DataFrame:
    """Amount per hour of the last ``hours`` up to ``as_of`` (of all without it), newest hour first."""
    if as_of is not None:
        usage = usage.filter((F.col(ts) >= before(as_of, hours=hours)) & (F.col(ts) <= at(as_of)))
    return (
        usage.groupBy(hour_of(F.col(ts)).alias("hour"))
        .agg(F.round(F.sum(amount), 4).alias("amount"))
        .orderBy(F.col("hour").desc())
    )


def slo_budget(summary: DataFrame) -> DataFrame:
    """Percent of each service level used; up to 100 is ok. Unknown figures give no row."""
    used = summary.select(
        (F.col("freshness_s") / F.lit(float(labels.FRESH_ERROR_SECONDS)) * 100).alias("freshness"),
        (F.col("p95_s") / F.lit(float(labels.LATENCY_P95_SECONDS)) * 100).alias("latency_p95"),
    )
    return (
        used.unpivot([], ["freshness", "latency_p95"], "slo", "used_pct")
        .filter(F.col("used_pct").isNotNull())
        .select("slo", F.round("used_pct", 4).alias("used_pct"), (F.col("used_pct") <= 100).alias("ok"))
    )


def feed_health(
    heartbeats: DataFrame,
    as_of: datetime | Column,
    max_silence_seconds: int = 30,
    grace_seconds: int = 60,
) -> DataFrame:
    """State of each feed from its start, newest receipt and newest write.

    Receipt is judged before writing; a feed that just started may be silent.
    """
    seen = heartbeats.groupBy("feed").agg(
        F.min("started_at").alias("_start"), F.max("recv_at").alias("_recv"), F.max("write_at").alias("_write")
    )

    def age(column: str) -> Column:
        return millis_between(F.col(column), at(as_of)) / F.lit(1000.0)

    in_grace = F.col("uptime_s") < grace_seconds
    state = (
        F.when(F.col("recv_age_s").isNull(), F.when(in_grace, "starting").otherwise("no_data"))
        .when(F.col("recv_age_s") > max_silence_seconds, "stale")
        .when(F.col("write_age_s").isNull(), F.when(in_grace, "starting").otherwise("write_stalled"))
        .when(F.col("write_age_s") > max_silence_seconds, "write_stalled")
        .otherwise("healthy")
    )
    return (
        seen.select(
            "feed",
            age("_start").alias("uptime_s"),
            age("_recv").alias("recv_age_s"),
            age("_write").alias("write_age_s"),
        )
        .withColumn("state", state)
        .withColumn("ok", F.col("state").isin("starting", "healthy"))
    )


def feed_uptime(trades: DataFrame) -> DataFrame:
    """Share of minutes with at least one message between a feed's first and last minute."""
    minutes = trades.select("symbol", minute_of(F.col("ingest_time")).alias("_minute")).distinct()
    span = seconds_between(F.min("_minute"), F.max("_minute")) / 60 + 1
    return minutes.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("active_minutes"),
        span.cast("bigint").alias("span_minutes"),
        F.round(F.count(F.lit(1)) / span * 100, 4).alias("uptime_pct"),
    )
