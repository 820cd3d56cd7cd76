"""Classifications shown to readers: column in, label out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds of the service levels and of the RSI zones.
OVERBOUGHT = 70
OVERSOLD = 30
FRESH_WARN_SECONDS = 30
FRESH_ERROR_SECONDS = 120
LATENCY_P95_SECONDS = 15


def taker_side(is_buyer_market_maker: Column) -> Column:
    """The aggressor: a passive buyer means a selling taker; an unknown flag counts as buy."""
    return F.when(is_buyer_market_maker, "sell").otherwise("buy")


def pressure(net_flow: Column) -> Column:
    return F.when(net_flow > 0, "buyers").when(net_flow < 0, "sellers").otherwise("balanced")


def rsi_zone(rsi: Column) -> Column:
    return (
        F.when(rsi.isNull(), "warm-up")
        .when(rsi >= OVERBOUGHT, "overbought")
        .when(rsi <= OVERSOLD, "oversold")
        .otherwise("neutral")
    )


def verdict(pressure_label: Column, zone: Column, volume_anomaly: Column) -> Column:
    """The notable signals as phrases, or ``calm`` when there is none."""
    phrases = F.concat_ws(
        "; ",
        F.when(pressure_label == "buyers", "buyers are pushing").when(
            pressure_label == "sellers", "sellers are pushing"
        ),
        F.when(zone == "overbought", "RSI overbought").when(zone == "oversold", "RSI oversold"),
        F.when(volume_anomaly, "abnormal volume"),
    )
    return F.when(phrases == "", "calm").otherwise(phrases)


def freshness_status(age_seconds: Column) -> Column:
    """Two-way status of the banner."""
    return (
        F.when(age_seconds.isNull(), "unknown")
        .when(age_seconds <= FRESH_ERROR_SECONDS, "ok")
        .otherwise("stale")
    )


def freshness_tier(age_seconds: Column) -> Column:
    """Three-way status of the service level."""
    return (
        F.when(age_seconds.isNull(), "unknown")
        .when(age_seconds > FRESH_ERROR_SECONDS, "error")
        .when(age_seconds > FRESH_WARN_SECONDS, "warn")
        .otherwise("ok")
    )


def bar_direction(open_price: Column, close_price: Column) -> Column:
    return F.when(open_price <= close_price, "up").otherwise("down")


def flow_direction(delta: Column) -> Column:
    return F.when(delta >= 0, "positive").otherwise("negative")
