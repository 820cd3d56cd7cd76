"""Table maintenance as DataFrames: what a table holds after the operation."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.functions.timecols import at, before, bucket
from marketflow.operators.trades import first_received


def incremental_slice(
    source: DataFrame, target: DataFrame, time_col: str, target_time: str, minutes: int = 5
) -> DataFrame:
    """Source rows from ``minutes`` before the newest target row on; all rows for an empty target.

    The newest time is one value over all symbols.
    """
    span = F.make_dt_interval(mins=F.lit(minutes))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    edge = target.agg(F.coalesce(F.max(target_time) - span, epoch)).scalar()
    return source.filter(F.col(time_col) >= edge)


def same_key(keys: list[str], prefix: str = "_new_") -> Column:
    """Equal keys, where a missing part equals a missing part."""
    return reduce(and_, (F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace those with the same key, new keys are added, others stay.

    ``updates`` holds each key once. The target side is only filtered, never
    regrouped, and its rows travel on the merge keys.
    """
    fresh = updates.select(*(F.col(k).alias(f"_new_{k}") for k in keys))
    kept = target.join(fresh, same_key(keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def upsert_first(target: DataFrame, updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Like ``upsert``, but of two rows with one key the first by ``order`` stays."""
    return first_received(target.unionByName(updates.select(*target.columns)), keys, order)


def replace_range(
    target: DataFrame, updates: DataFrame, time_col: str, start: datetime | Column
) -> DataFrame:
    """``updates`` in place of all target rows from ``start`` on."""
    return target.filter(F.col(time_col) < start).unionByName(updates.select(*target.columns))


def purge(df: DataFrame, time_col: str, as_of: datetime | Column, days: int = 7) -> DataFrame:
    """``df`` without rows older than the retention span."""
    return df.filter(F.col(time_col) >= before(as_of, days=days))


def seed_if_empty(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` when the table has none yet, otherwise the table unchanged."""
    empty = target.limit(1).agg(F.count(F.lit(1)) == 0).scalar()
    return target.unionByName(rows.filter(empty))


def log_rows(metrics: DataFrame, as_of: Column) -> DataFrame:
    """(metric, value, status) stamped as rows of the event log."""
    return metrics.select(
        as_of.alias("checked_at"), "metric", F.col("value").cast("decimal(38,0)").alias("value"), "status"
    )


def recent_events(log: DataFrame, n: int = 10) -> DataFrame:
    """Newest log rows; equal times are ordered by metric and status."""
    return log.orderBy(F.col("checked_at").desc(), "metric", "status", "value").limit(n)


def failed_runs(run_log: DataFrame, as_of: datetime | Column, hours: int = 1) -> DataFrame:
    """A log row for each failed run of the last hours."""
    scheduled = F.col("scheduled_time")
    failed = run_log.filter(
        (F.col("state") == "FAILED") & (scheduled >= before(as_of, hours=hours)) & (scheduled <= at(as_of))
    )
    return failed.select(
        "scheduled_time",
        F.concat(F.lit("run_failed:"), F.col("name")).alias("metric"),
        F.lit(None).cast("decimal(38,0)").alias("value"),
        F.lit("TEST_FAILED").alias("status"),
    )


def alert_edges(log: DataFrame, chunk: Column) -> DataFrame:
    """First row of every run of equal status per metric: (metric, checked_at, value, status).

    The log of a metric is looked at per ``chunk`` of time; the last row of each
    chunk, one row, is the predecessor of the next chunk's first row.
    """
    keyed = log.withColumn("_chunk", chunk)
    last = keyed.groupBy("metric", "_chunk").agg(F.max_by("status", F.struct("checked_at", "status")).alias("_last"))
    chunks = Window.partitionBy("metric").orderBy("_chunk")
    carried = last.select("metric", "_chunk", F.lag("_last").over(chunks).alias("_carried"))
    inside = Window.partitionBy("metric", "_chunk").orderBy("checked_at", "status")
    previous = F.coalesce(F.lag("status").over(inside), F.col("_carried"))
    marked = keyed.join(carried, ["metric", "_chunk"]).withColumn("_previous", previous)
    return marked.filter(~F.col("status").eqNullSafe(F.col("_previous"))).select(*log.columns)


def arrival_batches(trades: DataFrame, every: str = "1 hour", minutes: int = 5) -> DataFrame:
    """Which trades a bar build that runs every ``every`` still applies.

    A trade is late when it is older than the newest trade of all earlier
    batches less ``minutes``. The newest time per batch is aggregated first, so
    only one row per batch is put in order.
    """
    batched = trades.withColumn("batch", bucket(F.col("ingest_time"), every))
    newest = batched.groupBy("batch").agg(F.max("traded_at").alias("_newest"))
    earlier = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    edge = F.max("_newest").over(earlier) - F.make_dt_interval(mins=F.lit(minutes))
    edges = newest.select("batch", edge.alias("watermark"))
    late = F.coalesce(F.col("traded_at") < F.col("watermark"), F.lit(False))
    return batched.join(edges, "batch").withColumn("is_late", late)
