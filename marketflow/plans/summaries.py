"""Summaries of stored tables: partial results per partition, merged when they are read.

A summary holds, for each partition of its source, rows that can be merged with
those of others: counts, sums, extremes, moments, sketches. ``refresh`` makes them
for new and changed partitions only, so a day that is closed is read once. What
a window asks for is then a merge of a few rows per day.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketflow.functions.timecols import at, before, millis_between, minute_of, seconds_between
from marketflow.operators.drift import flatten_keys, value_type
from marketflow.sources.tables import NO_VALUE, exists, partition_marks, read_table, recover, replace_partitions

Summarise = Callable[[DataFrame], DataFrame]


def refresh(spark: SparkSession, source: str, path: str, partition: str, summarise: Summarise) -> list[str]:
    """Bring the summary at ``path`` up to date with the table at ``source``; the partitions that were read.

    Both are partitioned by ``partition``, which ``summarise`` must keep as a column.
    Changes show in the listing of the source. Partitions that are gone from the
    source go from the summary. A refresh that died is made good by the next one.
    """
    recover(spark, path)
    now, known = partition_marks(spark, source, partition), {}
    if exists(spark, path):
        stored = read_table(spark, path).select(F.col(partition).cast("string"), "source_mark").distinct()
        known = {NO_VALUE if row[0] is None else row[0]: row[1] for row in stored.collect()}  # one row per partition
    changed = sorted(p for p, mark in now.items() if known.get(p) != mark)
    gone = sorted(set(known) - set(now))
    if not changed and not gone:
        return []
    rows, name = read_table(spark, source), F.col(partition).cast("string")
    wanted = name.isin([p for p in changed if p != NO_VALUE])
    made = summarise(rows.filter(wanted | name.isNull() if NO_VALUE in changed else wanted))
    marks = spark.createDataFrame([(None if p == NO_VALUE else p, now[p]) for p in changed], "p string, source_mark string")
    told = made.join(F.broadcast(marks), made[partition].cast("string").eqNullSafe(marks["p"])).drop("p")
    replace_partitions(told, path, partition, changed + gone)
    return changed


def _times(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]


# ---------------------------------------------------------------- rows and times


def extents(partition: str, *extra: Column) -> Summarise:
    """Rows of each partition, least and greatest of each of its times, and further aggregates."""

    def summarise(df: DataFrame) -> DataFrame:
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in _times(df) for f in (F.min, F.max)]
        return df.groupBy(partition).agg(F.count(F.lit(1)).alias("n"), *ends, *extra)

    return summarise


def layer_counts(layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per named table: the sum of a column of its extents; no row of the table is read."""
    found = None
    for name, (summary, column) in layers.items():
        one = summary.agg(F.coalesce(F.sum(column), F.lit(0)).alias("n")).select(F.lit(name).alias("model"), "n")
        found = one if found is None else found.unionByName(one)
    return found


def raw_extent(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and oldest receipt per named table, from their extents."""
    found = None
    for name, summary in tables.items():
        one = summary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("min_ingest_time").alias("oldest"))
        one = one.select(F.lit(name).alias("table_name"), "n", "oldest")
        found = one if found is None else found.unionByName(one)
    return found


def freshness(of_trades: DataFrame, of_depth: DataFrame, as_of: datetime | Column) -> DataFrame:
    """``slo.freshness`` from the extents of the trades and the depth table."""

    def row(summary: DataFrame, source: str, event: Column) -> DataFrame:
        received = F.max("max_ingest_time")
        return summary.agg(
            event.alias("last_event_time"), received.alias("last_ingest_time"), seconds_between(received, at(as_of)).alias("freshness_seconds")
        ).select(F.lit(source).alias("source"), "*")

    none = F.max(F.lit(None).cast("timestamp_ntz"))
    return row(of_trades, "trades", F.max("max_traded_at")).unionByName(row(of_depth, "depth", none))


def between(spark: SparkSession, path: str, summary: DataFrame, partition: str, time_col: str, since: datetime, until: datetime) -> DataFrame:
    """The rows of a stored table with ``since <= time_col <= until``.

    Only partitions whose extent meets the span are read: their names, one per
    partition that does, go into the plan as literals, and so do the ends.
    """
    low, high = F.lit(since).cast("timestamp_ntz"), F.lit(until).cast("timestamp_ntz")
    meets = (F.col(f"max_{time_col}") >= low) & (F.col(f"min_{time_col}") <= high)
    names = [row[0] for row in summary.filter(meets).select(partition).distinct().collect()]
    table = read_table(spark, path)
    wanted = F.col(partition).isin([n for n in names if n is not None])
    wanted = wanted | F.col(partition).isNull() if None in names else wanted
    return table.filter(wanted & (F.col(time_col) >= low) & (F.col(time_col) <= high))


# ---------------------------------------------------------------- keys of raw messages


def key_minutes(partition: str) -> Summarise:
    """Occurrences of each key and type of value per minute of receipt."""

    def summarise(raw: DataFrame) -> DataFrame:
        keys = flatten_keys(raw, partition).withColumn("minute", minute_of(F.col("ingest_time")))
        return keys.groupBy(partition, "minute", "key_name", value_type(F.col("value")).alias("value_type")).agg(F.count(F.lit(1)).alias("occurrences"))

    return summarise


def key_profile(
    summary: DataFrame, raw: DataFrame, source_table: str, as_of: datetime | None = None, hours: int = 24, partition: str = "ingest_date", unit: str = "day"
) -> DataFrame:
    """``drift.key_profile`` of the last hours up to ``as_of``: whole minutes from the summary, the rest of the first and the last from ``raw``.

    Without ``as_of`` overall, from the summary alone. ``unit``: the span of one partition of both.
    """
    if as_of is None:
        return _counted(summary, source_table)
    end = at(as_of)
    since = before(as_of, hours=hours)
    first = minute_of(since + F.make_dt_interval(secs=F.lit(59.999999)))
    last = minute_of(end)
    day = F.col(partition)
    reached = (day >= F.to_date(F.date_trunc(unit, since))) & (day <= F.to_date(end))
    whole = summary.filter(reached & (F.col("minute") >= first) & (F.col("minute") < last))
    t = F.col("ingest_time")
    outer = raw.filter(reached & (t >= since) & (t <= end) & ((t < first) | (t >= last)))
    ends = flatten_keys(outer).select("key_name", value_type(F.col("value")).alias("value_type"), F.lit(1).cast("bigint").alias("occurrences"))
    return _counted(whole.select("key_name", "value_type", "occurrences").unionByName(ends), source_table)


def _counted(keys: DataFrame, source_table: str) -> DataFrame:
    return keys.groupBy("key_name", "value_type").agg(F.sum("occurrences").alias("occurrences")).select(F.lit(source_table).alias("source_table"), "*")


# ---------------------------------------------------------------- latency


def delay_sketches(partition: str, precision: int = 400) -> Summarise:
    """Per minute of receipt and symbol: number and sum of the delays in milliseconds, and a quantile sketch of them.

    A sketch of precision k has a rank error of about 1.7 / k, whatever it is merged from.
    """

    def summarise(trades: DataFrame) -> DataFrame:
        ms = millis_between(F.col("traded_at"), F.col("ingest_time"))
        timed = trades.select(partition, minute_of(F.col("ingest_time")).alias("minute"), "symbol", ms.alias("ms"))
        return timed.groupBy(partition, "minute", "symbol").agg(
            F.count("ms").alias("n"), F.sum("ms").alias("ms"), F.kll_sketch_agg_bigint("ms", precision).alias("delays")
        )

    return summarise


def latency(summary: DataFrame, as_of: datetime | Column, minutes: int = 5, share: float = 0.95) -> DataFrame:
    """``slo.latency`` of the whole minutes that end at ``as_of``'s, with a percentile out of the merged sketches."""
    last = minute_of(at(as_of))
    rows = summary.filter((F.col("minute") > before(last, minutes=minutes)) & (F.col("minute") <= last))
    merged = rows.groupBy("symbol").agg(F.sum("n").alias("trades"), F.sum("ms").alias("ms"), F.kll_merge_agg_bigint("delays").alias("delays"))
    return merged.select(
        "symbol",
        "trades",
        F.round(F.col("ms") / F.col("trades") / 1000, 3).alias("avg_latency_s"),
        F.round(F.kll_sketch_get_quantile_bigint("delays", F.lit(share)) / 1000, 3).alias("p95_latency_s"),
    )


# ---------------------------------------------------------------- volume model


def volume_moments(partition: str) -> Summarise:
    """Per symbol and hour of day: number, mean and sum of squared deviations of the bars' volumes."""

    def summarise(bars: DataFrame) -> DataFrame:
        v = F.col("volume").cast("double")
        hourly = bars.groupBy(partition, "symbol", F.hour("minute").alias("hour"))
        return hourly.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("squares"), F.count(F.lit(1)).alias("bars"))

    return summarise


def merge_moments(parts: Column) -> Column:
    """(n, mean, squares) of all values, from an array of those of disjoint parts; parts are taken in order."""

    def both(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        step = b["mean"] - a["mean"]
        share = b["n"] / F.nullif(n, F.lit(0).cast("bigint"))
        return F.struct(
            n.alias("n"),
            F.coalesce(a["mean"] + step * share, F.lit(0.0)).alias("mean"),
            F.coalesce(a["squares"] + b["squares"] + step * step * a["n"] * share, F.lit(0.0)).alias("squares"),
        )

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))
    return F.aggregate(F.filter(parts, lambda p: p["n"] > 0), zero, both)


def volume_model(summary: DataFrame, first_day: Column, last_day: Column, partition: str = "bar_date") -> DataFrame:
    """``anomaly.train`` over whole days, out of their moments: one row per day, symbol and hour is read, no bar."""
    days = summary.filter((F.col(partition) >= first_day) & (F.col(partition) <= last_day))
    sets = days.groupingSets([["symbol", "hour"], ["symbol"]], "symbol", "hour")
    # an array per cell: days x 24 at most
    part = F.struct(partition, F.struct("n", "mean", "squares").alias("m"))
    merged = sets.agg(F.sum("bars").alias("bars"), F.transform(F.sort_array(F.collect_list(part)), lambda p: p["m"]).alias("parts"))
    m = merged.withColumn("m", merge_moments(F.col("parts")))
    n = F.col("m.n")
    deviation = F.when(n > 1, F.sqrt(F.col("m.squares") / (n - 1)))
    return m.select("symbol", "hour", F.col("bars").alias("n"), F.when(n > 0, F.col("m.mean")).alias("mean"), deviation.alias("deviation"))


# ---------------------------------------------------------------- column profiles


def column_facts(partition: str, columns: list[str], precision: int = 14) -> Summarise:
    """Per column: rows, missing values, least, greatest, and a sketch of the distinct values."""

    def summarise(df: DataFrame) -> DataFrame:
        def fact(c: str) -> Column:
            text = F.col(c).cast("string")
            return F.struct(
                F.lit(c).alias("column_name"),
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                F.to_json(F.struct(F.min(c).alias("v"))).alias("low"),
                F.to_json(F.struct(F.max(c).alias("v"))).alias("high"),
                F.hll_sketch_agg(text, precision).alias("distinct_sketch"),
            )

        return df.groupBy(partition).agg(F.array(*map(fact, columns)).alias("facts")).select(partition, F.inline("facts"))

    return summarise


def profile(summary: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """``quality.profile`` out of merged facts; distinct values are estimated (about 0.8 % off at precision 14).

    ``kinds``: the type of each profiled column, by which least and greatest are compared.
    """
    found = None
    for name, kind in kinds.items():
        def value(side: str) -> Column:
            return F.from_json(F.col(side), f"v {kind}")["v"]

        one = summary.filter(F.col("column_name") == name).agg(
            F.min(value("low")).cast("string").alias("min_value"),
            F.max(value("high")).cast("string").alias("max_value"),
            F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")), F.lit(0)).alias("distinct_values"),
        )
        one = one.select(F.lit(name).alias("column_name"), "*")
        found = one if found is None else found.unionByName(one)
    return found
