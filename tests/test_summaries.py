"""Summaries: merged partial results equal those over all rows, and closed partitions are read once."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import depth_json, formatted, raw, trade_json
from marketflow.operators import anomaly, drift, quality, slo
from marketflow.plans import summaries
from marketflow.sources import tables
from test_streams import same

START = datetime(2026, 6, 1)


def lit(t):
    return F.lit(t).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def trades(spark, tmp_path_factory):
    """Ten days of trades by trade date, the receipt up to a day later."""
    rng, rows = random.Random(4), []
    for i in range(4000):
        at = START + timedelta(seconds=rng.randint(0, 10 * 86_400 - 1))
        late = timedelta(milliseconds=rng.choice([80, 120, 900, 86_000_000]) + rng.randint(0, 50))
        rows.append((rng.choice("AAB"), i, Decimal(rng.randint(1, 99)), None if i % 50 == 0 else i % 3 == 0, at, at + late, at.date()))
    path = str(tmp_path_factory.mktemp("facts") / "trades")
    schema = "symbol string, trade_id bigint, price decimal(38,8), maker boolean, traded_at timestamp_ntz, ingest_time timestamp_ntz, trade_date date"
    spark.createDataFrame(rows, schema).write.partitionBy("trade_date").parquet(path)
    return path


def test_only_new_and_changed_partitions_are_read(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "summary")

    def put(day, values):
        df = spark.createDataFrame([(date(2026, 6, day), START, v) for v in values], "d date, at timestamp_ntz, v int")
        df.coalesce(1).write.mode("append").partitionBy("d").parquet(source)

    run = lambda: summaries.refresh(spark, source, path, "d", summaries.extents("d", F.sum("v").alias("v")))
    held = lambda: sorted((r.d.day, r.n, r.v) for r in tables.read_table(spark, path).collect())
    put(1, [1, 2]), put(2, [5])
    assert run() == ["2026-06-01", "2026-06-02"] and run() == []
    put(2, [6, 7]), put(3, [9])
    assert run() == ["2026-06-02", "2026-06-03"]
    assert held() == [(1, 2, 3), (2, 3, 18), (3, 1, 9)]
    fs, folder = tables._path(spark, f"{source}/d=2026-06-01")
    fs.delete(folder, True)
    assert run() == [] and held() == [(2, 3, 18), (3, 1, 9)]
    # a refresh that died after staging is completed by the next
    spark.createDataFrame([(date(2026, 6, 3), 1, START, START, 99, "x")], "d date, n bigint, min_at timestamp_ntz, max_at timestamp_ntz, v bigint, source_mark string").write.partitionBy("d").parquet(path + "__pending")
    assert run() == ["2026-06-03"] and held() == [(2, 3, 18), (3, 1, 9)]


def test_partitions_that_summarise_to_nothing_go(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "summary")
    spark.createDataFrame([(1, 5), (2, 6)], "d int, v int").write.partitionBy("d").parquet(source)
    some = lambda low: lambda df: df.filter(F.col("v") > low).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    summaries.refresh(spark, source, path, "d", some(0))
    spark.createDataFrame([(1, 0)], "d int, v int").write.mode("append").partitionBy("d").parquet(source)
    summaries.refresh(spark, source, path, "d", some(5))
    assert [r.d for r in tables.read_table(spark, path).collect()] == [2]


def test_window_reads_only_partitions_that_meet_it(spark, trades, tmp_path):
    path = str(tmp_path / "extents")
    summaries.refresh(spark, trades, path, "trade_date", summaries.extents("trade_date"))
    extents = tables.read_table(spark, path)
    until = extents.agg(F.max("max_ingest_time")).first()[0]
    since = until - timedelta(hours=30)
    got = summaries.between(spark, trades, extents, "trade_date", "ingest_time", since, until)
    whole = tables.read_table(spark, trades)
    assert got.count() == whole.filter((F.col("ingest_time") >= lit(since)) & (F.col("ingest_time") <= lit(until))).count() > 0
    pruned = [line for line in formatted(got).splitlines() if line.startswith("PartitionFilters")]
    assert pruned and all("2026-06-09" in line and "2026-06-07" not in line for line in pruned)
    same(slo.latency(got, lit(until), 1800), slo.latency(whole, lit(until), 1800))
    fresh = summaries.freshness(extents, extents, lit(until)).filter("source = 'trades'")
    same(fresh, slo.freshness(whole, whole, lit(until)).filter("source = 'trades'"))
    counted = summaries.layer_counts({"trades": (extents, "n"), "none": (extents.limit(0), "n")})
    assert sorted(map(tuple, counted.collect())) == [("none", 0), ("trades", 4000)]
    assert summaries.raw_extent({"t": extents}).first().oldest == whole.agg(F.min("ingest_time")).first()[0]


@pytest.mark.parametrize("hour", [0.5, 24, 47.25, 60])
def test_key_profile_of_a_window(spark, tmp_path, hour):
    source, path = str(tmp_path / "raw"), str(tmp_path / "keys")
    rows = []
    for i in range(300):
        at = START + timedelta(seconds=731 * i, microseconds=i)
        extra = {"xs": 1.5} if i % 7 == 0 else {"q": 5} if i % 5 == 0 else {}
        rows.append((trade_json("A", i, 1, 1, **extra), at))
        rows.append((depth_json("A", i, [], []), at))
    stored = raw(spark, rows).withColumn("ingest_date", F.to_date("ingest_time"))
    stored.write.partitionBy("ingest_date").parquet(source)
    summaries.refresh(spark, source, path, "ingest_date", summaries.key_minutes("ingest_date"))
    as_of = START + timedelta(hours=hour)
    kept = tables.read_table(spark, source)
    got = summaries.key_profile(tables.read_table(spark, path), kept, "RAW", as_of)
    same(got, drift.key_profile(kept, "RAW", as_of))
    # the window reaches the scans of both as partitions
    assert formatted(got).count("PartitionFilters: [isnotnull(ingest_date") == 2


def test_sketched_latency_keeps_its_bound(spark, trades, tmp_path):
    path = str(tmp_path / "delays")
    summaries.refresh(spark, trades, path, "trade_date", summaries.delay_sketches("trade_date"))
    last = START + timedelta(days=9)
    whole = tables.read_table(spark, trades)
    inside = whole.filter((F.col("ingest_time") >= lit(last - timedelta(days=5, minutes=-1))) & (F.col("ingest_time") < lit(last + timedelta(minutes=1))))
    got = {r.symbol: r for r in summaries.latency(tables.read_table(spark, path), lit(last), 5 * 1440).collect()}
    ms = F.unix_millis(F.col("ingest_time").cast("timestamp")) - F.unix_millis(F.col("traded_at").cast("timestamp"))
    for symbol in "AB":
        values = sorted(r[0] for r in inside.filter(F.col("symbol") == symbol).select(ms).collect())
        assert got[symbol].trades == len(values)
        assert got[symbol].avg_latency_s == pytest.approx(sum(values) / len(values) / 1000, abs=6e-4)
        p = got[symbol].p95_latency_s * 1000
        assert sum(v < p - 0.5 for v in values) / len(values) <= 0.96 and sum(v <= p + 0.5 for v in values) / len(values) >= 0.94


def test_model_from_moments_equals_training(spark, tmp_path):
    rng, rows = random.Random(9), []
    for i in range(6000):
        at = START + timedelta(minutes=2 * i)
        rows.append((rng.choice("AB"), at, None if i % 40 == 0 else 1e6 + rng.random(), at.date()))
    rows.append(("ONE", START, 5.0, START.date()))
    source, path = str(tmp_path / "bars"), str(tmp_path / "moments")
    spark.createDataFrame(rows, "symbol string, minute timestamp_ntz, volume double, bar_date date").write.partitionBy("bar_date").parquet(source)
    summaries.refresh(spark, source, path, "bar_date", summaries.volume_moments("bar_date"))
    first, last = date(2026, 6, 1), date(2026, 6, 7)
    got = summaries.volume_model(tables.read_table(spark, path), F.lit(first), F.lit(last))
    want = anomaly.train(tables.read_table(spark, source).filter(F.col("bar_date").between(first, last)))
    name = lambda r: (r.symbol, -1 if r.hour is None else r.hour)
    have, exact = sorted(got.collect(), key=name), sorted(want.collect(), key=name)
    assert [(*name(r), r.n) for r in have] == [(*name(r), r.n) for r in exact]
    for a, b in zip(have, exact):
        assert a.mean == pytest.approx(b.mean, rel=1e-12)
        assert a.deviation == b.deviation is None or a.deviation == pytest.approx(b.deviation, rel=1e-9)


def test_profile_from_facts(spark, trades, tmp_path):
    kinds = {"symbol": "string", "trade_id": "bigint", "price": "decimal(38,8)", "maker": "boolean", "traded_at": "timestamp_ntz"}
    path = str(tmp_path / "facts")
    summaries.refresh(spark, trades, path, "trade_date", summaries.column_facts("trade_date", list(kinds)))
    got = {r.column_name: r for r in summaries.profile(tables.read_table(spark, path), kinds).collect()}
    want = {r.column_name: r for r in quality.profile(tables.read_table(spark, trades), list(kinds)).collect()}
    for name, r in want.items():
        assert (got[name].min_value, got[name].max_value, got[name].nulls) == (r.min_value, r.max_value, r.nulls)
        assert abs(got[name].distinct_values - r.distinct_values) <= 0.03 * r.distinct_values


def test_compaction_of_closed_days(spark, tmp_path):
    path = str(tmp_path / "raw")
    for batch in range(6):
        rows = [(f"m{batch}", START + timedelta(days=batch % 3, minutes=batch))]
        assert tables.append_batch(spark.createDataFrame(rows, "value string, ingest_time timestamp_ntz"), path, batch) == 1
    rows = [("m5", START + timedelta(days=2, minutes=5))]
    tables.append_batch(spark.createDataFrame(rows, "value string, ingest_time timestamp_ntz"), path, 5)  # the batch again
    files = lambda d: len([f for f in spark.read.parquet(path).inputFiles() if f"ingest_date=2026-06-0{d}" in f])
    assert [files(d) for d in (1, 2, 3)] == [2, 2, 2]
    assert tables.compact(spark, path, "ingest_date", "2026-06-03") == ["2026-06-01", "2026-06-02"]
    assert [files(d) for d in (1, 2, 3)] == [1, 1, 2]
    assert sorted(r.value for r in tables.read_table(spark, path).collect()) == [f"m{i}" for i in range(6)]
    assert tables.compact(spark, path, "ingest_date", "2026-06-03") == []
