"""Live views with an ``as_of`` in the past of the data."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from marketflow.operators import anomaly, merge
from marketflow.plans import live

START = datetime(2024, 1, 1)


def test_a_view_back_in_time_sees_nothing_later(spark):
    trades = spark.range(20_000).select(
        F.lit("A").alias("symbol"),
        F.col("id").alias("trade_id"),
        (F.lit(100) + F.col("id") % 7).cast("decimal(38,8)").alias("price"),
        F.lit(1).cast("decimal(38,8)").alias("quantity"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("traded_at"),
    )
    as_of = START + timedelta(minutes=9_000)
    got = live.market_metrics_live(trades, F.lit(as_of).cast("timestamp_ntz")).orderBy("minute").collect()
    assert len(got) == 121 and got[0].minute == as_of - timedelta(minutes=120) and got[-1].minute == as_of
    assert [r.rsi_14 is None for r in got[:15]] == [True] * 14 + [False]
    assert all(0 <= r.rsi_14 <= 100 for r in got[14:])


def test_bars_of_an_untrained_symbol_stay(spark):
    rows = [(s, START + timedelta(minutes=i), float(i)) for s, n in (("A", 30), ("NEW", 3)) for i in range(n)]
    bars = spark.createDataFrame(rows, "symbol string, minute timestamp_ntz, volume double")
    scored = anomaly.score(bars, anomaly.train(bars.filter("symbol = 'A'")), F.lit(START).cast("timestamp_ntz")).collect()
    new = [r for r in scored if r.symbol == "NEW"]
    assert len(scored) == 33 and len(new) == 3
    assert all(r.forecast is None and r.lower_bound is None and r.is_anomaly is False for r in new)


def test_alerts_panels_and_failed_runs_end_at_as_of(spark):
    hours = [START + timedelta(hours=h) for h in range(6)]
    scored = spark.createDataFrame([("A", t, 1.0, 0.0, 0.5, True, 2.0) for t in hours], "symbol string, minute timestamp_ntz, volume double, lower_bound double, upper_bound double, is_anomaly boolean, distance double")
    as_of = F.lit(hours[3]).cast("timestamp_ntz")
    assert anomaly.alert(scored, as_of, minutes=60).first().value == 2
    assert [r.minute for r in anomaly.panel(scored, "A", as_of, hours=2).collect()] == hours[1:4]
    runs = spark.createDataFrame([("x", "FAILED", t) for t in hours], "name string, state string, scheduled_time timestamp_ntz")
    assert sorted(r.scheduled_time for r in merge.failed_runs(runs, as_of, hours=1).collect()) == hours[2:4]


def test_a_registered_view_is_read_by_name(spark):
    bars = spark.createDataFrame([("A", hours) for hours in (START, START + timedelta(minutes=1))], "symbol string, minute timestamp_ntz")
    live.as_view(bars.filter("symbol = 'A'"), "some_bars")
    assert spark.sql("SELECT max(minute) FROM some_bars WHERE symbol = 'A'").first()[0] == START + timedelta(minutes=1)
