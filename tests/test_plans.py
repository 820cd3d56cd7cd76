"""What the plans must look like to hold on large data, and results under skew."""

import re
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import SF
from helpers import NOON, formatted, plan, raw, trade_json
from marketflow.operators import metrics
from marketflow.operators.bars import for_symbol, ohlcv
from marketflow.operators.book import latest_levels
from marketflow.operators.trades import live_window, stg_trades
from marketflow.sources import tables
from verification.queries import REGISTRY


def test_dedup_limits_each_group_before_the_shuffle(spark):
    text = plan(stg_trades(raw(spark, [(trade_json("A", 1, 1, 1), NOON)])))
    assert "Partial" in text[text.index("Exchange"):]
    assert text.count("WindowGroupLimit") == 2


def test_bars_aggregate_by_hash_partly_before_the_shuffle(spark):
    text = plan(ohlcv(stg_trades(raw(spark, [(trade_json("A", 1, 1, 1), NOON)]))))
    assert "SortAggregate" not in text and "partial_min_by" in text


def test_one_shuffle_from_message_to_book(spark):
    text = plan(REGISTRY["fct_orderbook_snapshots"](spark, SF))
    assert "collect_list" not in text  # the messages are stored
    assert text.count("Exchange hashpartitioning") == 1


def test_live_window_and_symbol_reach_the_scan(spark, out):
    stg = REGISTRY["stg_trades"](spark, SF).withColumn("trade_date", F.to_date("traded_at"))
    stg.write.partitionBy("trade_date").parquet(out)
    stored = tables.read_table(spark, out)
    text = formatted(for_symbol(live_window(stored, "traded_at", NOON, 60), "CLICK").select("price"))
    assert "GreaterThanOrEqual(traded_at" in text and "EqualTo(symbol,CLICK)" in text
    assert "ReadSchema: struct<symbol:string,price:double,traded_at:timestamp_ntz>" in text


def test_latest_levels_do_not_meet_by_symbol(spark):
    text = plan(latest_levels(REGISTRY["stg_depth_levels"](spark, SF)))
    assert "Window [max" not in text


def test_upsert_reads_only_touched_partitions(spark, out):
    stg = REGISTRY["stg_trades"](spark, SF).withColumn("d", F.to_date("traded_at"))
    tables.insert_first(stg, out, ["trade_uid"], "d")
    some = stg.filter(F.col("traded_at").between("2024-01-05", "2024-01-06"))
    affected = tables.affected(some, out, "d")
    assert re.search(r"PartitionFilters: \[.*2024-01-05", formatted(affected))
    assert {str(r.d) for r in affected.select("d").distinct().collect()} == {"2024-01-05"}


def test_a_third_of_all_rows_in_one_copy_group_and_one_minute(spark):
    hot = [(trade_json("HOT", 1, 7, 2), NOON + timedelta(milliseconds=i)) for i in range(3000)]
    rest = [
        (trade_json("LOW", i, 5, 1, NOON + timedelta(seconds=i % 50)), NOON) for i in range(2, 6000)
    ]
    df = raw(spark, hot + rest).repartition(8)
    unique = stg_trades(df)
    assert unique.count() == 5999
    assert unique.filter("symbol = 'HOT'").first().ingest_time == NOON
    bars = {r.symbol: r for r in ohlcv(unique).collect()}
    assert (bars["HOT"].trade_count, bars["LOW"].trade_count, bars["LOW"].volume) == (1, 5998, 5998)


def test_series_of_a_hot_symbol_are_several_groups(spark):
    minutes = spark.range(0, 10_000).select(
        F.lit("HOT").alias("symbol"),
        (F.lit(NOON).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("minute"),
        (100 + F.col("id") % 9).cast("decimal(38,8)").alias("close"),
        (1 + F.col("id") % 5).cast("decimal(38,8)").alias("volume"),
    )
    from marketflow.operators.series import in_blocks, numbered

    sizes = in_blocks(numbered(minutes)).groupBy("symbol", "_block").count().collect()
    assert len(sizes) == 5 and max(r["count"] for r in sizes) <= 2048 + 32
    assert metrics.market_metrics(minutes).count() == 10_000
