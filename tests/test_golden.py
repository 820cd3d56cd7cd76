"""Known inputs with known results."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import NOON, bars, depth_json, messages, raw, trade_json
from marketflow.functions import labels
from marketflow.functions.timecols import at
from marketflow.operators import book, depth, drift, flow, merge, metrics, quality, rsi, slo
from marketflow.operators.bars import ohlcv
from marketflow.operators.trades import enrich_trades, flatten_trades, stg_trades
from marketflow.sources import messages as msg


def test_bar_of_one_minute(spark):
    ticks = [(1, 100, 2, 5), (2, 102, 1, 20), (3, 99, 3, 40), (4, 101, 4, 55)]
    rows = [
        (trade_json("BTCUSDT", i, p, q, NOON + timedelta(seconds=s)), NOON) for i, p, q, s in ticks
    ]
    bar = ohlcv(stg_trades(raw(spark, rows))).first()
    assert (bar.minute, bar.open, bar.high, bar.low, bar.close) == (NOON, 100, 102, 99, 101)
    assert (bar.volume, bar.trade_count, bar.quote_volume) == (10, 4, 1003)
    assert bar.vwap == Decimal("100.3")


def test_vwap_rounds_a_half_up(spark):
    rows = [(trade_json("A", 1, "17.55", "2.1"), NOON), (trade_json("A", 2, "19.4", "10.7"), NOON)]
    bar = ohlcv(stg_trades(raw(spark, rows))).first()
    exact = (Decimal("17.55") * Decimal("2.1") + Decimal("19.4") * Decimal("10.7")) / Decimal("12.8")
    assert bar.vwap == exact.quantize(Decimal("1e-8"), rounding="ROUND_HALF_UP")


def test_rsi_of_an_alternating_series_is_fifty(spark):
    closes = [100 + i % 2 for i in range(15)] + [100]
    index = [r.rsi_14 for r in rsi.rsi_wilder(bars(spark, closes)).orderBy("rn").collect()]
    assert index[:14] == [None] * 14
    assert index[14:] == [50, 50]


@pytest.mark.parametrize("closes, expected", [([100 + i for i in range(20)], 100), ([100] * 20, 50),
                                              ([100 - i for i in range(20)], 0)])
def test_rsi_of_monotone_and_flat_series(spark, closes, expected):
    last = metrics.latest_per_symbol(metrics.market_metrics(bars(spark, closes))).first()
    assert last.rsi_14 == expected


def test_routing(spark):
    texts = ['{"stream":"x@trade"}', '{"stream":"x@depth20@1000ms"}', '{"stream":"x@kline_1m"}', "{oops",
             '{"nothing":1}']
    routed = msg.route(messages(spark, [(t, NOON) for t in texts])).collect()
    assert [r.route for r in routed] == ["trades", "depth", "unknown", "malformed", "unknown"]
    counters = msg.ingest_counters(messages(spark, [(t, NOON) for t in texts])).first().asDict()
    assert counters == {"received": 5, "accepted": 2, "ignored": 2, "failed": 1}


def test_receipt_time_is_kept(spark):
    row = flatten_trades(raw(spark, [(trade_json("A", 1, 1, 1), NOON)])).first()
    assert row.ingest_time == NOON and row.ingest_time.tzinfo is None


def test_first_received_copy_stays_and_reruns_agree(spark):
    late = NOON + timedelta(seconds=9)
    rows = [(trade_json("A", 1, 5, 1), late), (trade_json("A", 1, 5, 1), NOON), (trade_json("A", 2, 5, 1), late)]
    once = stg_trades(raw(spark, rows))
    assert {(r.trade_uid, r.ingest_time) for r in once.collect()} == {("A-1", NOON), ("A-2", late)}
    doubled = stg_trades(raw(spark, rows + rows))
    assert sorted(map(tuple, doubled.collect())) == sorted(map(tuple, once.collect()))


def test_unknown_flag_and_missing_keys(spark):
    text = '{"stream":"a@trade","data":{"t":7,"p":"2","q":"3"}}'
    row = enrich_trades(stg_trades(raw(spark, [(text, NOON)]))).first()
    assert (row.taker_side, row.trade_value, row.traded_at) == ("buy", 6, None)
    nameless = stg_trades(raw(spark, [('{"data":{"t":7}}', NOON)])).first()
    assert nameless.trade_uid is None


def test_value_of_another_type_is_null_not_an_error(spark):
    row = flatten_trades(raw(spark, [('{"stream":"a@trade","data":{"t":"x","p":"abc"}}', NOON)])).first()
    assert row.trade_id is None and row.price is None


@pytest.mark.parametrize(
    "started, recv, write, state, ok",
    [
        (-10, None, None, "starting", True),
        (-90, None, None, "no_data", False),
        (-90, -5, -5, "healthy", True),
        (-90, -40, -5, "stale", False),
        (-90, -40, None, "stale", False),
        (-10, -5, None, "starting", True),
        (-90, -5, None, "write_stalled", False),
        (-90, -5, -40, "write_stalled", False),
    ],
)
def test_feed_health(spark, started, recv, write, state, ok):
    times = [None if s is None else NOON + timedelta(seconds=s) for s in (started, recv, write)]
    beats = spark.createDataFrame(
        [("f", *times)], "feed STRING, started_at TIMESTAMP_NTZ, recv_at TIMESTAMP_NTZ, write_at TIMESTAMP_NTZ"
    )
    row = slo.feed_health(beats, NOON).first()
    assert (row.state, row.ok) == (state, ok)


def test_drift_is_found_closed_and_cleaned(spark):
    rows = [(trade_json("A", 1, 1, 1), NOON), (trade_json("A", 999000111, 1, 1, xs=0.42), NOON)]
    table, known = raw(spark, rows), drift.known_keys(spark)

    def found(raw_table, baseline):
        profile = drift.key_profile(raw_table, "RAW_TRADES", NOON)
        return [tuple(r) for r in drift.new_keys(profile, baseline).collect()]

    assert found(table, known) == [("RAW_TRADES", "xs", "DECIMAL", 1)]
    closed = known.unionByName(spark.createDataFrame([("RAW_TRADES", "xs")], known.schema))
    assert found(table, closed) == []
    cleaned = msg.delete_where(table, msg.path("data.t", "bigint") == 999000111)
    assert found(cleaned, known) == []
    holed = known.unionByName(spark.createDataFrame([("RAW_TRADES", None)], known.schema))
    assert found(table, holed) == [("RAW_TRADES", "xs", "DECIMAL", 1)]


def test_delete_keeps_rows_without_the_field(spark):
    table = raw(spark, [('{"data":{}}', NOON), ('{"data":{"t":1}}', NOON)])
    assert msg.delete_where(table, msg.path("data.t", "bigint") == 1).count() == 1


def test_snapshots_that_share_a_receipt_time_do_not_cross(spark):
    rows = [
        (depth_json("A", 1, [["10", "1"]], [["11", "1"]]), NOON),
        (depth_json("A", 2, [["20", "1"]], [["21", "1"]]), NOON),
    ]
    books = book.orderbook_snapshots(depth.unique_depth_levels(raw(spark, rows)))
    assert books.count() == 2
    assert book.crossed_books(books).first()[0] == 0
    mixed = book.book_agg(depth.unique_depth_levels(raw(spark, rows)), ["symbol", "ingest_time"])
    assert book.crossed_books(mixed).first()[0] == 1


def test_repeated_depth_message_counts_once(spark):
    text = depth_json("A", 1, [["10", "2"], ["9", "1"]], [["11", "3"]])
    twice = raw(spark, [(text, NOON), (text, NOON + timedelta(seconds=1))])
    assert depth.stg_depth_levels(twice).count() == 6
    levels = depth.unique_depth_levels(twice)
    assert levels.count() == 3
    row = book.orderbook_snapshots(levels).first()
    assert (row.mid, row.imbalance, row.ingest_time) == (Decimal("10.5"), Decimal("0.5"), NOON)


def test_one_sided_and_empty_books(spark):
    rows = [
        (depth_json("A", 1, [["10", "2"]], []), NOON),
        (depth_json("B", 1, [], []), NOON),
        ('{"stream":"c@depth20","data":{"lastUpdateId":1}}', NOON),
    ]
    table = raw(spark, rows)
    by_levels = book.orderbook_snapshots(depth.unique_depth_levels(table)).collect()
    by_message = book.message_snapshots(depth.unique_messages(depth.depth_messages(table))).collect()
    assert by_levels == by_message
    assert len(by_levels) == 1
    row = by_levels[0]
    assert (row.best_ask, row.mid, row.spread_bps, row.imbalance) == (None, None, None, 1)


def test_microprice_and_live_book(spark):
    rows = [
        (depth_json("A", 1, [["1", "1"]], [["2", "1"]]), NOON),
        (depth_json("A", 2, [["10", "1"]], [["12", "3"]]), NOON),
    ]
    row = book.orderbook_live(depth.unique_depth_levels(raw(spark, rows)), NOON).first()
    assert (row.best_bid, row.mid, row.imbalance) == (10, 11, Decimal("0.25"))
    assert row.microprice == Decimal("10.5")


def test_short_series(spark):
    row = metrics.market_metrics(bars(spark, [100])).first()
    assert (row.volume_zscore, row.is_volume_anomaly, row.rsi_14, row.price_change_pct_1min) == (
        None, False, None, None)


def test_log_return_spans_a_missing_minute(spark):
    gap = bars(spark, [100]).unionByName(bars(spark, [110], start=NOON + timedelta(minutes=7)))
    last = metrics.log_returns(gap).orderBy(F.desc("rn")).first()
    assert last.log_return == pytest.approx(0.0953101798)
    assert last.delta == 10


def test_zero_prices_leave_ratios_unknown(spark):
    rows = metrics.market_metrics(bars(spark, [100, 0, 50])).orderBy("minute").collect()
    assert [r.price_change_pct_1min for r in rows] == [None, -100, None]
    returns = metrics.log_returns(bars(spark, [100, 0, 50])).orderBy("rn").collect()
    assert [r.log_return for r in returns] == [None, None, None]


def test_row_rules_of_one_table_are_one_pass(spark):
    df = spark.range(10)
    rules = [("small", "warn", F.col("id") < 3), ("none", "error", F.col("id") < 0),
             ("undecided", "error", F.lit(None).cast("boolean"))]
    shown = {r.check_name: (r.failures, r.status) for r in quality.row_report(df, rules).collect()}
    assert shown == {"small": (3, "warn"), "none": (0, "pass"), "undecided": (0, "pass")}


def test_volume_anomaly_flag(spark):
    quiet = bars(spark, [100 + i % 3 for i in range(29)])
    wobble = quiet.withColumn("volume", F.col("volume") + F.minute("minute") % 2)
    loud = bars(spark, [100], volume=500, start=NOON + timedelta(minutes=29))
    last = metrics.latest_per_symbol(metrics.rolling_volume(wobble.unionByName(loud))).first()
    assert last.is_volume_anomaly and last.volume_zscore > 3


def test_freshness_of_an_empty_table_raises_no_alert(spark):
    empty = spark.createDataFrame([], "traded_at TIMESTAMP_NTZ, ingest_time TIMESTAMP_NTZ")
    assert slo.freshness_alert(empty, NOON).count() == 0
    stale = spark.createDataFrame([(NOON, NOON)], empty.schema)
    assert slo.freshness_alert(stale, NOON + timedelta(seconds=120)).count() == 0
    assert slo.freshness_alert(stale, NOON + timedelta(seconds=121)).first().value == 121


def test_verdict_and_labels(spark):
    cases = [(5, 80.0, True), (-5, 20.0, False), (0, None, False), (0, 50.0, False)]
    df = spark.createDataFrame(cases, "net INT, rsi DOUBLE, odd BOOLEAN")
    zone, push = labels.rsi_zone(F.col("rsi")), labels.pressure(F.col("net"))
    shown = [r[0] for r in df.select(labels.verdict(push, zone, F.col("odd"))).collect()]
    assert shown == [
        "buyers are pushing; RSI overbought; abnormal volume",
        "sellers are pushing; RSI oversold",
        "calm",
        "calm",
    ]


def test_alert_edges(spark):
    states = ["OK", "STALE", "STALE", "OK", "STALE"]
    log = spark.createDataFrame(
        [(NOON + timedelta(hours=9 * i), "m", s) for i, s in enumerate(states)],
        "checked_at TIMESTAMP_NTZ, metric STRING, status STRING",
    )
    edges = merge.alert_edges(log, F.to_date("checked_at")).orderBy("checked_at")
    assert [r.status for r in edges.collect()] == ["OK", "STALE", "OK", "STALE"]


def test_unknown_flag_counts_for_neither_side(spark):
    rows = [(trade_json("A", 1, 1, 2, maker=True), NOON), (trade_json("A", 2, 1, 3), NOON),
            (trade_json("A", 3, 1, 5, maker=None), NOON)]
    row = flow.taker_flow(stg_trades(raw(spark, rows))).first()
    assert (row.taker_buy, row.taker_sell, row.delta) == (3, 2, 1)


def test_checks_pass_on_clean_and_fail_on_broken_rows(spark):
    rows = [(trade_json("A", 1, 5, 1), NOON), (trade_json("A", 2, 6, 1), NOON)]
    clean = stg_trades(raw(spark, rows))
    assert quality.not_null(clean, clean.columns).agg(F.sum("failures")).first()[0] == 0
    assert quality.duplicate_keys(clean, ["trade_uid"]).count() == 0
    assert clean.filter(quality.trades_not_positive()).count() == 0
    assert clean.filter(quality.in_future(at(NOON))).count() == 0
    assert ohlcv(clean).filter(quality.ohlc_broken()).count() == 0
    broken = clean.withColumn("price", -F.col("price"))
    assert broken.filter(quality.trades_not_positive()).count() == 2
    assert quality.duplicate_keys(clean.unionByName(clean), ["trade_uid"]).count() == 2
    nulled = clean.withColumn("price", F.lit(None).cast("decimal(18,8)"))
    assert nulled.filter(quality.trades_not_positive()).count() == 0
    assert clean.filter(quality.in_future(at(NOON - timedelta(days=1)))).count() == 2
