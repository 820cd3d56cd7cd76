"""Streams give what the batch operators give on the same messages."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOON, depth_json, messages, trade_json
from marketflow.functions.timecols import from_millis
from marketflow.operators.bars import ohlcv
from marketflow.operators.book import message_snapshots
from marketflow.operators.depth import depth_messages, unique_messages
from marketflow.operators.rsi import rsi_wilder
from marketflow.operators.trades import stg_trades
from marketflow.sources import messages as msg
from marketflow.sources import tables
from marketflow.streaming import bars as stream_bars
from marketflow.streaming import book as stream_book
from marketflow.streaming import firsts as stream_firsts
from marketflow.streaming import ingest
from marketflow.streaming import rsi as stream_rsi
from verification.queries import stored_stream, stream_settings


@pytest.fixture
def arrivals(spark, tmp_path):
    """Three files of messages in the order of arrival, with copies across files."""
    rng, rows = random.Random(5), []
    for i in range(1, 241):
        at = NOON + timedelta(seconds=15 * i)
        symbol = "HOT" if i % 3 else "LOW"
        text = trade_json(symbol, i, 100 + rng.randint(-5, 5), rng.randint(1, 9), at, maker=i % 2 == 0)
        rows.append((text, at + timedelta(milliseconds=80)))
        if i % 7 == 0:
            rows.append((text, at + timedelta(minutes=4)))
        if i % 11 == 0:
            rows.append((depth_json(symbol, i, [["9", "1"]], [["11", str(i)]]), at))
            rows.append((depth_json(symbol, i, [["9", "1"]], [["11", str(i)]]), at + timedelta(seconds=2)))
    rows.append(("{bad", NOON))
    rows.sort(key=lambda row: row[1])
    path, third = str(tmp_path / "in"), len(rows) // 3 + 1
    for start in range(0, len(rows), third):
        messages(spark, rows[start: start + third]).coalesce(1).write.mode("append").parquet(path)
    return path


def raw_stream(spark, path, target):
    routed = msg.route(ingest.stream_messages(spark, path, max_files=1))
    return routed.filter(F.col("route") == target).select("record", "ingest_time")


def raw_batch(spark, path, target):
    return msg.raw_table(msg.read_messages(spark, path), target)


def same(left, right):
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(
        map(tuple, right.select(*left.columns).collect()), key=repr
    )


def test_both_sinks_and_a_restart(spark, arrivals, tmp_path):
    def run():
        ingest.write_raw(
            ingest.stream_messages(spark, arrivals, max_files=1),
            str(tmp_path / "trades"), str(tmp_path / "depth"), str(tmp_path / "cp"), availableNow=True,
        ).awaitTermination()

    run()
    run()  # nothing new: nothing is stored twice
    for target in ("trades", "depth"):
        stored = tables.read_table(spark, str(tmp_path / target))
        assert stored.count() == raw_batch(spark, arrivals, target).count()


def test_unique_trades(spark, arrivals):
    with stream_settings(spark):
        unique = stored_stream(stream_bars.unique_trades(raw_stream(spark, arrivals, "trades")), "u")
    same(unique.drop("ingest_time"), stg_trades(raw_batch(spark, arrivals, "trades")))


def trade_files(spark, path, files):
    for rows in files:
        messages(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_first_received_in_and_across_batches(spark, tmp_path):
    """Inside a batch the earliest copy; a later batch passes on only what was received earlier still, marked."""
    path, at = str(tmp_path / "in"), NOON
    copy = lambda i, seconds, minute=0: (trade_json("A", i, 1, 1, at + timedelta(minutes=minute)), at + timedelta(minutes=minute, seconds=seconds))
    trade_files(spark, path, [
        [copy(1, 9), copy(1, 3), copy(1, 5), copy(2, 4), copy(2, 4), copy(3, 8)],
        [copy(1, 2), copy(2, 6), copy(3, 9), copy(4, 1), copy(2**53 + 1, 1)],
        [copy(4, 2), copy(2**53 + 2, 1), copy(2**53 + 1, 3), copy(3, 1)],
    ])
    with stream_settings(spark):
        found = stored_stream(stream_firsts.first_trades(raw_stream(spark, path, "trades")), "first")
    got = sorted((r.trade_id, (r.ingest_time - at).seconds, r.corrects) for r in found.collect())
    assert got == [(1, 2, True), (1, 3, False), (2, 4, False), (3, 1, True), (3, 8, False), (4, 1, False), (2**53 + 1, 1, False), (2**53 + 2, 1, False)]


def test_first_received_equals_the_batch_dedup(spark, arrivals):
    with stream_settings(spark):
        found = stored_stream(stream_firsts.first_trades(raw_stream(spark, arrivals, "trades"), span_seconds=600), "first")
    assert found.filter("corrects").count() == 0
    want = stg_trades(raw_batch(spark, arrivals, "trades"))
    same(found.drop("corrects"), want.drop("trade_uid"))


def test_first_received_state_expires(spark, tmp_path):
    """A copy behind the watermark is late; the state of its span is gone."""
    path = str(tmp_path / "in")
    one = lambda i, minute: (trade_json("A", i, 1, 1, NOON + timedelta(minutes=minute)), NOON + timedelta(minutes=minute, seconds=1))
    trade_files(spark, path, [[one(1, 0)], [one(2, 60)], [one(3, 61)], [one(1, 0), one(4, 58)]])
    with stream_settings(spark):
        found = stored_stream(stream_firsts.first_trades(raw_stream(spark, path, "trades"), "5 minutes"), "first")
    assert sorted(r.trade_id for r in found.collect()) == [1, 2, 3, 4]


def test_counters_of_a_running_stream(spark, arrivals, tmp_path):
    """Sums equal the batch twin, live and stored; a batch that is run again replaces its figures."""
    live = ingest.IngestCounters()
    spark.streams.addListener(live)
    try:
        for _ in range(2):
            query = ingest.write_raw(
                ingest.stream_messages(spark, arrivals, max_files=1),
                str(tmp_path / "t"), str(tmp_path / "d"), str(tmp_path / "cp"),
                counters_path=str(tmp_path / "counters"), live=live, availableNow=True,
            )
            query.awaitTermination()
            spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(live)
    want = msg.ingest_counters(msg.read_messages(spark, arrivals)).first().asDict()
    want["written"] = want["accepted"]
    assert live.totals() == want and live.state == "ended" and len(live.batches) == 3
    stored = tables.read_table(spark, str(tmp_path / "counters"))
    assert ingest.counters(spark, str(tmp_path / "counters")).first().asDict() == want
    assert sorted(r.batch_id for r in stored.collect()) == [0, 1, 2]
    # batch 2 once more, as after a driver that died before the commit
    again = stored.filter("batch_id = 2").drop("ingest_date")
    tables.append_batch(again, str(tmp_path / "counters"), 2)
    assert ingest.counters(spark, str(tmp_path / "counters")).first().asDict() == want


def test_rsi_of_raw_trades_in_one_query(spark, tmp_path):
    """Dedup, bars and index in one query equal the batch index of the bars that the watermark closed."""
    path, rows = str(tmp_path / "in"), []
    for i in range(200):
        at = NOON + timedelta(seconds=20 * i)
        text = trade_json("A" if i % 3 else "B", i, 100 + i * 7919 % 13, 1 + i % 4, at)
        rows += [(text, at + timedelta(seconds=1))] + ([(text, at + timedelta(seconds=9))] if i % 5 == 0 else [])
    trade_files(spark, path, [rows[:90], rows[90:170], rows[170:]])
    with stream_settings(spark):
        stream = stream_rsi.stream_rsi_of_trades(raw_stream(spark, path, "trades"), delay="2 minutes")
        got = stored_stream(stream, "rsi").orderBy("symbol", "rn").collect()
    bars = ohlcv(stg_trades(msg.raw_table(msg.read_messages(spark, path), "trades")))
    edge = NOON + timedelta(seconds=20 * 199) - timedelta(minutes=2)
    want = [r for r in rsi_wilder(bars).orderBy("symbol", "rn").collect() if r.minute + timedelta(minutes=1) <= edge]
    assert [(r.symbol, r.minute, r.rn) for r in got] == [(r.symbol, r.minute, r.rn) for r in want]
    assert any(r.rsi_14 is not None for r in got)
    for have, expected in zip(got, want):
        assert have.rsi_14 is None or float(have.rsi_14) == pytest.approx(float(expected.rsi_14), abs=2e-8)


def test_bars_by_state_and_by_table(spark, arrivals, tmp_path):
    want = ohlcv(stg_trades(raw_batch(spark, arrivals, "trades")))
    with stream_settings(spark):
        stream_bars.upsert_bars(
            stream_bars.stream_ohlcv(raw_stream(spark, arrivals, "trades")),
            str(tmp_path / "bars"), str(tmp_path / "cp"), availableNow=True,
        ).awaitTermination()
        stream_bars.maintain_facts(
            raw_stream(spark, arrivals, "trades"),
            str(tmp_path / "t"), str(tmp_path / "b"), str(tmp_path / "cp2"), availableNow=True,
        ).awaitTermination()
    same(tables.read_table(spark, str(tmp_path / "bars")).drop("bar_date"), want)
    same(tables.read_table(spark, str(tmp_path / "b")).drop("bar_date"), want)
    kept = tables.read_table(spark, str(tmp_path / "t")).select("trade_uid", "ingest_time")
    same(kept, stg_trades(raw_batch(spark, arrivals, "trades")))


def test_books(spark, arrivals):
    with stream_settings(spark):
        books = stored_stream(stream_book.stream_orderbook(raw_stream(spark, arrivals, "depth")), "b")
    batch = message_snapshots(unique_messages(depth_messages(raw_batch(spark, arrivals, "depth"))))
    same(books.drop("ingest_time"), batch)


def test_trades_beyond_the_watermark_are_dropped(spark, tmp_path):
    """A batch is judged by the watermark that held when the batch before it ran."""
    path = str(tmp_path / "in")
    for i, minute in ((1, 0), (2, 60), (5, 61), (3, 1), (4, 58)):
        at = NOON + timedelta(minutes=minute)
        messages(spark, [(trade_json("A", i, 1, 1, at), at)]).coalesce(1).write.mode("append").parquet(path)
    with stream_settings(spark):
        stream = stream_bars.unique_trades(raw_stream(spark, path, "trades"), "5 minutes")
        kept = stored_stream(stream, "late")
    assert sorted(r.trade_id for r in kept.collect()) == [1, 2, 4, 5]


def test_rsi_over_three_batches(spark, tmp_path):
    path, start = str(tmp_path / "bars"), datetime(2026, 6, 10)
    bars = spark.range(0, 120).select(
        F.when(F.col("id") % 4 == 0, "LOW").otherwise("HOT").alias("symbol"),
        from_millis(F.col("id") * 60_000 + int(start.timestamp() * 1000)).alias("minute"),
        (100 + (F.col("id") * 7919) % 13).cast("decimal(38,8)").alias("close"),
    )
    for low in (0, 40, 80):
        part = bars.orderBy("minute").offset(low).limit(40)
        part.coalesce(1).write.mode("append").parquet(path)
    with stream_settings(spark):
        stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).parquet(path)
        got = stored_stream(stream_rsi.stream_rsi(stream), "rsi").orderBy("symbol", "rn").collect()
    want = rsi_wilder(bars).orderBy("symbol", "rn").collect()
    assert [(r.symbol, r.minute, r.rn) for r in got] == [(r.symbol, r.minute, r.rn) for r in want]
    for have, expected in zip(got, want):
        assert (have.rsi_14 is None) == (expected.rsi_14 is None)
        assert have.rsi_14 is None or float(have.rsi_14) == pytest.approx(float(expected.rsi_14), abs=2e-8)
