"""Newest books from a small table: what the whole history gives, also where ids do not grow with time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import depth_json, formatted, messages, raw
from marketflow.operators import book
from marketflow.operators.depth import depth_messages, received_messages, unique_depth_levels, unique_messages
from marketflow.plans import newest
from marketflow.sources import messages as msg
from marketflow.sources import tables
from marketflow.streaming import ingest
from test_streams import same
from verification.queries import stream_settings

START = datetime(2026, 6, 1)


def feed(seed, n, ordered):
    rng, rows = random.Random(seed), []
    for i in range(n):
        at = START + timedelta(seconds=rng.randint(0, 5 * 86_400))
        id = int((at - START).total_seconds() * 1000) + i if ordered else rng.randint(1, 10**6) * 1000 + i
        side = lambda: [[str(rng.randint(1, 99)), str(rng.randint(1, 9))] for _ in range(rng.randint(0, 2))]
        text = depth_json(rng.choice(["A", "A", "A", "B", f"S{i % 7}"]), id, side(), side())
        rows.append((text, at))
        if i % 9 == 0:
            rows.append((text, at + timedelta(seconds=1)))
    return sorted(rows, key=lambda r: r[1])


@pytest.mark.parametrize("ordered", [True, False])
@pytest.mark.parametrize("minutes", [3, 120, 3000, 10_000])
def test_windows_equal_history(spark, tmp_path, ordered, minutes):
    rows = feed(minutes, 400, ordered)
    path = str(tmp_path / "books")
    for part in (rows[:150], rows[150:151], rows[151:]):
        newest.refresh_books(raw(spark, part), path)
    levels = unique_depth_levels(raw(spark, rows))
    as_of = F.lit(rows[-1][1]).cast("timestamp_ntz")
    same(newest.orderbook_live(spark, path, as_of, minutes), book.orderbook_live(levels, as_of, minutes))
    same(newest.latest_levels(spark, path), book.latest_levels(levels))
    kept = tables.read_table(spark, path)
    assert kept.count() < (30 if ordered else 120)


def test_a_batch_again_changes_nothing_and_silent_symbols_leave(spark, tmp_path):
    path = str(tmp_path / "books")
    rows = [(depth_json("OLD", 5, [["1", "1"]], [["2", "1"]]), START), (depth_json("NEW", 6, [["3", "1"]], [["4", "1"]]), START + timedelta(hours=5)), (depth_json("EMPTY", 7, [], []), START)]
    for _ in range(2):
        newest.refresh_books(raw(spark, rows), path)
    assert sorted(r.symbol for r in tables.read_table(spark, path).collect()) == ["NEW", "OLD"]
    live = newest.orderbook_live(spark, path, F.lit(START + timedelta(hours=5)).cast("timestamp_ntz"))
    assert [r.symbol for r in live.collect()] == ["NEW"]
    # the plan of a live read scans this table alone
    places = {line for line in formatted(live).splitlines() if line.startswith("Location")}
    assert len(places) == 1 and "books" in places.pop()
    # a later copy of a message does not bring its symbol back
    newest.refresh_books(raw(spark, [(rows[0][0], START + timedelta(hours=5))]), path)
    assert [r.symbol for r in newest.orderbook_live(spark, path, F.lit(START + timedelta(hours=5)).cast("timestamp_ntz")).collect()] == ["NEW"]
    # what is older than a live window can be left out
    newest.update_books(unique_messages(depth_messages(raw(spark, [(depth_json("OLD", 8, [["1", "1"]], []), START + timedelta(hours=9))]))), path, keep_minutes=60)
    assert {(r.symbol, r.last_update_id) for r in tables.read_table(spark, path).collect()} >= {("OLD", 8)}
    assert ("OLD", 5) not in {(r.symbol, r.last_update_id) for r in tables.read_table(spark, path).collect()}


def test_stream_keeps_the_table(spark, tmp_path):
    rows = feed(8, 120, True)
    for start in range(0, len(rows), 50):
        messages(spark, rows[start : start + 50]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    path = str(tmp_path / "books")
    with stream_settings(spark):
        routed = msg.route(ingest.stream_messages(spark, str(tmp_path / "in"), max_files=1))
        stream = routed.filter("route = 'depth'").select("record", "ingest_time")
        newest.stream_books(stream, path, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    levels = unique_depth_levels(raw(spark, rows))
    as_of = F.lit(rows[-1][1]).cast("timestamp_ntz")
    same(newest.orderbook_live(spark, path, as_of), book.orderbook_live(levels, as_of))


def test_a_micro_batch_goes_through_its_state_once(spark, tmp_path):
    rows = feed(9, 120, True)
    for part in (rows[:60], rows[60:], rows[100:]):  # the last brings copies only
        messages(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    path = str(tmp_path / "books")
    with stream_settings(spark):
        raw_depth = msg.route(ingest.stream_messages(spark, str(tmp_path / "in"), max_files=1)).select("record", "ingest_time")
        query = newest.stream_books(raw_depth, path, str(tmp_path / "cp"), availableNow=True)
        query.awaitTermination()
    states = [state for told in query.recentProgress for state in told.stateOperators]
    # the figures of a state add up over all its runs
    assert len(states) > 2 and sum(state.numRowsUpdated for state in states) == len({text for text, _ in rows})
    as_of = F.lit(rows[-1][1]).cast("timestamp_ntz")
    same(newest.orderbook_live(spark, path, as_of), book.orderbook_live(unique_depth_levels(raw(spark, rows)), as_of))


def test_depth_within_from_messages(spark):
    rows = feed(3, 200, True)
    want = book.depth_within(unique_depth_levels(raw(spark, rows)), 2000)
    same(book.message_depth_within(unique_messages(depth_messages(raw(spark, rows))), 2000), want)


def test_received_in_a_span(spark):
    rows = feed(4, 300, True)
    since, until = START + timedelta(days=2), START + timedelta(days=3)
    whole = unique_messages(depth_messages(raw(spark, rows))).filter((F.col("ingest_time") >= F.lit(since).cast("timestamp_ntz")) & (F.col("ingest_time") <= F.lit(until).cast("timestamp_ntz")))
    same(received_messages(raw(spark, rows), since, until), whole)
