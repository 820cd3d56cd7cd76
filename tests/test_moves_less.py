"""Steps that move keys or whole messages instead of levels give what the level by level way gives."""

import os
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from helpers import depth_json, formatted, messages, raw
from marketflow.operators import quality
from marketflow.operators.depth import depth_messages, unique_messages
from marketflow.plans import facts, newest
from marketflow.sources import tables
from marketflow.sources.messages import parse
from marketflow.streaming import ingest
from test_streams import same
from verification import inputs

START = datetime(2026, 6, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def book(id, n, symbol="A"):
    return depth_json(symbol, id, [["1", str(k + 1)] for k in range(n)], [["2", "1"]] * (n // 2))


def test_depth_build_equals_a_merge_of_levels(spark, out):
    first = [(book(1, 2), at(0)), (book(2, 3), at(10)), (book(20_000_001, 2), at(10))]
    later = [(book(2, 3), at(6)), (book(2, 5), at(11)), (book(20_000_001, 4), at(9)), (book(3, 2), at(12)), (book(3, 2), at(12)), (book(30_000_000, 1, "B"), at(13)), (book(4, 0), at(14))]
    nameless = [('{"stream": "a@depth", "data": {"bids": [["1", "1"]], "asks": []}}', at(12))]
    facts.refresh_depth_table(raw(spark, first), out)
    target = facts.fct_depth_snapshots(raw(spark, first)).localCheckpoint()
    for _ in range(2):
        facts.refresh_depth_table(raw(spark, first + later + nameless), out)
        got = tables.read_table(spark, out).drop("id_range")
        same(got.orderBy("symbol", "last_update_id", "side", "level"), facts.incremental_depth(target, raw(spark, first + later + nameless)).orderBy("symbol", "last_update_id", "side", "level"))


@pytest.mark.parametrize("rows", [
    [("A", 1, 0), ("A", 1, 1), ("A", 2, 0)],
    [("A", 1, 0), ("A", 1, 0), ("A", 1, 2), ("A", 2, 62), ("A", 2, 62), ("B", 2, 62)],
    [("A", 1, 63), ("A", 1, 63), ("A", 1, 64), ("A", 1, -1), ("A", 1, -1), ("A", 2, 70), ("A", 3, 0)],
    [(None, 1, 0), (None, 1, 0), ("A", None, 1), ("A", 1, None), ("A", 1, None), ("A", 1, 4)],
    [],
])
def test_duplicates_by_position_equal_those_by_key(spark, rows):
    df, keys = spark.createDataFrame(rows, "s string, id bigint, level int"), ["s", "id", "level"]
    want = sorted(map(tuple, quality.duplicate_keys(df, keys).collect()))
    assert sorted(map(tuple, quality.duplicate_keys(df, keys, position="level").collect())) == want


def test_first_copies_are_told_without_sides(spark):
    side = ["null", "[]", '[["1", "1"]]', '[["2", "1"]]']
    rows = []
    for i, (b, a, c, d) in enumerate((b, a, c, d) for b in side for a in side for c in side for d in side):
        text = '{"stream": "a@depth", "data": {"lastUpdateId": %d, "bids": %s, "asks": %s}}'
        rows += [(text % (i, b, a), at(i % 3)), (text % (i, c, d), at(1)), (text % (i, d, b), None if i % 50 == 0 else at(2))]
    deep = depth_messages(raw(spark, rows))
    whole = unique_messages(deep).filter("ingest_time IS NOT NULL AND coalesce(size(bids), 0) + coalesce(size(asks), 0) > 0")
    ids = ["symbol", "last_update_id", "ingest_time"]
    same(newest._first_copies(deep).orderBy(*ids), whole.select(*ids).orderBy(*ids))


def test_newest_books_of_a_batch_shuffle_no_sides(spark):
    told = formatted(newest.staircase(newest._first_copies(depth_messages(parse(messages(spark, [(book(1, 2), START)]))))))
    assert "Exchange" in told and not any("bids" in line for block in told.split("\n\n") if ") Exchange" in block for line in block.splitlines())


def test_arriving_messages_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        made.add(1)
        return str(i)

    received = (F.lit(START) + F.make_dt_interval(mins=F.col("id").cast("int"))).cast("timestamp_ntz")
    told = spark.range(30).select(text("id").alias("value"), F.array(received).alias("times")).select("value", F.explode("times").alias("ingest_time"))
    path = inputs.arrival_files(told, "arriving", [at(10), at(20)])
    assert made.value == 30
    assert sorted(int(r.value) for r in spark.read.parquet(path).collect()) == list(range(30))


def test_raw_records_are_written_as_they_are(spark, out):
    tables.append_batch(raw(spark, [(book(k, 3), at(k)) for k in range(20)]), out, 0)
    file = next(os.path.join(folder, name) for folder, _, names in os.walk(out) for name in names if name.endswith(".parquet"))
    assert "typed_value" not in str(pq.read_schema(file))


def test_a_stream_keeps_no_text_of_a_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    messages(spark, [(book(1, 2), at(0)), ("{bad", at(1)), ('{"stream": "a@kline"}', at(2))]).write.parquet(source)
    kept, keep = [], DataFrame.persist

    def noting(df, *args):
        kept.append(df.columns)
        return keep(df, *args)

    DataFrame.persist = noting
    try:
        paths = [str(tmp_path / name) for name in ("trades", "depth", "checkpoint")]
        ingest.write_raw(ingest.stream_messages(spark, source), *paths, counters_path=str(tmp_path / "counters"), availableNow=True).awaitTermination()
    finally:
        DataFrame.persist = keep
    assert kept and all("value" not in columns for columns in kept)
    assert tuple(ingest.counters(spark, str(tmp_path / "counters")).first()) == (3, 1, 1, 1, 1)
