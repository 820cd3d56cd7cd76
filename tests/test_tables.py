"""Tables on disk: merging, recovery, retention."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import NOON, raw, trade_json
from marketflow.functions.timecols import at
from marketflow.operators import merge
from marketflow.plans import facts
from marketflow.sources import tables

SCHEMA = "k INT, v STRING, ingest_time TIMESTAMP_NTZ, d DATE"


def rows(spark, *items):
    return spark.createDataFrame(
        [(k, v, NOON + timedelta(seconds=s), date(2026, 6, k)) for k, v, s in items], SCHEMA
    )


def content(spark, path):
    return sorted((r.k, r.v) for r in tables.read_table(spark, path).collect())


def files(spark, path, day):
    folder = f"{path}/d=2026-06-{day:02d}"
    fs, location = tables._path(spark, folder)
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(location))


def test_upsert_replaces_adds_and_leaves_other_partitions_alone(spark, out):
    tables.upsert_table(rows(spark, (1, "a", 0), (2, "b", 0)), out, ["k"], "d")
    untouched = files(spark, out, 1)
    update = rows(spark, (2, "B", 1), (3, "c", 1))
    for _ in range(2):
        tables.upsert_table(update, out, ["k"], "d")
        assert content(spark, out) == [(1, "a"), (2, "B"), (3, "c")]
    assert files(spark, out, 1) == untouched
    assert not tables.exists(spark, tables._pending(out))


def test_insert_first_appends_only_new_keys(spark, out):
    tables.insert_first(rows(spark, (1, "a", 5), (2, "b", 5)), out, ["k"], "d")
    before = files(spark, out, 1)
    later = rows(spark, (1, "later", 9), (3, "c", 9))
    for _ in range(2):
        tables.insert_first(later, out, ["k"], "d")
        assert content(spark, out) == [(1, "a"), (2, "b"), (3, "c")]
    assert files(spark, out, 1) == before
    tables.insert_first(rows(spark, (2, "first", 1)), out, ["k"], "d")
    assert content(spark, out) == [(1, "a"), (2, "first"), (3, "c")]


def test_a_dead_job_is_completed_by_the_next(spark, out):
    tables.upsert_table(rows(spark, (1, "a", 0), (2, "b", 0)), out, ["k"], "d")
    # the job wrote the new content beside the table, removed the partition and died
    rows(spark, (2, "B", 1)).write.partitionBy("d").parquet(tables._pending(out))
    tables._drop_dates(spark, out, "d", lambda d: d == date(2026, 6, 2))
    tables.upsert_table(rows(spark, (3, "c", 2)), out, ["k"], "d")
    assert content(spark, out) == [(1, "a"), (2, "B"), (3, "c")]


def test_an_incomplete_leftover_is_dropped(spark, out):
    tables.upsert_table(rows(spark, (1, "a", 0)), out, ["k"], "d")
    rows(spark, (1, "half", 1)).write.partitionBy("d").parquet(tables._pending(out))
    fs, marker = tables._path(spark, tables._pending(out) + "/_SUCCESS")
    fs.delete(marker, False)
    tables.recover(spark, out)
    assert content(spark, out) == [(1, "a")]


def test_purge_drops_old_days_and_trims_the_edge(spark, out):
    stamps = [(1, datetime(2026, 6, 1, 5)), (2, datetime(2026, 6, 2, 5)), (3, datetime(2026, 6, 2, 15)),
              (4, datetime(2026, 6, 3))]
    df = spark.createDataFrame(stamps, "k INT, t TIMESTAMP_NTZ").withColumn("d", F.to_date("t"))
    df.write.partitionBy("d").parquet(out)
    tables.purge_table(spark, out, "t", datetime(2026, 6, 2, 12), "d")
    assert sorted(r.k for r in tables.read_table(spark, out).collect()) == [3, 4]
    tables.purge_table(spark, out, "t", datetime(2026, 6, 2, 23), "d")
    assert [r.k for r in tables.read_table(spark, out).collect()] == [4]


def test_replace_range_on_disk_equals_the_relation(spark, out):
    schema = "k INT, t TIMESTAMP_NTZ"
    old = [(i, datetime(2026, 6, 1) + timedelta(hours=9 * i)) for i in range(12)]
    new = [(100 + i, datetime(2026, 6, 2, 12) + timedelta(hours=i)) for i in range(3)]
    start = datetime(2026, 6, 2, 12)
    target = spark.createDataFrame(old, schema).withColumn("d", F.to_date("t"))
    updates = spark.createDataFrame(new, schema).withColumn("d", F.to_date("t"))
    want = sorted(r.k for r in merge.replace_range(target, updates, "t", at(start)).collect())
    for _ in range(2):
        tables.replace_range_table(target if not tables.exists(spark, out) else updates, out, "t", start, "d")
    assert sorted(r.k for r in tables.read_table(spark, out).collect()) == want


def test_rebuild_refuses_to_lose_history(spark, out):
    table = rows(spark, (1, "a", 0), (2, "b", 60))
    tables.rebuild(table, out, "ingest_time")
    shorter = rows(spark, (2, "b", 60))
    with pytest.raises(ValueError):
        tables.rebuild(shorter, out, "ingest_time")
    assert len(content(spark, out)) == 2
    tables.rebuild(shorter, out, "ingest_time", allow_shrink=True)
    assert content(spark, out) == [(2, "b")]


def test_a_repeated_batch_is_stored_once(spark, out):
    batch = raw(spark, [(trade_json("A", 1, 1, 1), NOON), (trade_json("A", 2, 1, 1), NOON)])
    tables.append_batch(batch, out, 0)
    tables.append_batch(batch, out, 1)
    tables.append_batch(batch, out, 1)
    assert tables.read_table(spark, out).count() == 4
    fs, location = tables._path(spark, out)
    assert [s.getPath().getName() for s in fs.listStatus(location)] == [f"ingest_date={NOON.date()}"]


def test_trades_table_keeps_the_first_copy_over_builds(spark, out):
    def at_second(s):
        return NOON + timedelta(seconds=s)

    first = [(trade_json("A", i, 5, 1, at_second(i)), at_second(i)) for i in range(1, 5)]
    again = first + [(trade_json("A", 2, 5, 1, at_second(2)), at_second(50))]
    again += [(trade_json("A", 9, 5, 1, at_second(9)), at_second(60))]
    facts.refresh_trades_table(raw(spark, first), out)
    facts.refresh_trades_table(raw(spark, again), out)
    stored = {r.trade_id: r.ingest_time for r in tables.read_table(spark, out).collect()}
    assert stored == {1: at_second(1), 2: at_second(2), 3: at_second(3), 4: at_second(4), 9: at_second(60)}
    relation = facts.incremental_trades(facts.fct_trades(raw(spark, first)), raw(spark, again))
    assert {r.trade_id: r.ingest_time for r in relation.collect()} == stored


def test_bars_table_recomputes_only_recent_minutes(spark, out):
    from marketflow.operators.trades import stg_trades

    def trades(*items):
        return stg_trades(raw(spark, [(trade_json("A", i, p, 1, NOON + timedelta(minutes=m)), NOON)
                                      for i, p, m in items]))

    facts.refresh_bars_table(trades((1, 5, 0), (2, 6, 20)), out)
    facts.refresh_bars_table(trades((1, 5, 0), (2, 6, 20), (3, 7, 1), (4, 8, 18), (5, 9, 21)), out)
    stored = tables.read_table(spark, out).orderBy("minute").collect()
    # the trade at minute 1 is older than the newest bar less five minutes
    assert [int(r.close) for r in stored] == [5, 8, 6, 9]


def test_upsert_relation_is_idempotent(spark):
    target, updates = rows(spark, (1, "a", 0), (2, "b", 0)), rows(spark, (2, "B", 0), (3, "c", 0))
    once = merge.upsert(target, updates, ["k"])
    twice = merge.upsert(once, updates, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_seed_only_into_an_empty_table(spark):
    seed = rows(spark, (1, "seed", 0))
    assert merge.seed_if_empty(rows(spark, (9, "x", 0)).filter("false"), seed).count() == 1
    assert [r.v for r in merge.seed_if_empty(rows(spark, (9, "x", 0)), seed).collect()] == ["x"]


def test_incremental_slice_of_an_empty_target_is_everything(spark):
    source = rows(spark, (1, "a", 0), (2, "b", 600))
    empty = source.filter("false")
    assert merge.incremental_slice(source, empty, "ingest_time", "ingest_time").count() == 2
    assert merge.incremental_slice(source, source, "ingest_time", "ingest_time").count() == 1


def test_missing_partitions_and_keys_are_neither_lost_nor_doubled(spark, out):
    schema = "k INT, v STRING, ingest_time TIMESTAMP_NTZ, d DATE"
    day = date(2026, 6, 1)
    made = lambda *items: spark.createDataFrame([(k, v, NOON + timedelta(seconds=s), d) for k, v, s, d in items], schema)
    tables.upsert_table(made((1, "a", 0, day), (2, "b", 0, None), (None, "c", 0, None)), out, ["k"], "d")
    for _ in range(2):
        tables.upsert_table(made((2, "B", 1, None)), out, ["k"], "d")
    assert sorted(r.v for r in tables.read_table(spark, out).collect()) == ["B", "a", "c"]
    for _ in range(3):
        tables.insert_first(made((None, "later", 5, None), (3, "d", 5, None)), out, ["k"], "d")
    assert sorted(r.v for r in tables.read_table(spark, out).collect()) == ["B", "a", "c", "d"]
    tables.insert_first(made((None, "first", -9, None), (4, "f", 1, None)), out, ["k"], "d")
    assert sorted(r.v for r in tables.read_table(spark, out).collect()) == ["B", "a", "d", "f", "first"]


def test_a_rebuild_that_died_while_switching_is_completed(spark, out):
    tables.rebuild(rows(spark, (1, "a", 0)), out)
    rows(spark, (2, "b", 0)).write.parquet(tables._next(out))
    tables._delete(spark, out)
    assert content(spark, out) == [(2, "b")]  # readers see the complete new version
    tables.recover(spark, out)
    assert content(spark, out) == [(2, "b")] and not tables.exists(spark, tables._next(out))
    rows(spark, (3, "half", 0)).write.parquet(tables._next(out))
    tables._delete(spark, tables._next(out) + "/_SUCCESS")
    tables.rebuild(rows(spark, (4, "d", 0)), out)
    assert content(spark, out) == [(4, "d")]


def test_an_empty_publication_is_no_obstacle(spark, out):
    tables.upsert_table(rows(spark, (1, "a", 0)), out, ["k"], "d")
    spark.createDataFrame([], SCHEMA).write.partitionBy("d").parquet(tables._pending(out))
    tables.upsert_table(rows(spark, (2, "b", 0)), out, ["k"], "d")
    assert content(spark, out) == [(1, "a"), (2, "b")]


def test_incremental_builds_read_what_is_new(spark, out, tmp_path):
    first = [(trade_json("A", i, "1", "1", NOON + timedelta(hours=i)), NOON + timedelta(hours=i)) for i in range(30)]
    facts.refresh_trades_table(raw(spark, first), out)
    assert tables.newest(spark, out, "trade_date", "ingest_time") == NOON + timedelta(hours=29)
    source = str(tmp_path / "raw")
    raw(spark, first).write.parquet(source)
    recent = facts._since(spark.read.parquet(source), "ingest_time", out, "trade_date", "ingest_time", 5)
    assert recent.count() == 1 and "GreaterThanOrEqual(ingest_time" in recent._jdf.queryExecution().executedPlan().toString()
