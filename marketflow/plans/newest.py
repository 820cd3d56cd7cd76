"""The newest books of every symbol as a small table that live reads look at instead of history.

Which snapshot is newest (greatest id) in a window that ends now depends on the
window. Of a symbol's messages only those matter that no other message beats in
id without being older: its staircase. Where ids grow with time that is one row
per symbol; it stays exact where they do not, for every window that ends at or
after the last message. The table holds these messages with their levels, spread
over buckets of symbols, and a batch or micro-batch rewrites the buckets of the
symbols it brings.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketflow.functions.timecols import at, before, minute_of
from marketflow.operators.book import live_metrics, message_books
from marketflow.operators.depth import depth_messages, explode_levels, unique_messages
from marketflow.session import adaptive
from marketflow.sources.tables import affected, exists, persisted, read_table, recover, replace_partitions

BUCKETS = 16
BUCKET = "symbol_bucket"


def staircase(messages: DataFrame) -> DataFrame:
    """The messages of each symbol that no message received at the same time or later beats in id.

    ``messages``: symbol, last_update_id, ingest_time, each message once. Minutes
    come first: the greatest id of each (one row per symbol and minute leaves a
    task), of which the few stay that exceed all later minutes; only messages of
    those minutes are put in order.
    """
    known = messages.filter("symbol IS NOT NULL AND last_update_id IS NOT NULL AND ingest_time IS NOT NULL")
    known = known.withColumns({"_minute": minute_of(F.col("ingest_time")), "_day": F.to_date("ingest_time")})
    minutes = known.groupBy("symbol", "_day", "_minute").agg(F.max("last_update_id").alias("_top"))
    # days before minutes, so that no task orders a symbol's minutes of all time
    days = minutes.groupBy("symbol", "_day").agg(F.max("_top").alias("_top"))
    open_days = _not_below(days, ["symbol"], "_day", "_top").drop("_top")
    open_minutes = _not_below(minutes.join(open_days, ["symbol", "_day"]), ["symbol", "_day"], "_minute", "_top").drop("_top", "_day")
    rows = known.join(open_minutes, ["symbol", "_minute"])
    return _not_below(rows, ["symbol", "_minute"], "ingest_time", "last_update_id").select(*messages.columns)


def _not_below(df: DataFrame, keys: list[str], time: str, rank: str) -> DataFrame:
    """The rows per ``keys`` whose rank exceeds those of all later rows and ``_above``, a bound from outside; ``_above`` is updated."""
    if "_above" not in df.columns:
        df = df.withColumn("_above", F.lit(None).cast("bigint"))
    later = Window.partitionBy(*keys).orderBy(F.col(time).desc(), F.col(rank).desc()).rowsBetween(Window.unboundedPreceding, -1)
    bound = df.withColumn("_above", F.greatest("_above", F.max(rank).over(later)))
    return bound.filter(F.col("_above").isNull() | (F.col(rank) > F.col("_above")))


def _bucketed(messages: DataFrame) -> DataFrame:
    return messages.withColumn(BUCKET, F.pmod(F.xxhash64("symbol"), F.lit(BUCKETS)).cast("int"))


def _first_copies(messages: DataFrame) -> DataFrame:
    """(symbol, last_update_id, ingest_time) of the first copy of each message, where that copy has levels.

    As ``unique_messages`` picks it, missing sides before empty ones before others, but
    told by one whole number per copy, so that no sides are sorted or shuffled.
    """

    def kind(side: str) -> Column:
        return F.when(F.col(side).isNull(), 0).when(F.size(side) == 0, 1).otherwise(2)

    # Nine kinds of copies a microsecond; a copy without a time comes before all others, and shows no book
    micros, untimed = F.unix_micros(F.col("ingest_time").cast("timestamp")), F.lit(-9 * 10**18)
    rank = F.coalesce(micros * 9 + kind("bids") * 3 + kind("asks"), untimed)
    first = messages.groupBy("symbol", "last_update_id").agg(F.min(rank).alias("_rank"))
    kinds = F.pmod(F.col("_rank"), F.lit(9))
    with_levels = first.filter((F.col("_rank") > untimed) & ((kinds >= 6) | (kinds % 3 == 2)))
    received = F.timestamp_micros(F.expr("(_rank - pmod(_rank, 9)) div 9")).cast("timestamp_ntz")
    return with_levels.select("symbol", "last_update_id", received.alias("ingest_time"))


def update_books(messages: DataFrame, path: str, keep_minutes: int | None = None) -> None:
    """Bring the table up to date with further messages (``depth_messages``; of copies the first counts).

    A message that is already there changes nothing. With ``keep_minutes`` what is
    older than that against the newest message of the bucket's symbols goes.
    """
    spark = messages.sparkSession
    recover(spark, path)
    # a message without levels shows no book; the narrow columns decide which of the others stay
    ids = ["symbol", "last_update_id", "ingest_time"]
    # kept first, so that Spark knows how few they are and the messages need not move to meet them
    with persisted(staircase(_first_copies(messages))) as stays:
        if not stays.count():
            return
        fresh = _bucketed(unique_messages(messages.join(stays, ids, "left_semi")).select(*messages.columns))
        with persisted(fresh):
            _replace_buckets(fresh, path, keep_minutes)


def _replace_buckets(fresh: DataFrame, path: str, keep_minutes: int | None) -> None:
    spark = fresh.sparkSession
    names = [str(row[0]) for row in fresh.select(BUCKET).distinct().collect()]
    if not names:
        return
    if exists(spark, path):
        stored = affected(fresh, path, BUCKET)
        # of a message received twice the stored copy counts
        new = fresh.join(stored.select("symbol", "last_update_id").distinct(), ["symbol", "last_update_id"], "left_anti").select(*fresh.columns)
        both = staircase(stored.unionByName(new))
    else:
        both = fresh
    if keep_minutes is not None:
        both = both.filter(F.col("ingest_time") >= before(fresh.agg(F.max("ingest_time")).scalar(), minutes=keep_minutes))
    replace_partitions(both.select(*fresh.columns), path, BUCKET, names)


def stream_books(raw: DataFrame, path: str, checkpoint: str, delay: str = "15 minutes", **trigger) -> StreamingQuery:
    """Keep the table from a stream of raw depth; repeated messages are held back by keyed state."""
    timed = depth_messages(raw).withColumn("_received", F.col("ingest_time").cast("timestamp"))
    unique = timed.withWatermark("_received", delay).dropDuplicatesWithinWatermark(["symbol", "last_update_id"]).drop("_received")
    # as one column, since Spark does not find what is kept of rows whose partitions it knows by their columns
    whole = unique.select(F.struct(*unique.columns).alias("message"))

    def store(batch: DataFrame, _batch_id: int) -> None:
        # kept and counted, so that the keyed state is gone through whole and once, not by each job
        with adaptive(batch.sparkSession), persisted(batch.select("message.*")) as messages:
            if messages.count():
                update_books(messages, path)

    return (
        whole.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def refresh_books(raw_depth: DataFrame, path: str) -> None:
    """Keep the table from a batch of raw depth."""
    update_books(depth_messages(raw_depth), path)


def newest_messages(spark: SparkSession, path: str, as_of: datetime | Column | None = None, minutes: int | None = None) -> DataFrame:
    """The newest message per symbol, of the window of ``minutes`` up to ``as_of`` if one is given.

    ``as_of`` must not lie before the last message of the table.
    """
    books = read_table(spark, path)
    if as_of is not None:
        books = books.filter((F.col("ingest_time") >= before(as_of, minutes=minutes)) & (F.col("ingest_time") <= at(as_of)))
    # a symbol has few rows here
    newest = Window.partitionBy("symbol").orderBy(F.col("last_update_id").desc())
    return books.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth", BUCKET)


def latest_levels(spark: SparkSession, path: str) -> DataFrame:
    """``book.latest_levels`` from the table."""
    return explode_levels(newest_messages(spark, path))


def orderbook_live(spark: SparkSession, path: str, as_of: datetime | Column, minutes: int = 120) -> DataFrame:
    """``book.orderbook_live`` from the table; a symbol without a message in the window has no row."""
    return live_metrics(message_books(newest_messages(spark, path, as_of, minutes)))
