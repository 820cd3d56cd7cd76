"""Market inputs derived from the given tables (formulas in FIXTURES.md, section 3)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketflow.functions.timecols import from_millis
from marketflow.operators.depth import SIDE_ARRAY
from marketflow.plans import facts, newest, summaries
from marketflow.session import work_dir
from marketflow.sources.messages import path, raw_table
from marketflow.sources.tables import read_table

LEVELS_PER_MESSAGE = 20
SECOND = 1000
# Splits the order dates for builds in two steps.
BOOK_CUT = datetime(1996, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores when it lies in fewer splits, as a single small file does.

    Large inputs have more splits than cores and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if splits < cores else df


def trade_text(
    suffix: str, symbol: Column, trade_id: Column, ms: Column, price: Column, qty: Column, maker: Column, unknown: Column
) -> Column:
    """A trade message as JSON text; ``unknown`` is a key that no baseline has."""
    data = {"e": F.lit("trade"), "E": ms, "s": F.upper(symbol), "t": trade_id, "p": price, "q": qty, "T": ms, "m": maker, "M": F.lit(True), "xs": unknown}
    return F.to_json(
        F.struct(
            F.concat(F.lower(symbol), F.lit(suffix)).alias("stream"),
            F.struct(*(value.alias(key) for key, value in data.items())).alias("data"),
        )
    )


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade messages as JSON text: originals, repeats, malformed text, other streams."""
    events = spread(table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k").cast("int")
    ev = events.select(
        "event_id",
        "event_type",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.col("value").cast("decimal(18,2)").cast("decimal(18,8)").cast("string").alias("price"),
        (((k + 1).cast("decimal(18,8)")) / 10).cast("decimal(18,8)").cast("string").alias("qty"),
        (F.col("user_id") % 2 == 0).alias("maker"),
    )
    eid = F.col("event_id")

    def text(suffix: str) -> Column:
        unknown = F.when(eid % 500 == 3, F.lit(0.42).cast("decimal(3,2)"))
        return trade_text(suffix, F.col("event_type"), eid, F.col("ms"), F.col("price"), F.col("qty"), F.col("maker"), unknown)

    received = F.col("ms") + 50 + eid % 200 + F.when(eid % 50 == 7, 600 * SECOND).otherwise(0)

    def message(value: Column, ms: Column) -> Column:
        return F.struct(value.alias("value"), from_millis(ms).alias("ingest_time"))

    several = F.array(
        message(text("@trade"), received),
        F.when(eid % 10 == 0, message(text("@trade"), received + SECOND)),
        F.when(eid % 97 == 0, message(F.lit("{bad"), received)),
        F.when(eid % 89 == 0, message(text("@kline_1m"), received)),
    )
    return ev.select(F.explode(several).alias("m")).filter("m is not null").select("m.*")


def clock_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trade message of a symbol of its own, a day after the last event: an idle feed's clock."""
    ms = F.unix_millis(F.max(F.col("ts").cast("timestamp"))) + 86_400 * SECOND
    last = table(spark, sf_dir, "events").agg(ms.alias("ms"))
    lit = F.lit
    text = trade_text("@trade", lit("clock"), lit(0), F.col("ms"), lit("1"), lit("1"), lit(False), lit(None).cast("decimal(3,2)"))
    return last.select(text.alias("value"), from_millis(F.col("ms")).alias("ingest_time"))


def depth_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth messages as JSON text, at most twenty levels a side; some messages repeat.

    An order with more lines goes on in further messages with their own ids.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    in_order = Window.partitionBy("o_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    numbered = orders.join(lines, "o_orderkey", "left").withColumn(
        "pos", F.row_number().over(in_order) - 1
    )
    # the columns of a level stay numbers until all levels of a message are together
    line = F.struct("pos", "o_custkey", "l_partkey", "l_quantity")
    page = F.floor(F.col("pos") / LEVELS_PER_MESSAGE)
    messages = (
        numbered.groupBy("o_orderkey", "o_orderdate", "o_orderpriority", page.alias("page"))
        .agg(F.sort_array(F.collect_list(F.when(F.col("l_partkey").isNotNull(), line))).alias("lines"))
    )

    def level_price(at: Column, sign: int) -> Column:
        base = F.lit(100).cast("decimal(18,2)") + (at["o_custkey"] % 50).cast("decimal(18,2)")
        step = (at["pos"] % LEVELS_PER_MESSAGE + 1).cast("decimal(18,2)") / 100
        return (base + step if sign > 0 else base - step).cast("decimal(18,2)").cast("string")

    def side(sign: int, qty) -> Column:
        return F.transform("lines", lambda at: F.array(level_price(at, sign), qty(at).cast("bigint").cast("string")))

    okey = F.col("o_orderkey")
    value = F.to_json(
        F.struct(
            F.concat(
                F.lit("pri"), F.left(F.col("o_orderpriority"), F.lit(1)), F.lit("@depth20@1000ms")
            ).alias("stream"),
            F.struct(
                (okey + F.col("page") * 1_000_000_000_000).alias("lastUpdateId"),
                side(-1, lambda at: at["l_quantity"]).alias("bids"),
                side(1, lambda at: at["l_partkey"] % 50 + 1).alias("asks"),
            ).alias("data"),
        )
    )
    received = F.unix_millis(F.col("o_orderdate").cast("timestamp")) + okey % 86400 * SECOND
    copies = F.when(okey % 20 == 0, F.array(received, received + SECOND)).otherwise(F.array(received))
    return messages.select(value.alias("value"), F.explode(copies).alias("ms")).select(
        "value", from_millis(F.col("ms")).alias("ingest_time")
    )


class Warehouse:
    """Tables that a running feed maintains, built once per session and data set, each when it is first asked for.

    Raw messages lie by day (trades) or month (depth, which spans years) of
    receipt, as the raw sink writes them. The facts come from two builds with a
    cut between them, and so do the summaries and the newest books.
    """

    UNIT = {"trades": "day", "depth": "month"}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.paths = spark, sf_dir, {}

    def path(self, name: str, build) -> str:
        if name not in self.paths:
            path = work_dir(self.spark, name, keep=True)
            build(path)
            self.paths[name] = path
        return self.paths[name]

    def raw_path(self, target: str) -> str:
        def build(path: str) -> None:
            made = {"trades": trade_messages, "depth": depth_messages}[target](self.spark, self.sf_dir)
            dated = raw_table(made, target).withColumn("ingest_date", F.to_date(F.date_trunc(self.UNIT[target], "ingest_time")))
            dated.hint("rebalance", "ingest_date").write.partitionBy("ingest_date").parquet(path)

        return self.path(f"raw_{target}", build)

    def raw(self, target: str) -> DataFrame:
        """The raw table with its partition column."""
        schema = "record VARIANT, ingest_time TIMESTAMP_NTZ, ingest_date DATE"
        return self.spark.read.schema(schema).parquet(self.raw_path(target))

    def fact_path(self, name: str) -> str:
        def build(path: str) -> None:
            if name == "fct_trades":
                facts.refresh_trades_table(self.raw("trades"), path)
            elif name == "fct_depth_snapshots":
                facts.refresh_depth_table(self.raw("depth"), path)
            else:
                facts.refresh_bars_table(self.fact("fct_trades"), path)

        return self.path(name, build)

    def fact(self, name: str) -> DataFrame:
        return read_table(self.spark, self.fact_path(name))

    def build(self) -> None:
        """Build what is not there yet, but for summaries."""
        for name in ("fct_trades", "fct_ohlcv_1min", "fct_depth_snapshots"):
            self.fact_path(name)
        self.books_path()

    def books_path(self) -> str:
        """Newest books, from the older and then the younger half of the depth messages by receipt."""

        def build(path: str) -> None:
            raw = self.raw("depth")
            middle = F.lit(BOOK_CUT).cast("timestamp_ntz")
            newest.refresh_books(raw.filter(F.col("ingest_time") < middle), path)
            newest.refresh_books(raw.filter(F.col("ingest_time") >= middle), path)

        return self.path("newest_books", build)

    def summary(self, name: str, source: str, partition: str, summarise) -> DataFrame:
        """A summary of a maintained table, refreshed twice: what did not change is not read again."""

        def build(path: str) -> None:
            summaries.refresh(self.spark, source, path, partition, summarise)
            again = summaries.refresh(self.spark, source, path, partition, summarise)
            if again:
                raise AssertionError(f"{name}: unchanged partitions were read again: {again}")

        return read_table(self.spark, self.path(name, build))


_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, sf_dir)
    return _warehouses[key]


def level_count() -> Column:
    """Levels of a raw depth message."""
    sides = [F.size(path(f"data.{side}", SIDE_ARRAY)) for side in ("bids", "asks")]
    return F.coalesce(sides[0], F.lit(0)) + F.coalesce(sides[1], F.lit(0))


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).raw("trades").drop("ingest_date")


def raw_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse(spark, sf_dir).raw("depth").drop("ingest_date")


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per received message; a message counts as written where k < 50."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("recv_at"),
        F.when(k < 50, F.col("ts")).alias("write_at"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"),
        F.when(F.col("value") > 100, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"),
    )


def dim_symbols(trades: DataFrame) -> DataFrame:
    """A symbol dimension for the symbols that occur."""
    symbol = F.col("symbol")
    return trades.select("symbol").distinct().select(
        "symbol",
        F.left(symbol, F.lit(3)).alias("base_asset"),
        F.lit("USDT").alias("quote_asset"),
        F.initcap(symbol).alias("display_name"),
    )


def arrival_files(messages: DataFrame, name: str, cuts: list[datetime]) -> str:
    """Messages as files in the order of arrival, one span between two cuts after the other.

    They are made once, and the spans are cut out of what was written.
    """
    spark = messages.sparkSession
    path, made = work_dir(spark, name), work_dir(spark, f"{name}_made")
    messages.write.parquet(made)
    messages = spark.read.schema(messages.schema).parquet(made)
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:]):
        part = messages
        if low is not None:
            part = part.filter(F.col("ingest_time") >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            part = part.filter(F.col("ingest_time") < F.lit(high).cast("timestamp_ntz"))
        part.write.mode("append").parquet(path)
    return path
