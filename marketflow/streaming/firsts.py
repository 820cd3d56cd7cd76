"""The first received copy of each trade, kept by state that expires with the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from marketflow.operators.trades import flatten_trades

# Fixed value: what decides between copies, as in the batch dedup.
ORDER = ["ingest_time", "traded_at", "event_time", "price", "quantity", "is_buyer_market_maker"]


def first_trades(raw: DataFrame, delay: str = "15 minutes", span_seconds: int = 60) -> DataFrame:
    """Trades of a stream of raw rows, each as its first received copy, with ``corrects``.

    Inside a micro-batch the copy of earliest receipt stays. A copy in a later
    batch is dropped, unless it was received before the one that was passed on:
    then it is passed on too, with ``corrects`` true, for a sink that keeps the
    earlier of two (``insert_first``). State is one list of ids and receipts per
    symbol and ``span_seconds`` of trade time, so a busy symbol is spread over
    its spans; it goes when the watermark passes the span. Later trades of that
    span are late and dropped, as are rows without a trade time.

    Needs the RocksDB state store provider in the session of the query.
    """
    # defined here so that executors need no copy of this package
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    order = list(ORDER)

    class First(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.seen = handle.getValueState("seen", "ids array<string>, at array<bigint>")

        def handleInputRows(self, key, rows, timerValues):
            batch = pd.concat(list(rows), ignore_index=True)
            copies = batch["id_text"].duplicated(keep=False)
            if copies.any():
                # missing values come first, as in Spark's order
                ranked = sorted(range(len(batch)), key=lambda i: [(not pd.isna(v), None if pd.isna(v) else v) for v in batch.loc[i, order]])
                batch = batch.loc[ranked].drop_duplicates("id_text")
            at = batch["ingest_time"].astype("datetime64[us]").astype("int64")
            old = dict(zip(*self.seen.get())) if self.seen.exists() else {}
            before = batch["id_text"].map(old)
            new = before.isna()
            earlier = ~new & (at < before)
            for name, when in zip(batch["id_text"], at):
                old[name] = min(int(when), old.get(name, int(when)))
            self.seen.update((list(old), list(old.values())))
            end = (int(key[1]) + 1) * span_seconds * 1000
            if end > timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(end)
            out = batch[new | earlier].copy()
            out["corrects"] = earlier[new | earlier].astype(bool)
            if len(out):
                yield out[names]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.seen.clear()
            return iter(())

        def close(self) -> None:
            pass

    flat = flatten_trades(raw)
    timed = flat.withColumn("event_at", F.col("traded_at").cast("timestamp")).withWatermark("event_at", delay)
    # an id stays exact as text, also beside missing ones (the state functions rename columns that begin with an underscore)
    keyed = timed.withColumn("id_text", F.col("trade_id").cast("string")).drop("trade_id")
    keyed = keyed.withColumns({"id_text": F.coalesce("id_text", F.lit("")), "span": F.floor(F.unix_seconds("event_at") / span_seconds)})
    fields = [f for f in keyed.drop("event_at", "span").schema.fields if f.name != "id_text"]
    schema = StructType([*fields, StructField("id_text", StringType()), StructField("corrects", BooleanType())])
    names = schema.names
    found = keyed.groupBy("symbol", "span").transformWithStateInPandas(
        statefulProcessor=First(), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    trade_id = F.nullif(F.col("id_text"), F.lit("")).cast("bigint").alias("trade_id")
    return found.select(*(trade_id if c == "trade_id" else F.col(c) for c in flat.columns), "corrects")
