"""Raw messages: JSON text with the receipt time of each message.

The input of every function is a relation with the columns ``value STRING`` and
``ingest_time TIMESTAMP_NTZ``. The receipt time travels with the message; it is
never the time of the batch that happens to process it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "value STRING, ingest_time TIMESTAMP_NTZ"


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bounded scan of stored messages."""
    return spark.read.format(fmt).schema(MESSAGE_SCHEMA).load(path)


def read_text_messages(spark: SparkSession, path: str) -> DataFrame:
    """Bounded scan of JSON lines; the file time stands in for the receipt time."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("ingest_time"),
    )


def parse(messages: DataFrame) -> DataFrame:
    """``record VARIANT`` from the text; NULL where the text is not JSON."""
    return messages.select(F.try_parse_json("value").alias("record"), "ingest_time")


def path(name: str, data_type: str, root: str = "record") -> Column:
    """Typed value at a JSON path; NULL where it is missing or of another type."""
    return F.try_variant_get(F.col(root), f"$.{name}", data_type)


def route(messages: DataFrame) -> DataFrame:
    """Add ``record`` and ``route``: trades, depth, unknown, or malformed for text that is not JSON.

    The record is parsed inside a generator. A filter on the route stays above
    it, so that each text is parsed once; below it, Spark would parse the text
    again for every use in the condition.
    """
    parsed = messages.select("*", F.explode(F.array(F.try_parse_json("value"))).alias("record"))
    stream = F.coalesce(path("stream", "string"), F.lit(""))
    return parsed.select(
        *messages.columns,
        "record",
        F.when(F.col("record").isNull(), "malformed")
        .when(stream.endswith("@trade"), "trades")
        .when(stream.contains("@depth"), "depth")
        .otherwise("unknown")
        .alias("route"),
    )


def raw_table(messages: DataFrame, target: str) -> DataFrame:
    """The rows that one raw table (``trades`` or ``depth``) receives."""
    return route(messages).filter(F.col("route") == target).select("record", "ingest_time")


def ingest_counters(messages: DataFrame) -> DataFrame:
    """How many messages arrived, were routed to a table, were ignored or failed to parse."""
    kind = F.col("route")
    return route(messages).agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(kind.isin("trades", "depth")).alias("accepted"),
        F.count_if(kind == "unknown").alias("ignored"),
        F.count_if(kind == "malformed").alias("failed"),
    )


def append_message(raw: DataFrame, text: str, ingest_time) -> DataFrame:
    """``raw`` plus one message given as JSON text."""
    one = raw.sparkSession.sql(
        "SELECT parse_json(:text) AS record, CAST(:at AS TIMESTAMP_NTZ) AS ingest_time",
        args={"text": text, "at": str(ingest_time)},
    )
    return raw.unionByName(one)


def delete_where(raw: DataFrame, condition: Column) -> DataFrame:
    """``raw`` without the rows that meet the condition; an undecided row stays."""
    return raw.filter(~F.coalesce(condition, F.lit(False)))


def read_dim_symbols(spark: SparkSession, csv_path: str) -> DataFrame:
    """The symbol dimension: a CSV file with a header."""
    schema = "symbol STRING, base_asset STRING, quote_asset STRING, display_name STRING"
    return spark.read.schema(schema).csv(csv_path, header=True)
