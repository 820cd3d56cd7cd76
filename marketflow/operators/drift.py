"""Schema drift of raw messages against a baseline of known keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.functions.timecols import at, before

# The keys of both message kinds that staging maps or ignores on purpose.
KNOWN_KEYS = {
    "RAW_TRADES": ["e", "E", "s", "t", "p", "q", "T", "m", "M"],
    "RAW_DEPTH": ["lastUpdateId", "bids", "asks"],
}

# Type names of the report by the start of Spark's type name.
TYPE_NAMES = {
    "BIGINT": "INTEGER",
    "STRING": "VARCHAR",
    "DECIMAL": "DECIMAL",
    "DOUBLE": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "ARRAY": "ARRAY",
    "OBJECT": "OBJECT",
    "VOID": "NULL_VALUE",
}


def known_keys(spark: SparkSession) -> DataFrame:
    rows = [(table, key) for table, keys in KNOWN_KEYS.items() for key in keys]
    return spark.createDataFrame(rows, "source_table STRING, key_name STRING")


def value_type(value: Column) -> Column:
    name = F.schema_of_variant(value)
    kind = F.lit(None).cast("string")
    for prefix, shown in TYPE_NAMES.items():
        kind = F.when(name.startswith(prefix), shown).otherwise(kind)
    return F.coalesce(kind, name)


def flatten_keys(raw: DataFrame, *keep: str) -> DataFrame:
    """One row per key of each record's data object, with the receipt time and the columns ``keep``."""
    kept = "".join(f", r.`{c}`" for c in keep)
    return raw.sparkSession.sql(
        f"""
        SELECT r.ingest_time{kept}, kv.key AS key_name, kv.value AS value
        FROM {{raw}} r, LATERAL variant_explode(try_variant_get(r.record, '$.data', 'variant')) kv
        """,
        raw=raw,
    )


def key_profile(
    raw: DataFrame, source_table: str, as_of: datetime | Column | None = None, hours: int = 24
) -> DataFrame:
    """Occurrences per (key, type) in the last hours, or overall without ``as_of``."""
    if as_of is not None:
        received = F.col("ingest_time")
        raw = raw.filter((received >= before(as_of, hours=hours)) & (received <= at(as_of)))
    return (
        flatten_keys(raw)
        .groupBy("key_name", value_type(F.col("value")).alias("value_type"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .select(F.lit(source_table).alias("source_table"), "key_name", "value_type", "occurrences")
    )


def new_keys(profiles: DataFrame, baseline: DataFrame) -> DataFrame:
    """Profile rows whose key the baseline lacks. Counting comes first, so the join is small."""
    known = baseline.filter(F.col("key_name").isNotNull())
    return profiles.join(known, ["source_table", "key_name"], "left_anti").select(
        "source_table", F.col("key_name").alias("new_key"), "value_type", "occurrences"
    )


def drift_log(drift: DataFrame) -> DataFrame:
    """(metric, value, status) per drifting key."""
    label = F.concat(
        F.lit("schema_drift:"), "source_table", F.lit(":"), "new_key", F.lit(" ("), "value_type", F.lit(")")
    )
    return drift.select(
        label.alias("metric"), F.col("occurrences").alias("value"), F.lit("DRIFT").alias("status")
    )


def drift_report(profiles: DataFrame, typed_baseline: DataFrame) -> DataFrame:
    """NEW, TYPE CHANGED and MISSING keys against a baseline with types."""
    keys = ["source_table", "key_name"]
    expected = typed_baseline.select(*keys, F.col("value_type").alias("expected_type"))
    joined = profiles.join(expected, keys, "full_outer")
    finding = (
        F.when(F.col("expected_type").isNull(), "NEW")
        .when(F.col("value_type").isNull(), "MISSING")
        .when(F.col("value_type") != F.col("expected_type"), "TYPE CHANGED")
    )
    return (
        joined.withColumn("finding", finding)
        .filter(F.col("finding").isNotNull())
        .select(*keys, "finding", "expected_type", "value_type", "occurrences")
    )
