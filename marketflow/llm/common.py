"""What several operators share: stored intermediate tables, sizes, ASCII words."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder all executors share and read back.

    The lineage ends there: a lost executor costs the tasks it ran, not the
    steps before them, and several readers cost one computation.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> tuple[int, int]:
    """Bytes of all texts, and rows."""
    row = df.agg(F.sum(F.octet_length(text)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    return int(row["b"] or 0), int(row["n"])


def parts(total: float, each: float) -> int:
    """How many parts of ``each`` hold ``total``; one at least."""
    return max(1, math.ceil(total / each))


def crc_of_id(column: str):
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string"))
