"""Data quality: every check is a query for the violating rows; none means it passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: tolerance for rounding when a mean is compared with its bounds.
TOLERANCE = 1e-6


def violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that break a rule; an undecided condition does not."""
    return df.filter(condition)


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, counted for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def _open_groups(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The keys but ``position`` of groups whose positions are not all different and between 0 and 62."""
    at = F.when(F.col(position).between(0, 62), F.col(position)).cast("int")
    seen = F.bit_or(F.coalesce(F.call_function("shiftleft", F.lit(1).cast("bigint"), at), F.lit(0).cast("bigint")))
    groups = df.groupBy(*(k for k in keys if k != position)).agg(F.count(F.lit(1)).alias("_n"), seen.alias("_seen"))
    return groups.filter(F.col("_n") != F.bit_count("_seen"))


def duplicate_keys(df: DataFrame, keys: list[str], position: str | None = None) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part is left out.

    ``position``: a whole number among the keys that counts up from 0 within the
    others, as a level does within its message. Then one row per group of the others
    is shuffled: a group whose positions below 63 are all different, and which has none
    beyond, holds no key twice; rows of other groups are counted key by key.
    """
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    if position is not None:
        # whether there is such a group is known before any row moves
        some = _open_groups(present, keys, position).agg(F.count(F.lit(1))).scalar() > 0
        present = present.filter(some)
        others = [k for k in keys if k != position]
        open_groups = _open_groups(present, keys, position).select(*(F.col(k).alias(f"_open_{k}") for k in others))
        present = present.join(open_groups, [F.col(k) == F.col(f"_open_{k}") for k in others], "left_semi")
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the accepted ones, with their frequency; NULL is not judged."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def ohlc_broken() -> Column:
    low, high, vwap = _double("low"), _double("high"), _double("vwap")
    return (
        (F.col("high") < F.greatest("low", "open", "close"))
        | (F.col("low") > F.least("open", "close"))
        | (F.least("open", "high", "low", "close") <= 0)
        | (F.col("volume") < 0)
        | (vwap < low - TOLERANCE)
        | (vwap > high + TOLERANCE)
    )


def _outside_book(name: str) -> Column:
    return (_double(name) < _double("best_bid") - TOLERANCE) | (
        _double(name) > _double("best_ask") + TOLERANCE
    )


def book_broken(live: bool = False) -> Column:
    broken = (
        (F.col("best_bid") > F.col("best_ask"))
        | (F.col("spread_bps") < 0)
        | (F.col("imbalance") < 0)
        | (F.col("imbalance") > 1)
        | _outside_book("mid")
    )
    return broken | _outside_book("microprice") if live else broken


def trades_not_positive(with_value: bool = False) -> Column:
    broken = (F.col("price") <= 0) | (F.col("quantity") <= 0) | (F.col("trade_id") <= 0)
    return broken | (F.col("trade_value") <= 0) if with_value else broken


def levels_out_of_range() -> Column:
    return (F.col("price") <= 0) | (F.col("qty") < 0) | (F.col("level") < 0)


def in_future(as_of: Column) -> Column:
    return F.col("traded_at") > as_of


def rsi_out_of_range() -> Column:
    return (F.col("rsi_14") < 0) | (F.col("rsi_14") > 100)


def report(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(check, severity, failures, status) of named checks, one row each."""
    rows = None
    for name, severity, failing in checks:
        one = failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            "failures",
            F.when(F.col("failures") == 0, "pass").otherwise(severity).alias("status"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def row_report(df: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """The same report for row rules of one table: all of them in one pass over it."""
    counted = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.count_if(condition).alias("failures"),
        )
        for name, severity, condition in rules
    ]
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return df.agg(F.array(*counted).alias("_rules")).select(F.inline("_rules")).withColumn("status", status)


def column_rules(
    table: str, required: list[str], accepted: dict[str, list[str]] | None = None, severity: str = "error"
) -> list[tuple[str, str, Column]]:
    """Rules for ``row_report``: columns that may not be NULL, and values that a column may have."""
    present = [(f"{table}: {c} present", severity, F.col(c).isNull()) for c in required]
    known = [
        (f"{table}: {c} accepted", severity, F.col(c).isNotNull() & ~F.col(c).isin(values))
        for c, values in (accepted or {}).items()
    ]
    return present + known


def failing_rows(checks: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """(check, severity, row as JSON) of all violating rows, to be appended to a table of failures."""
    found = None
    for name, severity, failing in checks:
        one = failing.select(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            F.to_json(F.struct("*")).alias("failing_row"),
        )
        found = one if found is None else found.unionByName(one)
    return found


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, maximum, NULL and distinct count of each column, values as text.

    Distinct values are counted as (column, value) pairs, which leave each map
    task once, instead of one copy of every row per column.
    """
    facts = ["min_value", "max_value", "nulls"]

    def measured(c: str) -> Column:
        return F.struct(
            F.lit(c).alias("column_name"),
            F.min(c).cast("string").alias("min_value"),
            F.max(c).cast("string").alias("max_value"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
        )

    one_row = df.agg(F.array(*[measured(c) for c in columns]).alias("facts"))
    extent = one_row.select(F.inline("facts")).select("column_name", *facts)
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns))
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").distinct().groupBy("column_name").agg(F.count("value").alias("distinct_values"))
    return extent.join(distinct, "column_name", "left").withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)))
