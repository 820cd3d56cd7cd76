"""Blocked series against plain loops, with one symbol that holds most rows."""

import math
import random
from datetime import timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import NOON
from marketflow.operators import correlation, flow, metrics, rsi, series
from marketflow.operators.percentile import percentile_cont

SCHEMA = "symbol STRING, minute TIMESTAMP_NTZ, close DECIMAL(38,8), volume DECIMAL(38,8)"


@pytest.fixture(scope="module")
def walks():
    rng, rows = random.Random(7), {}
    for symbol, n in (("HOT", 900), ("MID", 140), ("LOW", 15), ("ONE", 1)):
        price, at, rows[symbol] = 100.0, NOON, []
        for i in range(n):
            # gaps between bars, and a long flat stretch in the middle
            at += timedelta(minutes=rng.choice([1, 1, 1, 2, 90]))
            if not 300 < i < 420:
                price = max(1.0, price + rng.choice([-1.25, -0.5, 0, 0.25, 0.75, 1.0]))
            rows[symbol].append((symbol, at, Decimal(f"{price:.2f}"), Decimal(rng.randint(1, 50))))
    return rows


@pytest.fixture(scope="module")
def frame(spark, walks):
    flat = [row for rows in walks.values() for row in rows]
    random.Random(1).shuffle(flat)
    return spark.createDataFrame(flat, SCHEMA).repartition(5)


def naive_rsi(rows, n=14):
    closes = [float(r[2]) for r in rows]
    changes = [b - a for a, b in zip(closes, closes[1:])]
    out = [None] * min(n, len(closes))
    if len(changes) < n:
        return out[: len(closes)]
    gain = sum(max(c, 0) for c in changes[:n]) / n
    loss = sum(max(-c, 0) for c in changes[:n]) / n
    steps = [None] + changes[n:]
    for change in steps:
        if change is not None:
            gain, loss = (gain * (n - 1) + max(change, 0)) / n, (loss * (n - 1) + max(-change, 0)) / n
        out.append(50 if gain == loss == 0 else 100 if loss == 0 else 100 - 100 / (1 + gain / loss))
    return out


@pytest.mark.parametrize("block_rows", [32, 100, 2048])
def test_rsi_equals_the_plain_recursion(frame, walks, block_rows):
    got = {}
    for r in rsi.rsi_wilder(frame, block_rows=block_rows).orderBy("rn").collect():
        got.setdefault(r.symbol, []).append(r.rsi_14)
    for symbol, rows in walks.items():
        for have, want in zip(got[symbol], naive_rsi(rows), strict=True):
            assert (have is None) == (want is None)
            assert want is None or float(have) == pytest.approx(want, abs=2e-8)


def test_long_series_keeps_the_averages_of_early_blocks(spark):
    closes = [100, 101] * 8 + [100] * 400
    rows = [("A", NOON + timedelta(minutes=i), Decimal(c), Decimal(1)) for i, c in enumerate(closes)]
    index = rsi.rsi_wilder(spark.createDataFrame(rows, SCHEMA), block_rows=20).orderBy("rn").collect()
    for have, want in zip(index, naive_rsi(rows), strict=True):
        assert want is None or float(have.rsi_14) == pytest.approx(want, abs=2e-8)


def test_numbering_is_row_number(frame, walks):
    got = {(r.symbol, r.minute): r.rn for r in series.numbered(frame).collect()}
    assert len(got) == sum(map(len, walks.values()))
    for symbol, rows in walks.items():
        for i, row in enumerate(rows, 1):
            assert got[symbol, row[1]] == i


def test_blocks_give_what_one_window_per_symbol_gives(frame):
    blocked = metrics.market_metrics(frame, block_rows=64).collect()
    whole = metrics.market_metrics(frame).collect()

    left = sorted((tuple(r) for r in blocked), key=lambda row: row[:2])
    right = sorted((tuple(r) for r in whole), key=lambda row: row[:2])
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            if isinstance(x, Decimal) and isinstance(y, Decimal):
                assert float(x) == pytest.approx(float(y), abs=2e-8)
            else:
                assert x == y


def test_rolling_statistics_against_numpy(frame, walks):
    got = {(r.symbol, r.minute): r for r in metrics.rolling_volume(frame, block_rows=32).collect()}
    for symbol, rows in walks.items():
        volume = [float(r[3]) for r in rows]
        for i, row in enumerate(rows):
            window = volume[max(0, i - 29): i + 1]
            have = got[symbol, row[1]]
            assert have.volume_avg_30 == pytest.approx(np.mean(window))
            if len(window) > 1:
                assert have.volume_std_30 == pytest.approx(np.std(window, ddof=1))
            else:
                assert have.volume_std_30 is None


def test_cumulative_delta_is_a_running_sum(frame, walks):
    deltas = frame.select(
        "symbol", "minute", F.lit(0).alias("taker_buy"), F.lit(0).alias("taker_sell"),
        (F.col("close").cast("decimal(18,8)") - 100).cast("decimal(38,8)").alias("delta"),
    )
    got = {(r.symbol, r.minute): r.cvd for r in flow.cumulative_delta(deltas).collect()}
    for symbol, rows in walks.items():
        total = Decimal(0)
        for row in rows:
            total += row[2] - 100
            assert got[symbol, row[1]] == total


def test_halo_must_fit(frame):
    with pytest.raises(ValueError):
        series.in_blocks(series.numbered(frame), block_rows=8)


def test_correlation_against_pandas(spark, frame):
    performance = metrics.cross_performance(frame)
    got = {(r.symbol_a, r.symbol_b): r for r in correlation.return_correlation(performance).collect()}
    table = performance.toPandas().pivot(index="minute", columns="symbol", values="perf_100")
    returns = np.log(table / table.shift(1))
    want = returns.corr().round(2)
    for (a, b), row in got.items():
        common = int((returns[a].notna() & returns[b].notna()).sum())
        assert row.common == common
        if common > 1 and not math.isnan(want.loc[a, b]):
            assert row.correlation == pytest.approx(want.loc[a, b], abs=0.0101)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.95, 1.0])
def test_percentile_against_numpy(spark, share):
    rng = random.Random(3)
    rows = [("hot", rng.choice([5, 5, 5, 900, 1500, 7000, -20])) for _ in range(2000)]
    rows += [("few", v) for v in (3, 1000, 2000)] + [("one", 42), ("hot", None)]
    got = percentile_cont(
        spark.createDataFrame(rows, "k STRING, v INT").repartition(6), ["k"], "v", share, "p"
    ).collect()
    for row in got:
        values = [v for k, v in rows if k == row.k and v is not None]
        assert row.p == pytest.approx(np.percentile(values, share * 100))
    assert len(got) == 3
