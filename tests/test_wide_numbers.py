"""Prices and quantities beyond DECIMAL(18,8) keep their values."""

import random
from decimal import Decimal, ROUND_HALF_UP, getcontext

import pytest
from pyspark.sql import functions as F

from marketflow.functions.numbers import long_quotient, product, quotient
from marketflow.operators.bars import ohlcv
from marketflow.operators.book import message_snapshots, orderbook_live, orderbook_snapshots
from marketflow.operators.depth import depth_messages, enrich_levels, unique_depth_levels
from marketflow.operators.flow import cumulative_delta, taker_flow
from marketflow.operators.trades import enrich_trades, stg_trades
from marketflow.sources import messages

getcontext().prec = 80
LARGE = ["12000000000", "100000000000000000000", "12345678901234567890.12345678"]


def raw(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return df.select("value", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:05'").alias("ingest_time"))


@pytest.mark.parametrize("quantity", LARGE)
def test_trades_and_bars(spark, quantity):
    text = '{{"stream":"x@trade","data":{{"t":{},"p":"{}","q":"{}","T":1704067200000,"E":1704067200000,"m":{}}}}}'
    rows = raw(spark, [text.format(1, "0.00001234", quantity, "true"), text.format(2, "2.5", "3", "false")])
    trades = enrich_trades(stg_trades(messages.raw_table(rows, "trades"))).cache()
    got = {r.trade_id: r for r in trades.collect()}
    assert got[1].quantity == Decimal(quantity)
    value = (Decimal("0.00001234") * Decimal(quantity)).quantize(Decimal("1e-8"), ROUND_HALF_UP)
    assert got[1].trade_value == value and got[2].trade_value == Decimal("7.5")
    bar = ohlcv(trades).first()
    assert bar.trade_count == 2 and bar.volume == Decimal(quantity) + 3 and bar.quote_volume == value + Decimal("7.5")
    assert abs(float(bar.vwap) - float(bar.quote_volume) / float(bar.volume)) < 1e-7
    flow = cumulative_delta(taker_flow(trades)).first()
    assert flow.delta == 3 - Decimal(quantity) == flow.cvd


@pytest.mark.parametrize("quantity", LARGE)
def test_books(spark, quantity):
    text = '{{"stream":"x@depth20@1000ms","data":{{"lastUpdateId":1,"bids":[["1.5","{0}"],["1.4","1"]],"asks":[["1.7","2"]]}}}}'
    stored = messages.raw_table(raw(spark, [text.format(quantity)]), "depth")
    levels = unique_depth_levels(stored)
    assert enrich_levels(levels).agg(F.max("notional")).first()[0] == (Decimal("1.5") * Decimal(quantity)).quantize(Decimal("1e-8"), ROUND_HALF_UP)
    for books in (orderbook_snapshots(levels), message_snapshots(depth_messages(stored))):
        assert books.first().mid == Decimal("1.6") and books.first().imbalance is not None
    book = orderbook_live(levels, F.expr("TIMESTAMP_NTZ '2024-01-01 00:01:00'")).first()
    assert book.bid_vol == Decimal(quantity) + 1 and book.microprice is not None


def test_products_round_alike_at_every_size(spark):
    pairs = [("1.5", "0.00000001"), ("0.00000005", "0.1"), ("-2.5", "0.00000001"), ("12345678901234567890.00000005", "0.5"), ("99999999999.99999999", "99999999999.99999999"), ("-12345678901234567890.12345678", "7.00000003")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in pairs], "a decimal(38,8), b decimal(38,8)")
    got = [r[0] for r in df.select(product(F.col("a"), F.col("b"))).collect()]
    assert got == [(Decimal(a) * Decimal(b)).quantize(Decimal("1e-8"), ROUND_HALF_UP) for a, b in pairs]


def paper(a, b, scale=1):
    return (scale * Decimal(a) / Decimal(b)).quantize(Decimal("1e-8"), ROUND_HALF_UP) if Decimal(b) else None


@pytest.mark.parametrize("scale", [1, 100, 20_000])
def test_quotients_round_alike_at_every_size(spark, scale):
    """Halves included, on both sides of 10^10, at which the operands stop fitting the short form."""
    rng = random.Random(7)
    pairs = [("0.00000005", "10"), ("9999999999.5", "1000000000"), ("10000000000.5", "1000000000"), ("100000000005", "10000000000000000000"), ("-100000000005", "10000000000000000000")]
    pairs += [("1", "3"), ("12345678901234567890123456789", "7.5"), ("2", "99999999999.99999999"), ("5", "0"), ("0", "12345678901"), ("-3", "-123456789012345.00000001")]
    for _ in range(200):
        size = lambda: Decimal(rng.randint(1, 10 ** rng.randint(1, 30))).scaleb(-8) * rng.choice([1, -1])
        a, b = size(), size()
        if abs(a / b) * scale < Decimal(10) ** 27:
            pairs.append((str(a), str(b)))
    # exact halves: q + 1/2 eighth decimals times b
    for e in range(2, 16):
        b = Decimal(2 * 10**e)
        pairs.append((str((Decimal(rng.randint(1, 10**9)) + Decimal("0.5")).scaleb(-8) * b / scale), str(b)))
    # a numerator with further decimals was no published number
    pairs = [(a, b) for a, b in pairs if Decimal(a) == Decimal(a).quantize(Decimal("1e-8"))]
    # a published result has room below 10^29
    pairs = [(a, b) for a, b in pairs if not Decimal(b) or abs(scale * Decimal(a) / Decimal(b)) < Decimal(10) ** 29]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in pairs], "a decimal(38,8), b decimal(38,8)")
    both = df.select(quotient(F.col("a"), F.col("b"), scale=scale), long_quotient(F.col("a"), F.col("b"), scale)).collect()
    assert [r[1] for r in both] == [paper(a, b, scale) for a, b in pairs]
    assert [r[0] for r in both] == [paper(a, b, scale) for a, b in pairs]
