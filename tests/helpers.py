"""Small inputs for the tests."""

import json
from datetime import datetime, timedelta
from decimal import Decimal

NOON = datetime(2026, 6, 10, 12)


def trade_json(symbol, trade_id, price, qty, at=NOON, maker=False, **extra):
    ms = int((at - datetime(1970, 1, 1)).total_seconds() * 1000)
    data = {"e": "trade", "E": ms, "s": symbol, "t": trade_id, "p": str(price), "q": str(qty)}
    data |= {"T": ms, "m": maker, "M": True} | extra
    return json.dumps({"stream": f"{symbol.lower()}@trade", "data": data})


def depth_json(symbol, update_id, bids, asks):
    data = {"lastUpdateId": update_id, "bids": bids, "asks": asks}
    return json.dumps({"stream": f"{symbol.lower()}@depth20@1000ms", "data": data})


def messages(spark, rows):
    return spark.createDataFrame(rows, "value STRING, ingest_time TIMESTAMP_NTZ")


def raw(spark, rows):
    from marketflow.sources.messages import parse

    return parse(messages(spark, rows))


def bars(spark, closes, symbol="BTCUSDT", volume=10, start=NOON):
    rows = [
        (symbol, start + timedelta(minutes=i), Decimal(str(c)), Decimal(str(volume)))
        for i, c in enumerate(closes)
    ]
    return spark.createDataFrame(
        rows, "symbol STRING, minute TIMESTAMP_NTZ, close DECIMAL(38,8), volume DECIMAL(38,8)"
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")
