"""RSI over a stream of closed bars: four numbers of state per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.functions.numbers import published
from marketflow.streaming.bars import closed_bars

OUTPUT = "symbol string, minute timestamp_ntz, rn bigint, avg_gain double, avg_loss double, rsi_14 double"
STATE = "rn bigint, close double, gain double, loss double"


def stream_rsi_of_trades(raw: DataFrame, delay: str = "15 minutes", width: str = "1 minute", n: int = 14) -> DataFrame:
    """Index of each bar as it closes, straight from raw trades: dedup, bars and index are stateful steps of one query.

    For append mode; a bar comes out when the watermark has passed its end.
    """
    return stream_rsi(closed_bars(raw, delay, width), n)


def stream_rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    """Index per closed bar. Bars of a symbol must arrive in order across batches.

    Needs the RocksDB state store provider in the session of the query.
    """
    # defined here so that executors need no copy of this package
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Wilder(StatefulProcessor):
        def init(self, handle) -> None:
            self.state = handle.getValueState("wilder", STATE)

        def handleInputRows(self, key, rows, timerValues):
            batch = pd.concat(list(rows)).sort_values("minute")
            rn, close, gain, loss = self.state.get() if self.state.exists() else (0, 0.0, 0.0, 0.0)
            out = []
            for minute, price in zip(batch["minute"], batch["close"].astype("float64")):
                rn += 1
                change = price - close if rn > 1 else 0.0
                up, down, close = max(change, 0.0), max(-change, 0.0), price
                # the first n changes are averaged plainly, later ones smoothed
                if rn <= n + 1:
                    gain, loss = gain + up / n, loss + down / n
                else:
                    gain, loss = (gain * (n - 1) + up) / n, (loss * (n - 1) + down) / n
                ready = rn > n
                if not ready:
                    index = None
                elif loss == 0:
                    index = 50.0 if gain == 0 else 100.0
                else:
                    index = 100 - 100 / (1 + gain / loss)
                out.append((key[0], minute, rn, gain if ready else None, loss if ready else None, index))
            self.state.update((rn, close, gain, loss))
            yield pd.DataFrame(
                out, columns=["symbol", "minute", "rn", "avg_gain", "avg_loss", "rsi_14"]
            ).astype({"avg_gain": "float64", "avg_loss": "float64", "rsi_14": "float64"})

        def close(self) -> None:
            pass

    indexed = (
        bars.select("symbol", "minute", "close")
        .groupBy("symbol")
        .transformWithStateInPandas(
            statefulProcessor=Wilder(), outputStructType=OUTPUT, outputMode="Append", timeMode="None"
        )
    )
    return indexed.withColumn("rsi_14", published(F.col("rsi_14")))
