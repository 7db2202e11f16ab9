"""Recurrences over one instrument's rows: Wilder's RSI, exponential averages and MACD, all in one ordered pass."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.features import EMA_PERIODS, RSI_PERIODS, SIGNAL_PERIOD
from .frames import places, whole_instruments

COLUMNS = (*(f"wilder_{n}" for n in RSI_PERIODS), *(f"ema_{n}" for n in EMA_PERIODS), "macd", "signal")


def _strength(gain: float, loss: float) -> float:
    """The share of gains in all movement, in percent; without movement there is none."""
    if gain == 0:
        return 0.0 if loss > 0 else math.nan
    return 100 / (1 + loss / gain)


def wilder_rsi(prices: Sequence[float], period: int) -> np.ndarray:
    """NaN stands for null. A change counts only between two positive prices; a missing one starts the run anew."""
    out = np.full(len(prices), math.nan)
    run, gain, loss = 0, 0.0, 0.0
    for k in range(1, len(prices)):
        now, last = prices[k], prices[k - 1]
        if not (now > 0 and last > 0):
            run, gain, loss = 0, 0.0, 0.0
            continue
        up, down = max(now - last, 0.0), max(last - now, 0.0)
        run += 1
        if run <= period:
            gain, loss = gain + up, loss + down
            if run < period:
                continue
            gain, loss = gain / period, loss / period
        else:
            gain, loss = (gain * (period - 1) + up) / period, (loss * (period - 1) + down) / period
        out[k] = _strength(gain, loss)
    return out


def exponential_average(values: Sequence[float], period: int, any_sign: bool = False) -> np.ndarray:
    """Starts with the mean of `period` valid values in a row; an invalid one starts the run anew."""
    out = np.full(len(values), math.nan)
    run, held, weight = 0, 0.0, 2.0 / (period + 1.0)
    for k, x in enumerate(values):
        if math.isnan(x) or (x <= 0 and not any_sign):
            run, held = 0, 0.0
            continue
        run += 1
        if run > period:
            held = weight * x + (1.0 - weight) * held
        else:
            held += x
            if run < period:
                continue
            held /= period
        out[k] = held
    return out


def with_recurrences(rows: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Adds the recurrence columns, or some of them, to rows of KEYS, trade_date and p (adjusted close) that are in_order()."""
    averages = [n for n in EMA_PERIODS if f"ema_{n}" in columns or (n in (12, 26) and {"macd", "signal"} & set(columns))]

    def of_one(prices: list[float]) -> dict[str, np.ndarray]:
        made = {f"wilder_{n}": wilder_rsi(prices, n) for n in RSI_PERIODS if f"wilder_{n}" in columns} | {f"ema_{n}": exponential_average(prices, n) for n in averages}
        if {"macd", "signal"} & set(columns):
            made["macd"] = made["ema_12"] - made["ema_26"]
        if "signal" in columns:
            made["signal"] = exponential_average(made["macd"].tolist(), SIGNAL_PERIOD, any_sign=True)
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_instruments(batches):
            prices = table.column("p").combine_chunks().to_numpy(zero_copy_only=False).astype("float64")  # a null is NaN
            cuts = np.flatnonzero(places(table) == 0)
            made = [of_one(x.tolist()) for x in np.split(prices, cuts[1:])]
            for c in columns:
                table = table.append_column(c, pa.array(np.concatenate([m[c] for m in made]), from_pandas=True))  # NaN reaches Spark as null
            yield from table.to_batches(max_chunksize=10_000)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{schema}, " + ", ".join(f"{c} double" for c in columns))
