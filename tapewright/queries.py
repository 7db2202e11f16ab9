"""Registered queries over the market tables, each with its SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import history_queries, lake_queries, market_queries
from .functions.features import BOOLEAN, EMA_PERIODS, HIST, INTEGER, KEYS, MARKET, MARKET_DAILY, MARKET_WINDOWS, RECURRENT, RSI_PERIODS, SIGNAL_PERIOD, STAGES, WINDOWED
from .plans.feature_view import BASE, features, market_rows, refreshed_view, shared_windows, staged
from .sources.market_tables import QUOTES_SQL, placed_quotes, quotes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _duck(text: str) -> str:
    """The catalog's SQL for DuckDB, whose literals have no type suffix."""
    return re.sub(r"\b(\d+\.\d)D\b", r"CAST(\1 AS DOUBLE)", text)


def _six_places(c: str) -> Column:
    """As DuckDB rounds: half away from zero on the double times a million. Spark's own round goes by decimal text, many times as slow."""
    quick = F.signum(c) * F.floor(F.abs(c) * 1e6 + 0.5) / 1e6
    return F.when(F.abs(c) < 1e9, quick).otherwise(F.round(c, 6)) + F.lit(0.0)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[_six_places(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _round_sql(name: str, text: str) -> str:
    return f"{text} AS {name}" if name in BOOLEAN | INTEGER else f"round({text}, 6) + CAST(0 AS DOUBLE) AS {name}"


def _recurrence_sql() -> str:
    """The recurrences as recursive common table expressions over each instrument's row numbers."""
    run = "CASE WHEN n.g IS NULL THEN 0 ELSE s.run + 1 END"
    step = lambda held, x, n: f"CASE WHEN n.g IS NULL THEN 0 WHEN s.run + 1 < {n} THEN s.{held} + n.{x} WHEN s.run + 1 = {n} THEN (s.{held} + n.{x}) / {n} ELSE (s.{held} * {n - 1} + n.{x}) / {n} END"
    bad = "(n.p IS NULL OR n.p <= 0)"
    ema = lambda held, x, n, bad, run: f"CASE WHEN {bad} THEN 0 WHEN s.{run} + 1 < {n} THEN s.{held} + n.{x} WHEN s.{run} + 1 = {n} THEN (s.{held} + n.{x}) / {n} ELSE {2 / (n + 1)!r}::DOUBLE * n.{x} + (1.0::DOUBLE - {2 / (n + 1)!r}::DOUBLE) * s.{held} END"
    first = lambda n: f"CASE WHEN p IS NULL OR p <= 0 THEN 0::DOUBLE ELSE p / {1 if n > 1 else n} END"
    rsi_state = ", ".join(f"{step(f'g{n}', 'g', n)} AS g{n}, {step(f'l{n}', 'lo', n)} AS l{n}" for n in RSI_PERIODS)
    ema_state = ", ".join(f"{ema(f'e{n}', 'p', n, bad, 'erun')} AS e{n}" for n in EMA_PERIODS)
    keys = ", ".join(KEYS)
    same = " AND ".join(f"n.{k} = s.{k}" for k in KEYS)
    strength = lambda n: f"CASE WHEN run < {n} OR (g{n} = 0 AND l{n} = 0) THEN NULL WHEN l{n} = 0 THEN 100.0 WHEN g{n} = 0 THEN 0.0 ELSE 100.0 / (1.0 + exp(ln(l{n}) - ln(g{n}))) END"
    return f"""
numbered AS (SELECT *, lag(p) OVER x AS last, row_number() OVER x AS i FROM base WINDOW x AS (PARTITION BY {keys} ORDER BY trade_date)),
changes AS MATERIALIZED (SELECT *, CASE WHEN p > 0 AND last > 0 THEN greatest(p - last, 0.0) END AS g, CASE WHEN p > 0 AND last > 0 THEN greatest(last - p, 0.0) END AS lo FROM numbered),
walk AS (
  SELECT {keys}, i, 0 AS run, {', '.join(f'0::DOUBLE AS g{n}, 0::DOUBLE AS l{n}' for n in RSI_PERIODS)}, CASE WHEN p IS NULL OR p <= 0 THEN 0 ELSE 1 END AS erun, {', '.join(f'{first(n)} AS e{n}' for n in EMA_PERIODS)} FROM changes WHERE i = 1
  UNION ALL
  SELECT {', '.join('n.' + k for k in KEYS)}, n.i, {run}, {rsi_state}, CASE WHEN {bad} THEN 0 ELSE s.erun + 1 END, {ema_state} FROM walk s JOIN changes n ON {same} AND n.i = s.i + 1
),
values1 AS MATERIALIZED (SELECT {keys}, i, {', '.join(f'{strength(n)} AS wilder_{n}' for n in RSI_PERIODS)}, {', '.join(f'CASE WHEN erun >= {n} THEN e{n} END AS ema_{n}' for n in EMA_PERIODS)}, CASE WHEN erun >= 26 THEN e12 - e26 END AS macd FROM walk),
walk2 AS (
  SELECT {keys}, i, 0 AS run, 0::DOUBLE AS sig FROM values1 WHERE i = 1
  UNION ALL
  SELECT {', '.join('n.' + k for k in KEYS)}, n.i, CASE WHEN n.macd IS NULL THEN 0 ELSE s.run + 1 END, {ema('sig', 'macd', SIGNAL_PERIOD, 'n.macd IS NULL', 'run')} FROM walk2 s JOIN values1 n ON {same} AND n.i = s.i + 1
),
recurrent AS (SELECT c.*, v.* EXCLUDE ({keys}, i), CASE WHEN w.run >= {SIGNAL_PERIOD} THEN w.sig END AS signal
  FROM changes c JOIN values1 v USING ({keys}, i) JOIN walk2 w USING ({keys}, i))"""


def _feature_sql(families: list[str], market: bool, levels: bool) -> str:
    own = {n: x for f in families if f in WINDOWED for n, x in WINDOWED[f].items()}
    recurrent = {n: x for f in families if f in RECURRENT for n, x in RECURRENT[f].items()}
    keep = ", ".join([*KEYS, "trade_date", *(["CAST(trade_date + CASE isodow(trade_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS available_on", "round(p, 6) AS adjusted_close_level", "round(v, 6) AS volume_level"] if levels else [])])
    final = shared_windows({n: _round_sql(n, x).removesuffix(f" AS {n}") for n, x in (own | recurrent).items()}, "{last}", keep)
    base = f"base AS ({BASE.format(source=f'({QUOTES_SQL}) AS q')})"
    stages = [*STAGES, *([{"hist": HIST}] if recurrent else [])]
    text = staged("SELECT * FROM recurrent" if recurrent else "SELECT * FROM base", stages, final)
    with_ = f"WITH RECURSIVE {base}, {_recurrence_sql()}, " if recurrent else f"WITH {base}, "
    text = with_ + text.removeprefix("WITH ")
    if market:
        cut = text.rindex(" SELECT " + ", ".join(KEYS))
        text = f"{text[:cut]}, own AS ({text[cut:]}), {_market_ctes('s2')} SELECT own.*, market.* EXCLUDE (trade_date) FROM own JOIN market USING (trade_date)"
    return _duck(text)


def _market_ctes(source: str) -> str:
    daily = ", ".join(f"{x} AS {n}" for n, x in MARKET_DAILY.items())
    rolled = ", ".join([*(_round_sql(n, n) for n in MARKET_DAILY), *(_round_sql(n, x) for n, x in MARKET.items())])
    return f"daily AS (SELECT trade_date, {daily} FROM {source} GROUP BY trade_date), market AS (SELECT trade_date, {rolled} FROM daily {MARKET_WINDOWS})"


def _refreshed(spark: SparkSession, d: str) -> DataFrame:
    """A view of older quotes, brought up to date for the instruments whose quotes changed."""
    now = quotes(spark, d)
    is_changed = F.expr("CAST(substr(isin, 2) AS INT) % 4 = 0")
    old = now.withColumn("adjusted_close", F.when(is_changed, F.col("adjusted_close") * 2 + 1).otherwise(F.col("adjusted_close")))
    stored = features(old, ["returns"], levels=False)
    return refreshed_view(stored, now, now.filter(is_changed).select(*KEYS), ["returns"], levels=False, shaped=_rounded)


def _register_features() -> None:
    for family in [*WINDOWED, *RECURRENT]:
        QUERIES[f"feat_{family}"] = lambda spark, d, f=family: _rounded(features(quotes(spark, d), [f], market=False, levels=False))
        SQL[f"feat_{family}"] = _feature_sql([family], market=False, levels=False)
    QUERIES["feat_breadth_dispersion"] = lambda spark, d: _rounded(market_rows(quotes(spark, d)))
    base = f"base AS ({BASE.format(source=f'({QUOTES_SQL}) AS q')})"
    SQL["feat_breadth_dispersion"] = _duck(f"WITH {base}, " + staged("SELECT * FROM base", STAGES[:2], "SELECT * FROM {last}").removeprefix("WITH ").rsplit(" SELECT * FROM s2", 1)[0] + f", {_market_ctes('s2')} SELECT * FROM market")
    QUERIES["feature_view_full"] = lambda spark, d: _rounded(features(placed_quotes(spark, d), placed=True).withColumn("available_on", F.to_date("available_at_utc")).drop("available_at_utc"))
    SQL["feature_view_full"] = _feature_sql([*WINDOWED, *RECURRENT], market=True, levels=True)
    QUERIES["feature_view_refreshed"] = _refreshed
    SQL["feature_view_refreshed"] = _feature_sql(["returns"], market=True, levels=False)
    QUERIES["quotes"] = lambda spark, d: _rounded(quotes(spark, d))
    SQL["quotes"] = f"SELECT isin, exchange, code, trade_date, {', '.join(f"round({c}, 6) + CAST(0 AS DOUBLE) AS {c}" for c in ('open', 'high', 'low', 'close', 'adjusted_close'))}, volume FROM ({QUOTES_SQL}) AS q"


_register_features()
QUERIES |= market_queries.QUERIES | history_queries.QUERIES | lake_queries.QUERIES
SQL |= market_queries.SQL | history_queries.SQL | lake_queries.SQL
