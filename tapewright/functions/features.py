"""The feature catalog: each feature is a SQL expression over staged columns, valid in Spark and in plain ANSI SQL.

Frames are trailing windows of n rows of one instrument, named w{n}; a feature is null unless all n values are there.
The stages only build on each other, so Spark needs one exchange and one sort for all of them.
"""

from __future__ import annotations

from hashlib import sha256
from json import dumps

KEYS = ("isin", "exchange", "code")
FRAMES = (3, 4, 5, 8, 10, 14, 15, 16, 20, 32, 40, 60, 96, 120, 192)
CATALOG_VERSION = 5


def frame(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def window_clause() -> str:
    by = f"PARTITION BY {', '.join(KEYS)} ORDER BY trade_date"
    named = [f"w AS ({by})", f"before20 AS ({by} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"]
    return "WINDOW " + ", ".join(named + [f"w{n} AS ({by} {frame(n)})" for n in FRAMES])


def lag(x: str, k: int) -> str:
    return f"lag({x}, {k}) OVER w"


def full(agg: str, x: str, n: int) -> str:
    """The aggregate of the last n rows, if none of them lacks the value."""
    return f"CASE WHEN count({x}) OVER w{n} = {n} THEN {agg}({x}) OVER w{n} END"


def positive(then: str, *values: str) -> str:
    return f"CASE WHEN {' AND '.join(f'{v} > 0' for v in values)} THEN {then} END"


def deviation(x: str, n: int, spread: str = "stddev_samp") -> str:
    return f"CASE WHEN count({x}) OVER w{n} = {n} THEN ({x} - avg({x}) OVER w{n}) / nullif({spread}({x}) OVER w{n}, 0) END"


def correlation(x: str, y: str, n: int) -> str:
    """Pearson's r of n pairs; null where a side doesn't vary."""
    both = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN 1 END"
    spread = f"sqrt(regr_sxx({x}, {y}) OVER w{n} * regr_syy({x}, {y}) OVER w{n})"
    return f"CASE WHEN count({both}) OVER w{n} = {n} THEN regr_sxy({x}, {y}) OVER w{n} / nullif({spread}, 0) END"


def stochastic(n: int) -> str:
    high, low = f"max(h) OVER w{n}", f"min(l) OVER w{n}"
    return f"CASE WHEN count(h) OVER w{n} = {n} AND count(l) OVER w{n} = {n} AND {high} > {low} THEN 100.0D * (c - {low}) / nullif({high} - {low}, 0) END"


def breakout(agg: str, x: str, sign: str) -> str:
    return f"CASE WHEN count(h) OVER before20 = 20 AND count(l) OVER before20 = 20 THEN {x} {sign} {agg}({x}) OVER before20 END"


#: Intermediate columns by stage: each stage sees the columns of those before it.
STAGES: tuple[dict[str, str], ...] = (
    {f"p_{k}": lag("p", k) for k in (1, 2, 3, 4, 5, 8, 10, 20)} | {"c_1": lag("c", 1)},
    {f"r_{k}": positive(f"ln(p / p_{k})", "p", f"p_{k}") for k in (1, 2, 3, 4, 5, 8, 10, 20)}
    | {"d_1": "p - p_1", "span": positive("(h - l) / c", "c"), "intraday": positive("(c - o) / o", "o"), "gap": positive("(o - c_1) / c_1", "c_1")},
    {f"r_lag_{k}": lag("r_1", k) for k in (1, 4, 8)} | {f"d_lag_{k}": lag("d_1", k) for k in (1, 5, 20)}
    | {"k_5": stochastic(5), "k_14": stochastic(14), "vol_8": full("stddev_samp", "r_1", 8)},
)

_level = "adjusted_close"
_growth = lambda n: full("sum", "r_1", n).replace("sum(r_1)", "exp(sum(r_1)").replace(f"OVER w{n} END", f"OVER w{n}) - 1 END")
_ratio = lambda a, b: f"CASE WHEN count(p) OVER w{b} = {b} THEN avg(p) OVER w{a} / nullif(avg(p) OVER w{b}, 0) END"
_drawdown = lambda n: f"CASE WHEN count(p) OVER w{n} = {n} THEN p / nullif(max(p) OVER w{n}, 0) - 1 END"
_roc = lambda k: positive(f"p / p_{k} - 1", "p", f"p_{k}")
_share = lambda n: f"CASE WHEN count(v) OVER w{n} = {n} THEN v / nullif(avg(v) OVER w{n}, 0) END"

#: Features of one instrument's own rows, by family.
WINDOWED: dict[str, dict[str, str]] = {
    "levels": {f"{_level}_log_level": positive("ln(p)", "p"), "log_tick_volume": "CASE WHEN v >= 0 THEN ln(1.0D + v) END"}
    | {f"{_level}_absolute_delta_{k}obs": f"p - p_{k}" for k in (1, 5, 20)},
    "returns": {f"{_level}_log_return_{k}obs": f"r_{k}" for k in (1, 3, 5, 10, 20)} | {f"log_return_{k}": f"r_{k}" for k in (1, 2, 3, 4, 5, 8, 10, 20)},
    "cumret_mean": {f"{_level}_return_geom_{n}obs_pct": _growth(n) for n in (5, 10, 20)} | {f"rolling_cum_return_{n}": _growth(n) for n in (4, 8, 16)}
    | {f"{_level}_return_mean_{n}obs": full("avg", "r_1", n) for n in (5, 10, 20)},
    "volatility": {f"{_level}_volatility_{n}obs": full("stddev_samp", "r_1", n) for n in (5, 10, 20, 40)} | {f"rolling_volatility_{n}": full("stddev_samp", "r_1", n) for n in (8, 32, 96)},
    "ohlc": {f"{name}_1obs": x for name, x in (("high_low_range", "span"), ("intraday_return", "intraday"), ("overnight_gap", "gap"))}
    | {f"{name}_5obs": full("avg", x, 5) for name, x in (("high_low_range", "span"), ("intraday_return", "intraday"), ("overnight_gap", "gap"))},
    "sma": {f"{_level}_sma_ratio_{a}_{b}": _ratio(a, b) for a, b in ((5, 20), (10, 20), (10, 40))} | {"sma_ratio_5_15": _ratio(5, 15)},
    "stoch": {"stoch_k_5": "k_5", "stoch_d_5_3": full("avg", "k_5", 3), "stoch_k_14": "k_14", "stoch_d_14_3": full("avg", "k_14", 3), "stoch_kd_spread_5": f"k_5 - {full('avg', 'k_5', 3)}", "stoch_k_slope_3": f"(k_5 - {lag('k_5', 3)}) / 3.0D"},
    "donchian": {"donchian_breakout_up": breakout("max", "h", ">"), "donchian_breakout_down": breakout("min", "l", "<")},
    "autocorr": {f"return_autocorr_lag{k}_window{n}": correlation("r_1", f"r_lag_{k}", n) for k, n in ((1, 96), (4, 96), (8, 192))},
    "momentum_autocorr": {
        f"momentum_autocorr_delta_lag{k}_window{n}": f"CASE WHEN count(CASE WHEN d_1 IS NOT NULL AND d_lag_{k} IS NOT NULL THEN 1 END) OVER w{n} = {n} THEN greatest(coalesce({correlation('d_1', f'd_lag_{k}', n)}, 0.0D), 0.0D) END"
        for k, n in ((1, 60), (5, 60), (20, 120))
    },
    "drawdown": {f"{_level}_drawdown_{n}obs": _drawdown(n) for n in (20, 60)} | {f"rolling_drawdown_{n}": _drawdown(n) for n in (32, 96)},
    "zscores": {"volatility_zscore_96": deviation("vol_8", 96), "level_zscore_96": deviation("p", 96), "level_zscore_60": deviation("p", 60, "stddev_pop")},
    "roc": {f"roc_{k}": _roc(k) for k in (1, 2, 4, 8)} | {"roc_acceleration_4_8": f"{_roc(4)} - {_roc(8)}"} | {f"{_level}_roc_{k}obs": _roc(k) for k in (3, 5, 10, 20)},
    "volume": {f"relative_volume_{n}obs": _share(n) for n in (5, 10, 20)} | {f"volume_zscore_{n}obs": deviation("v", n) for n in (5, 10, 20)},
}

_against = lambda e: positive(f"p / {e} - 1", "p")
_hist = positive("(macd - signal) / p", "p")
#: Features of the recurrences (wilder_{n}, ema_{n}, macd, signal), which are further columns of one instrument's rows.
RECURRENT: dict[str, dict[str, str]] = {
    "rsi": {f"{_level}_rsi_{n}obs": f"wilder_{n}" for n in (7, 14)} | {f"rsi_{n}": f"wilder_{n}" for n in (3, 5, 7, 14)}
    | {"rsi_ratio_5_15": "wilder_5 / nullif(wilder_15, 0)", "rsi5_slope_3": f"(wilder_5 - {lag('wilder_5', 3)}) / 3.0D", "rsi5_delta_1": f"wilder_5 - {lag('wilder_5', 1)}"},
    "ema": {f"ema{n}_distance": _against(f"ema_{n}") for n in (5, 9, 21)}
    | {
        "ema5_ema21_spread": positive("(ema_5 - ema_21) / p", "p"),
        "ema9_slope_3": positive(f"(ema_9 - {lag('ema_9', 3)}) / (3.0D * p)", "p"),
        "ema5_ema9_cross": f"CAST(CASE WHEN ema_5 + ema_9 + {lag('ema_5', 1)} + {lag('ema_9', 1)} IS NULL THEN NULL WHEN ema_5 > ema_9 AND {lag('ema_5', 1)} <= {lag('ema_9', 1)} THEN 1 WHEN ema_5 < ema_9 AND {lag('ema_5', 1)} >= {lag('ema_9', 1)} THEN -1 ELSE 0 END AS INT)",
    },
    "macd": {"macd_line_relative": positive("macd / p", "p"), "macd_hist_relative": _hist, "macd_hist_delta_3": f"hist - {lag('hist', 3)}"},
}
HIST = _hist

#: Features of the whole market on one date: the daily value and its means over dates.
MARKET: dict[str, str] = {
    f"{name}_{n}obs": f"CASE WHEN count({name}_daily) OVER m{n} = {n} THEN avg({name}_daily) OVER m{n} END" for name in ("breadth", "dispersion") for n in (5, 10, 20)
}
MARKET_DAILY = {"breadth_daily": "avg(CASE WHEN r_1 > 0 THEN 1.0D WHEN r_1 IS NOT NULL THEN 0.0D END)", "dispersion_daily": "stddev_samp(r_1)"}
MARKET_WINDOWS = "WINDOW " + ", ".join(f"m{n} AS (ORDER BY trade_date {frame(n)})" for n in (5, 10, 20))

RSI_PERIODS, EMA_PERIODS, SIGNAL_PERIOD = (3, 5, 7, 14, 15), (5, 9, 12, 21, 26), 9
BOOLEAN = {"donchian_breakout_up", "donchian_breakout_down"}
INTEGER = {"ema5_ema9_cross"}


def feature_names() -> list[str]:
    """The 106 derived features."""
    own = [n for family in (*WINDOWED.values(), *RECURRENT.values()) for n in family]
    return [*own, *MARKET_DAILY, *MARKET]


def catalog_fingerprint() -> str:
    """Changes with any feature's name or definition."""
    held = {"version": CATALOG_VERSION, "stages": STAGES, "windowed": WINDOWED, "recurrent": RECURRENT, "market": MARKET | MARKET_DAILY}
    return sha256(dumps(held, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def check_catalog() -> None:
    names = feature_names()
    if len(names) != len(set(names)):
        raise ValueError("a feature is defined twice")
    if raw := {"open", "high", "low", "close"} & set(names):
        raise ValueError(f"raw prices must not be features: {sorted(raw)}")
