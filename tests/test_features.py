import datetime
import math
import os
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tapewright.functions.features import catalog_fingerprint, check_catalog, feature_names, window_clause
from tapewright.operators.frames import in_order, with_calls
from tapewright.operators.recurrences import exponential_average, wilder_rsi
from tapewright.plans.feature_view import features, market_rows, refreshed_view
from tapewright.queries import QUERIES
from tapewright.sources.market_tables import placed_quotes, quotes

SF = "/root/testdata/sf0.001"
SCHEMA = "isin string, exchange string, code string, trade_date date, open double, high double, low double, close double, adjusted_close double, volume long"


def series(days=220, skip=()):
    """Two instruments: random walks by day, with some flat days; days in skip are left out."""
    out = []
    for seed, code in ((31, "AAA"), (77, "BBB")):
        rng, p = random.Random(seed), 50.0 + seed
        for i in range(days):
            p *= 1 + (rng.gauss(0.0004, 0.013) if i % 17 else 0)
            o, c = p * (1 + rng.uniform(-0.006, 0.006)), p * (1 + rng.uniform(-0.006, 0.006))
            high, low = max(o, c) * (1 + rng.uniform(0, 0.004)), min(o, c) * (1 - rng.uniform(0, 0.004))
            volume = rng.randint(0, 5000)
            if (code, i) not in skip:
                out.append((f"DE00000000{seed}", "XTST", code, datetime.date(2026, 1, 2) + datetime.timedelta(i), o, high, low, c, p, volume))
    return out


def plain_features(rows):
    """All features of one instrument's rows (without those of the market), one dictionary a row, from their definitions."""
    o, h, l, c, p = ([r[k] for r in rows] for k in (4, 5, 6, 7, 8))  # noqa: E741
    v, n = [float(r[9]) for r in rows], len(rows)
    each = lambda f, *xs: [f(*t) if None not in t else None for t in zip(*xs)]
    back = lambda x, k: [None] * min(k, n) + x[: max(0, n - k)]

    def roll(f, size, *xs):
        parts = [[x[i - size + 1 : i + 1] for x in xs] if i + 1 >= size else None for i in range(n)]
        return [f(*t) if t and not any(None in x for x in t) else None for t in parts]

    mean, stdev = statistics.fmean, statistics.stdev
    over = lambda a, b: a / b if b else None
    score = lambda x, size, spread=stdev: roll(lambda w: over(w[-1] - mean(w), spread(w)), size, x)
    r = {k: each(lambda a, b: math.log(a / b) if a > 0 and b > 0 else None, p, back(p, k)) for k in range(1, 21)}
    out = {"adjusted_close_log_level": [math.log(x) for x in p], "log_tick_volume": [math.log1p(x) for x in v]}
    for k in (1, 5, 20):
        out[f"adjusted_close_absolute_delta_{k}obs"] = each(lambda a, b: a - b, p, back(p, k))
    out |= {f"adjusted_close_log_return_{k}obs": r[k] for k in (1, 3, 5, 10, 20)} | {f"log_return_{k}": r[k] for k in (1, 2, 3, 4, 5, 8, 10, 20)}
    growth = lambda k: roll(lambda w: math.exp(math.fsum(w)) - 1, k, r[1])
    out |= {f"adjusted_close_return_geom_{k}obs_pct": growth(k) for k in (5, 10, 20)} | {f"rolling_cum_return_{k}": growth(k) for k in (4, 8, 16)}
    out |= {f"adjusted_close_return_mean_{k}obs": roll(mean, k, r[1]) for k in (5, 10, 20)}
    out |= {f"adjusted_close_volatility_{k}obs": roll(stdev, k, r[1]) for k in (5, 10, 20, 40)} | {f"rolling_volatility_{k}": roll(stdev, k, r[1]) for k in (8, 32, 96)}
    bars = {"high_low_range": each(lambda a, b, d: (a - b) / d, h, l, c), "intraday_return": each(lambda a, b: (a - b) / b, c, o), "overnight_gap": each(lambda a, b: (a - b) / b, o, back(c, 1))}
    out |= {f"{k}_1obs": x for k, x in bars.items()} | {f"{k}_5obs": roll(mean, 5, x) for k, x in bars.items()}
    ratio = lambda a, b: roll(lambda w: mean(w[-a:]) / mean(w), b, p)
    out |= {f"adjusted_close_sma_ratio_{a}_{b}": ratio(a, b) for a, b in ((5, 20), (10, 20), (10, 40))} | {"sma_ratio_5_15": ratio(5, 15)}
    stoch = {k: roll(lambda a, b, d: 100 * (d[-1] - min(b)) / (max(a) - min(b)), k, h, l, c) for k in (5, 14)}
    smooth = {k: roll(mean, 3, x) for k, x in stoch.items()}
    out |= {"stoch_k_5": stoch[5], "stoch_d_5_3": smooth[5], "stoch_k_14": stoch[14], "stoch_d_14_3": smooth[14]}
    out |= {"stoch_kd_spread_5": each(lambda a, b: a - b, stoch[5], smooth[5]), "stoch_k_slope_3": each(lambda a, b: (a - b) / 3, stoch[5], back(stoch[5], 3))}
    out["donchian_breakout_up"] = [h[i] > max(h[i - 20 : i]) if i >= 20 else None for i in range(n)]
    out["donchian_breakout_down"] = [l[i] < min(l[i - 20 : i]) if i >= 20 else None for i in range(n)]
    for k, size in ((1, 96), (4, 96), (8, 192)):
        out[f"return_autocorr_lag{k}_window{size}"] = roll(statistics.correlation, size, r[1], back(r[1], k))
    delta = each(lambda a, b: a - b, p, back(p, 1))
    for k, size in ((1, 60), (5, 60), (20, 120)):
        out[f"momentum_autocorr_delta_lag{k}_window{size}"] = roll(lambda a, b: max(statistics.correlation(a, b), 0.0), size, delta, back(delta, k))
    fall = lambda k: roll(lambda w: w[-1] / max(w) - 1, k, p)
    out |= {f"adjusted_close_drawdown_{k}obs": fall(k) for k in (20, 60)} | {f"rolling_drawdown_{k}": fall(k) for k in (32, 96)}
    out |= {"volatility_zscore_96": score(roll(stdev, 8, r[1]), 96), "level_zscore_96": score(p, 96), "level_zscore_60": score(p, 60, statistics.pstdev)}
    roc = {k: each(lambda a, b: a / b - 1, p, back(p, k)) for k in (1, 2, 3, 4, 5, 8, 10, 20)}
    out |= {f"roc_{k}": roc[k] for k in (1, 2, 4, 8)} | {f"adjusted_close_roc_{k}obs": roc[k] for k in (3, 5, 10, 20)} | {"roc_acceleration_4_8": each(lambda a, b: a - b, roc[4], roc[8])}
    out |= {f"relative_volume_{k}obs": roll(lambda w: over(w[-1], mean(w)), k, v) for k in (5, 10, 20)} | {f"volume_zscore_{k}obs": score(v, k) for k in (5, 10, 20)}

    def strength(period):
        done, up, down = [None] * n, [max(b - a, 0.0) for a, b in zip(p, p[1:])], [max(a - b, 0.0) for a, b in zip(p, p[1:])]
        for i in range(period, n):
            g, d = mean(up[:period]), mean(down[:period])
            for k in range(period, i):
                g, d = (g * (period - 1) + up[k]) / period, (d * (period - 1) + down[k]) / period
            done[i] = 100 * g / (g + d) if g + d else None
        return done

    def average(x, period):
        start = next((i for i, y in enumerate(x) if y is not None), n)
        done = [None] * n
        for i in range(start + period - 1, n):
            last = mean(x[start : start + period]) if i == start + period - 1 else done[i - 1] + 2 / (period + 1) * (x[i] - done[i - 1])
            done[i] = last
        return done

    rsi, ema = {k: strength(k) for k in (3, 5, 7, 14, 15)}, {k: average(p, k) for k in (5, 9, 12, 21, 26)}
    out |= {f"adjusted_close_rsi_{k}obs": rsi[k] for k in (7, 14)} | {f"rsi_{k}": rsi[k] for k in (3, 5, 7, 14)} | {"rsi_ratio_5_15": each(over, rsi[5], rsi[15])}
    out |= {"rsi5_slope_3": each(lambda a, b: (a - b) / 3, rsi[5], back(rsi[5], 3)), "rsi5_delta_1": each(lambda a, b: a - b, rsi[5], back(rsi[5], 1))}
    out |= {f"ema{k}_distance": each(lambda a, b: a / b - 1, p, ema[k]) for k in (5, 9, 21)} | {"ema5_ema21_spread": each(lambda a, b, d: (a - b) / d, ema[5], ema[21], p)}
    out["ema9_slope_3"] = each(lambda a, b, d: (a - b) / 3 / d, ema[9], back(ema[9], 3), p)
    above = each(lambda a, b: a > b, ema[5], ema[9])
    out["ema5_ema9_cross"] = each(lambda a, b: int(a) - int(b), above, back(above, 1))
    line = each(lambda a, b: a - b, ema[12], ema[26])
    hist = each(lambda a, b, d: (a - b) / d, line, average(line, 9), p)
    return out | {"macd_line_relative": each(lambda a, b: a / b, line, p), "macd_hist_relative": hist, "macd_hist_delta_3": each(lambda a, b: a - b, hist, back(hist, 3))}


def plain_market(returns):
    """returns: by day, the instruments' returns. Breadth and dispersion by day, and their trailing means."""
    days = sorted(returns)
    daily = {"breadth": [], "dispersion": []}
    for d in days:
        known = [x for x in returns[d] if x is not None]
        daily["breadth"].append(statistics.fmean(x > 0 for x in known) if known else None)
        daily["dispersion"].append(statistics.stdev(known) if len(known) > 1 else None)
    out = {d: {f"{name}_daily": x[i] for name, x in daily.items()} for i, d in enumerate(days)}
    for name, x in daily.items():
        for k in (5, 10, 20):
            for i, d in enumerate(days):
                part = x[max(0, i - k + 1) : i + 1]
                out[d][f"{name}_{k}obs"] = statistics.fmean(part) if len(part) == k and None not in part else None
    return out


@pytest.mark.parametrize("skip", [(), {("BBB", k) for k in (0, 1, 2, 20, 21, 90)}], ids=["full", "sparse"])
def test_all_features_match_plain_python(spark, skip):
    """Each of the 106 features on each row, from definitions that share nothing with the catalog."""
    rows = series(210, skip)
    got = {(r.code, r.trade_date): r for r in features(spark.createDataFrame(rows, SCHEMA)).collect()}
    returns = {}
    want = {}
    for code in ("AAA", "BBB"):
        own = [r for r in rows if r[2] == code]
        made = plain_features(own)
        for i, r in enumerate(own):
            want[code, r[3]] = {k: x[i] for k, x in made.items()}
            returns.setdefault(r[3], []).append(made["log_return_1"][i])
    market = plain_market(returns)
    assert set(got) == set(want)
    names = set(feature_names())
    for key, row in want.items():
        row |= market[key[1]]
        assert set(row) == names
        for name, x in row.items():
            y = got[key][name]
            assert (x is None and y is None) or (x is not None and y is not None and math.isclose(x, y, rel_tol=1e-7, abs_tol=1e-9)), (key, name, x, y)


@pytest.fixture(scope="module")
def view(spark):
    rows = features(spark.createDataFrame(series(), SCHEMA)).collect()
    return {(r.code, (r.trade_date - datetime.date(2026, 1, 2)).days): r for r in rows}


def close(a, b):
    return a is b is None or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_catalog():
    check_catalog()
    assert len(feature_names()) == 106 and len(catalog_fingerprint()) == 64


def test_view_has_all_columns(view):
    row = view["AAA", 219].asDict()
    assert len(view) == 440
    assert set(feature_names()) <= set(row) and len(row) == 113
    assert [n for n in feature_names() if row[n] is None] == []


def test_windows_match_plain_python(view):
    price = {i: r[8] for i, r in enumerate(series()[:220])}
    data = {i: r for i, r in enumerate(series()[:220])}
    ret = {i: math.log(price[i] / price[i - 1]) for i in range(1, 220)}
    vol8 = {i: statistics.stdev(ret[j] for j in range(i - 7, i + 1)) for i in range(8, 220)}
    for i in (0, 1, 4, 5, 20, 21, 60, 96, 97, 103, 104, 199, 200, 219):
        r = view["AAA", i]
        last = lambda n: [ret[j] for j in range(i - n + 1, i + 1)] if i >= n else None
        level = lambda n: [price[j] for j in range(i - n + 1, i + 1)] if i + 1 >= n else None
        assert close(r.rolling_cum_return_16, math.exp(sum(last(16))) - 1 if last(16) else None)
        assert close(r.rolling_volatility_96, statistics.stdev(last(96)) if last(96) else None)
        assert close(r.adjusted_close_return_mean_20obs, statistics.fmean(last(20)) if last(20) else None)
        assert close(r.level_zscore_60, (price[i] - statistics.fmean(level(60))) / statistics.pstdev(level(60)) if level(60) else None)
        assert close(r.rolling_drawdown_32, price[i] / max(level(32)) - 1 if level(32) else None)
        assert close(r.adjusted_close_sma_ratio_10_40, statistics.fmean(level(10)) / statistics.fmean(level(40)) if level(40) else None)
        z = [vol8[j] for j in range(i - 95, i + 1)] if i >= 103 else None
        assert close(r.volatility_zscore_96, (vol8[i] - statistics.fmean(z)) / statistics.stdev(z) if z else None)
        if i >= 20:
            high = max(data[j][5] for j in range(i - 20, i))
            assert r.donchian_breakout_up == (data[i][5] > high)
        if i >= 13:
            low, high = min(data[j][6] for j in range(i - 13, i + 1)), max(data[j][5] for j in range(i - 13, i + 1))
            assert close(r.stoch_k_14, 100 * (data[i][7] - low) / (high - low))
        if i >= 200:
            pairs = [(ret[j], ret[j - 8]) for j in range(i - 191, i + 1)]
            assert close(r.return_autocorr_lag8_window192, statistics.correlation(*zip(*pairs)))
        else:
            assert r.return_autocorr_lag8_window192 is None


def test_no_look_ahead(spark, view):
    changed = [(*r[:8], r[8] * 3, r[9]) if (r[3] - datetime.date(2026, 1, 2)).days >= 150 else r for r in series()]
    rows = features(spark.createDataFrame(changed, SCHEMA)).collect()
    for r in rows:
        day = (r.trade_date - datetime.date(2026, 1, 2)).days
        if day < 150:
            assert r == view[r.code, day]


def test_sparse_calendar(spark):
    skip = {("BBB", k) for k in (0, 1, 2, 20)}
    data = series(65, skip)
    rows = {(r.code, r.trade_date.toordinal()): r for r in features(spark.createDataFrame(data, SCHEMA), ["returns"]).collect()}
    first = datetime.date(2026, 1, 2).toordinal()
    assert rows["BBB", first + 3].log_return_1 is None
    price = {r[3].toordinal() - first: r[8] for r in data if r[2] == "BBB"}
    assert close(rows["BBB", first + 21].log_return_1, math.log(price[21] / price[19]))
    up = rows["AAA", first + 20].log_return_1 > 0
    assert rows["AAA", first + 20].breadth_daily == float(up) and rows["AAA", first + 20].dispersion_daily is None


def test_market_rows(spark):
    rows = market_rows(spark.createDataFrame(series(40), SCHEMA)).orderBy("trade_date").collect()
    assert len(rows) == 40 and rows[0].breadth_daily is None and rows[4].breadth_5obs is None and rows[5].breadth_5obs is not None


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_refreshed_view_is_made_of_methods_that_java_compiles(spark, capsys):
    """HotSpot interprets a method of more than 8,000 bytes for good; rounding all columns of the whole view was one of 9,919."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan isn't final, and its code not shown
    try:
        QUERIES["feature_view_refreshed"](spark, SF).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_full_view_exchanges_its_lines_once(spark):
    """Quotes of two branches were exchanged twice each, the lines as grouped rows several times as wide as stored ones."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan isn't final
    try:
        plan = QUERIES["feature_view_full"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    keyed = [x.split(")")[0] for x in re.findall(r"^[ :+-]*Exchange hashpartitioning\((.*)", plan, re.M)]
    assert [re.sub(r"#\d+L?", "", x).split(", ")[:-1] for x in keyed] in ([["isin", "code"], ["trade_date"]], [["trade_date"], ["isin", "code"]])
    assert len(re.findall(r"^[ :+-]*ReusedExchange .*hashpartitioning\(isin", plan, re.M)) == 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_placed_quotes_are_the_quotes_and_lie_by_instrument_and_date(spark):
    got = placed_quotes(spark, SF).withColumn("part", F.spark_partition_id()).collect()
    want = quotes(spark, SF).collect()
    columns = quotes(spark, SF).columns
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(tuple(r) for r in want) and [(k, x.dataType) for k, x in zip(columns, quotes(spark, SF).schema)] == [(x.name, x.dataType) for x in placed_quotes(spark, SF).schema]
    home = {}
    for r in got:
        home.setdefault((r.isin, r.code), []).append((r.part, r.trade_date))
    assert len({p for x in home.values() for p, _ in x}) > 1 and all(len({p for p, _ in x}) == 1 and x == sorted(x) for x in home.values())


def test_refreshed_view_shapes_each_part_once(spark):
    """A refreshed view is the view made anew, whatever the stored rows of changed instruments were, and every value is shaped once."""
    now = spark.createDataFrame(series(40), SCHEMA)
    old = now.withColumn("adjusted_close", F.when(F.col("code") == "BBB", F.col("adjusted_close") * 2 + 1).otherwise(F.col("adjusted_close")))
    changed = now.filter("code = 'BBB'").select("isin", "exchange", "code")
    more = lambda rows: rows.select(*[(F.col(c) + 1).alias(c) if t == "double" else F.col(c) for c, t in rows.dtypes])
    stored = features(old, ["returns"], levels=False)
    want = features(now, ["returns"], levels=False)
    rows = lambda df: sorted((tuple(r[c] for c in want.columns) for r in df.collect()), key=lambda r: r[:4])
    assert rows(refreshed_view(stored, now, changed, ["returns"], levels=False)) == rows(want)
    assert rows(refreshed_view(stored, now, changed, ["returns"], levels=False, shaped=more)) == rows(more(want))


def test_flat_prices_have_no_correlation(spark):
    flat = [(*r[:8], 100.0, r[9]) for r in series(130)[:130]]
    last = features(spark.createDataFrame(flat, SCHEMA), ["autocorr", "momentum_autocorr", "volume"]).orderBy("trade_date").collect()[-1]
    assert last.return_autocorr_lag1_window96 is None and last.momentum_autocorr_delta_lag1_window60 == 0.0


@pytest.mark.parametrize(
    ("prices", "period", "want"),
    [
        ([1, 2, 3, 4], 3, [None, None, None, 100]),
        ([4, 3, 2, 1], 3, [None, None, None, 0]),
        ([2, 2, 2, 2], 3, [None] * 4),
        ([10, 11, 12, math.nan, 13, 14, 15, 16], 3, [None] * 7 + [100]),
        ([10, 11, 0, 12, 13, 14, 15], 3, [None] * 6 + [100]),
        ([1, 2], 1, [None, 100]),
    ],
)
def test_rsi_edges(prices, period, want):
    assert [None if math.isnan(x) else x for x in wilder_rsi(prices, period)] == want


def test_rsi_extremes_do_not_overflow():
    assert wilder_rsi([1, 1e300, 1e300 - 1e284], 1).tolist()[1:] == [100.0, 0.0]
    assert 0 <= wilder_rsi([1e300, 1e300 * 1.5, 1e-300], 2)[2] <= 100


def test_ema_resets():
    got = exponential_average([1, 2, 3, 4, -1, 5, 6, 7], 3)
    assert [None if math.isnan(x) else x for x in got] == [None, None, 2.0, 3.0, None, None, None, 6.0]
    assert exponential_average([-1.0, -2.0], 2, any_sign=True)[1] == -1.5


def test_frames_over_batches_and_instruments(spark):
    """Rows of many instruments that straddle Arrow batches, with nulls: as Spark's own windows have them."""
    calls = {"s": "sum(p) OVER w3", "n": "count(p) OVER w3", "m": "min(p) OVER before20", "d": "stddev_samp(p) OVER w3", "x": "regr_sxy(p, v) OVER w4", "b": "lag(p, 2) OVER w"}
    rows = spark.range(0, 900).selectExpr("'D' AS isin", "'X' AS exchange", "CAST(id % 7 * id % 11 AS STRING) AS code", "date_add(DATE '2026-01-01', CAST(id AS INT)) AS trade_date", "CASE WHEN id % 13 <> 0 THEN CAST(id * 37 % 101 AS DOUBLE) END AS p", "CAST(id * 17 % 29 AS DOUBLE) AS v")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        got = with_calls(in_order(rows), calls).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    full = {"s": ("p IS NOT NULL", "w3", 3), "m": ("p IS NOT NULL", "before20", 20), "d": ("p IS NOT NULL", "w3", 3), "x": ("p IS NOT NULL", "w4", 4)}
    text = ", ".join(f"CASE WHEN count(CASE WHEN {full[n][0]} THEN 1 END) OVER {full[n][1]} = {full[n][2]} THEN {c} END AS {n}" if n in full else f"{c} AS {n}" for n, c in calls.items())
    want = spark.sql(f"SELECT *, {text} FROM {{rows}} {window_clause()}", rows=rows).collect()
    named = lambda rs: {r.trade_date: [r[n] for n in calls] for r in rs}
    got, want = named(got), named(want)
    assert got.keys() == want.keys() and len(got) == 900
    for day, values in want.items():
        assert got[day] == [v if v is None else pytest.approx(v, abs=1e-9) for v in values]
