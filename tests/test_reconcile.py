import datetime
import decimal
import json
import random

import pytest
from pyspark.sql import functions as F

from tapewright.functions.canonical import canonical_decimal, canonical_json, next_business_day
from tapewright.operators.normalize import normalize_dividends, normalize_listings, normalize_quotes, normalize_splits, violations
from tapewright.operators.reconcile import action_counts, changed_instruments, difference, digests, distinct_or_error, fetched_at, fingerprint, merge_lifecycle, missing_rows, mutation_counts, reconcile_actions, replace_quote_window, upserted
from tapewright.operators.standardize import fold_statistics, standardize

DAY = datetime.date
ID = "isin string, exchange string, code string"


def quotes_raw(spark, **fields):
    row = {"date": "2026-08-21", "open": "9.0", "high": "11.0", "low": "8.5", "close": "10.0", "adjusted_close": "10.0", "volume": "100"} | fields
    return spark.createDataFrame([("I", "X", "A", *row.values())], f"{ID}, " + ", ".join(f"{k} string" for k in row))


def test_listings(spark):
    raw = spark.createDataFrame([("a", "xetra", " de1 ", None), ("b", "xetra", "", "de2"), ("c", "xetra", None, "  ")], "Code string, Exchange string, ISIN string, Isin2 string").withColumnRenamed("Isin2", "Other")
    got = normalize_listings(raw, True).collect()
    assert [(r.isin, r.exchange, r.code, r.is_active) for r in got] == [("DE1", "XETRA", "a", True)]
    with pytest.raises(Exception, match="no code"):
        normalize_listings(spark.createDataFrame([("", "X", "DE1")], "Code string, Exchange string, ISIN string"), True).collect()


def test_quotes(spark):
    r = normalize_quotes(quotes_raw(spark, open="", low="-3")).first()
    assert r.open is None and r.low == decimal.Decimal(-3) and r.volume == 100 and r.trade_date == DAY(2026, 8, 21)
    for bad in ({"volume": "1.5"}, {"volume": "-1"}, {"close": "NaN"}, {"close": "Infinity"}, {"high": "true"}):
        with pytest.raises(Exception, match="not valid"):
            normalize_quotes(quotes_raw(spark, **bad)).collect()


def test_dividends_and_splits(spark):
    raw = spark.createDataFrame([("I", "X", "A", "2026-01-01", "1.25", "EUR", "", "2025-12-01")], f"{ID}, date string, value string, currency string, period string, declarationDate string")
    r = normalize_dividends(raw).first()
    assert r.period is None and r.declaration_date == DAY(2025, 12, 1) and r.payment_date is None and len(r.event_key) == 64
    splits = spark.createDataFrame([("I", "X", "A", "2026-01-01", s) for s in ("3:2", "1:3", "odd")], f"{ID}, date string, split string")
    assert [x.split_factor for x in normalize_splits(splits).orderBy("split_ratio").collect()] == ["0.3333333333333333333333333333", "1.5", None]
    with pytest.raises(Exception):
        normalize_splits(spark.createDataFrame([("I", "X", "A", "2026-01-01", "0:2")], f"{ID}, date string, split string")).collect()


def test_canonical_values(spark):
    rows = spark.createDataFrame([("1.50",), ("-0.000",), ("100",), ("0.000000000000000001",), ("-12.3400",)], "x string")
    got = [r[0] for r in rows.select(canonical_decimal(F.col("x").cast("decimal(38,18)"))).collect()]
    assert got == ["1.5", "0", "100", "0.000000000000000001", "-12.34"]
    days = spark.createDataFrame([(DAY(2026, 10, 22),), (DAY(2026, 10, 23),), (DAY(2026, 10, 24),), (DAY(2026, 10, 25),)], "d date")
    assert [r[0].day for r in days.select(next_business_day(F.col("d"))).collect()] == [23, 26, 26, 26]


def test_lifecycle_and_duplicates(spark):
    schema = f"{ID}, name string, is_active boolean"
    row = lambda i, n: (i, "X", "A", n, True)
    active, delisted, previous = (spark.createDataFrame(r, schema) for r in ([row("1", "a")], [row("1", "d"), row("2", "d")], [row("1", "p"), row("2", "p"), row("3", "p")]))
    got = {r.isin: (r.name, r.is_active) for r in merge_lifecycle(active, delisted, previous).collect()}
    assert got == {"1": ("a", True), "2": ("d", False), "3": ("p", False)}
    assert distinct_or_error(active.union(active), ["isin"]).count() == 1
    with pytest.raises(Exception, match="conflicting rows"):
        distinct_or_error(active.union(delisted), ["isin"]).collect()


def test_difference_and_upsert(spark):
    schema = "k string, v int, fetched_at_utc int"
    current = spark.createDataFrame([("same", 1, 10), ("changed", 1, 10), ("gone", 1, 10), ("null", None, 10)], schema)
    desired = spark.createDataFrame([("same", 1, 20), ("changed", 2, 20), ("new", 1, 20), ("null", None, 20)], schema)
    assert {(r.k, r.op) for r in difference(desired, current, ["k"]).collect()} == {("changed", "update"), ("new", "insert"), ("gone", "delete")}
    assert {r.k: r.fetched_at_utc for r in upserted(desired, current, ["k"]).collect()} == {"same": 10, "null": 10, "changed": 20, "new": 20}
    assert difference(desired, desired, ["k"]).count() == 0 and missing_rows(desired, current).first().missing == 4


def test_quote_window(spark):
    schema = f"{ID}, trade_date date, close int"
    row = lambda i, d, c: (i, "X", "A", DAY(2026, 8, d), c)
    previous = spark.createDataFrame([row("1", 1, 1), row("1", 14, 1), row("1", 21, 1), row("2", 1, 1), row("3", 1, 1)], schema)
    refreshed = spark.createDataFrame([row("1", 21, 2), row("2", 2, 2)], schema)
    last = spark.createDataFrame([("1", "X", "A", DAY(2026, 8, 21))], f"{ID}, last_date date")
    got = {(r.isin, r.trade_date.day, r.close) for r in replace_quote_window(previous, refreshed, last).collect()}
    assert got == {("1", 1, 1), ("1", 21, 2), ("2", 2, 2), ("3", 1, 1)}  # the window's first day is fetched again


def events(spark, *rows):
    return spark.createDataFrame([("I", "X", "A", DAY(2026, 1, d), k, "active") for d, k in rows], f"{ID}, event_date date, event_key string, status string")


def test_actions(spark):
    previous, current = events(spark, (1, "old"), (10, "was"), (11, "gone"), (12, "stays")), events(spark, (10, "is"), (12, "stays"), (12, "stays"))
    start = F.lit("2026-01-05").cast("date")
    merged = reconcile_actions(previous, current, start)
    assert {(r.event_key, r.status) for r in merged.collect()} == {("old", "active"), ("is", "active"), ("stays", "active"), ("was", "retracted"), ("gone", "retracted")}
    assert tuple(action_counts(previous, current, start).first()) == (1, 2, 1, 1)
    assert changed_instruments(previous, merged).count() == 1 and changed_instruments(previous, previous).count() == 0
    again = reconcile_actions(merged, events(spark, (11, "gone")), start)
    assert ("gone", "active") in {(r.event_key, r.status) for r in again.collect()}


def test_digests_and_fingerprints(spark):
    rows = spark.createDataFrame([("1", 5, 1), ("2", None, 1)], "k string, v int, fetched_at_utc int")
    later = rows.withColumn("fetched_at_utc", F.lit(9))
    assert sorted(digests(rows, ["k"]).collect()) == sorted(digests(later, ["k"]).collect())
    one = fingerprint(rows, []).first()
    assert one == fingerprint(later.orderBy(F.desc("k")), []).first()
    assert one.fingerprint != fingerprint(rows.withColumn("v", F.lit(6)), []).first().fingerprint
    assert digests(rows, ["k"]).first().entity_key == '["1"]'


def test_violations(spark):
    rows = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    assert {r.rule: r.n for r in violations(rows, {"positive": F.col("v") > 0}).collect()} == {"positive": 1}


def test_standardize(spark):
    rows = spark.createDataFrame([(1, "train", 1.0, 4.0), (2, "train", 3.0, 4.0), (3, "validation", 9.0, 5.0), (4, "test", 11.0, None)], "k int, split string, x double, flat double")
    stats = fold_statistics(rows, ["x", "flat"]).first()
    assert (stats.x_mean, stats.x_std, stats.x_count) == (2.0, 1.0, 2)
    got = {r.k: (r.x, r.flat) for r in standardize(rows, ["x", "flat"]).collect()}
    assert got == {1: (-1.0, None), 2: (1.0, None), 3: (7.0, None), 4: (9.0, None)}
    with pytest.raises(Exception, match="not finite"):
        standardize(rows.withColumn("x", F.when(F.col("k") == 4, float("inf")).otherwise(F.col("x"))), ["x"]).collect()


def test_equal_values_do_not_vary_in_any_partitions(spark):
    """The mean of 49 fours, merged from a partition, isn't 4.0."""
    rows = spark.range(0, 99, 1, 2).select("id", F.lit("train").alias("split"), F.lit(4.0).alias("flat"), F.lit(float("nan")).alias("bad"))
    stats = fold_statistics(rows, ["flat"]).first()
    assert (stats.flat_std, stats.flat_zero_variance) == (0.0, True)
    assert [r.flat for r in standardize(rows, ["flat"]).select("flat").distinct().collect()] == [None]
    with pytest.raises(Exception, match="not finite"):
        standardize(rows, ["bad"]).collect()


def test_control_characters_in_json(spark):
    """All 32, and text that only looks like an escape, are written as Python writes them."""
    texts = [chr(c) for c in range(32)] + ["\x0b\x0b\x1f", "\\u000B", "\\\x0b", "\\\\u001A", "a\x7f\u2028"]
    rows = spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "t string, k int")
    got = {r.k: r.j for r in rows.select("k", canonical_json(["t"]).alias("j")).collect()}
    assert got == {k: json.dumps({"t": t}, ensure_ascii=False, separators=(",", ":")) for k, t in enumerate(texts)}


def test_fetch_times_equal_brute_force(spark):
    rng = random.Random(8)
    day = lambda k: datetime.date(2026, 1, 1) + datetime.timedelta(k)
    schema = "isin string, exchange string, code string"
    for _ in range(3):
        wins = [(rng.choice("AB"), "X", "c", day(s := rng.randrange(60)), day(s + rng.randrange(-1, 25)), k) for k in range(rng.randrange(25))] + [("A", "X", "c", None, day(9), 99), (None, "X", "c", day(0), day(90), 98)]
        rows = [(rng.choice("ABC"), "X", "c", day(rng.randrange(-5, 90)), k) for k in range(120)] + [("A", "X", "c", None, 0), (None, "X", "c", day(3), 0)]
        found = fetched_at(spark.createDataFrame(rows, schema + ", trade_date date, v int"), spark.createDataFrame(wins, schema + ", start_date date, end_date date, at int"), F.lit(-1))
        best = lambda r: min(((s, e, a) for i, _, _, s, e, a in wins if None not in (i, s, r[0], r[3]) and i == r[0] and s <= r[3] <= e), default=(0, 0, -1))[2]
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((*r, best(r))) for r in rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_mutation_counts(spark):
    a = spark.createDataFrame([(1, "active", 1), (2, "retracted", 1), (3, "retracted", 1), (4, "retracted", 2), (5, "active", 1), (6, "active", 2)], "k int, status string, v int")
    b = spark.createDataFrame([(1, "active", 1), (2, "active", 1), (4, "retracted", 1), (6, "active", 1), (7, "active", 1)], "k int, status string, v int")
    assert tuple(mutation_counts(a, b, ["k"], "status").first()) == (1, 2, 1, 2, 6)
    assert tuple(mutation_counts(a, b, ["k"]).first()) == (2, 3, 1, 0, 6)
    assert tuple(mutation_counts(a.limit(0), b.limit(0), ["k"]).first()) == (0, 0, 0, 0, 0)


def test_missing_rows_by_values_and_by_text(spark):
    """Columns of exact types are counted by their values, with nulls and repeats; others by their JSON."""
    for kind in ("int", "double"):
        a = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (None, None), (2, "y")], "n int, t string").withColumn("n", F.col("n").cast(kind))
        b = spark.createDataFrame([("x", 1), (None, None), ("null", None), ("y", 3)], "t string, n int").withColumn("n", F.col("n").cast(kind))
        found = missing_rows(a, b)
        assert found.first().missing == 3
        assert ("to_json" in found._jdf.queryExecution().analyzed().toString()) == (kind == "double")
