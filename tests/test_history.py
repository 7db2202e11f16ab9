import datetime

import pytest
from pyspark.sql import functions as F

from tapewright.history_queries import QUERIES
from tapewright.operators import history as H
from tapewright.sources.scratch import tasks_for

DAY = datetime.date
ID = "isin string, exchange string, code string"
EVENT = f"{ID}, event_date date, event_key string, status string"


def events(spark, *rows):
    return spark.createDataFrame([(i, "X", "A", d and DAY(2026, 1, d), k, s) for i, d, k, s in rows], EVENT)


def starts(spark, **of):
    return spark.createDataFrame([(i, "X", "A", d and DAY(2026, 1, d)) for i, d in of.items()], f"{ID}, start date")


def states(df):
    return {(r.isin, r.event_key): r.status for r in df.collect()}


def test_windows_per_instrument(spark):
    previous = events(spark, ("1", 1, "old", "active"), ("1", 10, "gone", "active"), ("1", None, "dateless", "active"), ("2", 1, "early", "active"), ("3", 20, "untouched", "active"), ("4", 1, "whole", "active"))
    current = events(spark, ("1", 5, "edge", "active"), ("1", 5, "edge", "active"), ("2", 12, "new", "active"))
    window = starts(spark, **{"1": 5, "2": 10, "4": None})
    want = {("1", "old"): "active", ("1", "gone"): "retracted", ("1", "dateless"): "retracted", ("1", "edge"): "active", ("2", "early"): "active", ("2", "new"): "active", ("3", "untouched"): "active", ("4", "whole"): "retracted"}
    assert states(H.reconcile_action_windows(previous, current, window)) == want
    assert tuple(H.action_window_counts(previous, current, window).first()) == (2, 3, 0, 3)
    moved = events(spark, ("1", 10, "is", "active"))
    assert tuple(H.action_window_counts(previous, moved, starts(spark, **{"1": 5})).first()) == (1, 2, 1, 1)


def test_snapshot_keeps_tombstones(spark):
    previous = events(spark, ("1", 1, "dead", "retracted"), ("1", 2, "was", "active"), ("1", 3, "back", "retracted"), ("2", 1, "before", "active"), ("2", 9, "inside", "retracted"))
    current = events(spark, ("1", 3, "back", "active"))
    got = states(H.replace_action_windows(previous, current, starts(spark, **{"1": None, "2": 5})))
    assert got == {("1", "dead"): "retracted", ("1", "back"): "active", ("2", "before"): "active"}
    assert H.active(previous).count() + H.retracted(previous).count() == 5


def test_repairs_fail_closed(spark):
    schema = "k string, v int"
    gold, raw = spark.createDataFrame([("a", 1)], schema), spark.createDataFrame([("b", 2), ("b", 2), ("c", 3), ("c", 4), ("d", None)], schema)
    asked = lambda *k: spark.createDataFrame([(x,) for x in k], "k string")
    assert {(r.k, r.v) for r in H.repaired(gold, raw, asked("b", "d"), ["k"]).collect()} == {("a", 1), ("b", 2), ("d", None)}
    for bad in ("c", "missing"):
        with pytest.raises(Exception, match="missing, ambiguous"):
            H.repaired(gold, raw, asked(bad), ["k"]).collect()
    with pytest.raises(Exception, match="already there"):
        H.repaired(gold.union(spark.createDataFrame([("b", 1)], schema)), raw, asked("b"), ["k"]).collect()


def test_folds_cover_exactly(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 3.0)], "k int, x double")
    fold = lambda *f: spark.createDataFrame(list(f), "k int, split string")
    assert {r.k: r.split for r in H.split_rows(rows, fold((1, "train"), (2, "test")), ["k"]).collect()} == {1: "train", 2: "test"}
    for bad in (fold((1, "train")), fold((1, "train"), (2, "test"), (3, "test")), fold((1, "train"), (2, "test"), (2, "train")), fold((1, "test"), (2, "test"))):
        with pytest.raises(Exception, match="cover the rows"):
            H.split_rows(rows, bad, ["k"]).collect()
    assert H.source_fingerprint(rows, ["k"], ["x"]).first() == H.source_fingerprint(rows.orderBy(F.desc("k")), ["k"], ["x"]).first()


def test_folds_stay_where_their_rows_were_dealt(spark, tmp_path):
    """The number of partitions follows the rows, and neither the join with a fold nor a raw merge makes fewer."""
    path = f"file://{tmp_path}/rows"
    spark.range(1000).selectExpr("id AS k").write.parquet(path)
    held = spark.read.parquet(path)
    assert tasks_for(held, 100) == 10 and tasks_for(held) == 4
    rows = held.repartition(tasks_for(held, 100), "k").distinct()
    fold = rows.withColumn("split", F.when(F.col("k") % 2 == 0, "train").otherwise("test"))
    split = H.split_rows(rows, fold, ["k"])
    assert split.rdd.getNumPartitions() == 10 and split.count() == 1000
    old = spark.range(50).selectExpr("'I' AS isin", "'X' AS exchange", "'C' AS code", "date_add(DATE '2026-01-01', CAST(id AS INT)) AS date", "0 AS seq")
    merged = H.merge_bronze_quotes(old, old.withColumn("seq", F.lit(1)).filter("day(date) > 15"), "seq", 9)
    assert merged.rdd.getNumPartitions() == 9 and merged.count() == 50 and merged.filter("seq = 1 AND day(date) > 15").count() == merged.filter("day(date) > 15").count()


def test_bronze_rows(spark):
    schema = f"{ID}, date date, price int, seq int"
    row = lambda c, d, p, n: ("I", "X", c, d and DAY(2026, 1, d), p, n)
    stored, incoming = (spark.createDataFrame(r, schema) for r in ([row("A", 1, 1, 9), row("A", 2, 1, 9), row("B", 1, 1, 9)], [row("A", 2, 2, 1), row("A", 2, 3, 2), row("A", None, 5, 3)]))
    assert {(r.code, r.date.day, r.price) for r in H.merge_bronze_quotes(stored, incoming, "seq").collect()} == {("A", 1, 1), ("A", 2, 3), ("B", 1, 1)}
    assert {(r.code, r.price) for r in H.replace_bronze_actions(stored, incoming).collect()} == {("A", 2), ("A", 3), ("A", 5), ("B", 1)}
    assert H.bronze_dedup(stored.union(stored), stored.withColumn("note", F.lit(None).cast("string"))).count() == 3
    raw = spark.createDataFrame([(None, " ", "Fund"), ("A", "X", None), (None, " ", "Fund")], "Code string, Exchange string, Type string")
    got = H.listing_partitions(raw).collect()
    assert got[0].symbol == got[2].symbol and got[0].symbol.startswith("unidentified-") and len(got[0].symbol) == 29 and got[0].partition_exchange == "unknown"
    assert (got[1].symbol, got[1].partition_exchange, got[1].partition_type) == ("A", "X", "unknown")


def test_orders(spark):
    quotes = spark.createDataFrame([("2", "X", "B", DAY(2026, 1, 1), 1), ("1", "X", "A", DAY(2026, 1, 2), 2), ("1", "X", "A", DAY(2026, 1, 2), 1), ("1", "W", "Z", DAY(2026, 1, 9), 1)], f"{ID}, trade_date date, close int")
    assert [(r.exchange, r.code, r.close) for r in H.snapshot_sorted(quotes).collect()] == [("W", "Z", 1), ("X", "A", 1), ("X", "A", 2), ("X", "B", 1)]
    acts = events(spark, ("1", 2, "b", "active"), ("1", 1, "z", "active"), ("1", 2, "a", "active"))
    assert [r.event_key for r in H.actions_sorted(acts).collect()] == ["z", "a", "b"]
    assert [r.event_key for r in H.keys_sorted(acts, ["event_key"]).collect()] == ["a", "b", "z"]
    assert sorted((r.code, r.close, r.position) for r in H.positions(quotes, ["code"], ["trade_date"]).collect()) == [("A", 1, 1), ("A", 2, 2), ("B", 1, 1), ("Z", 1, 1)]


def test_decisions_and_sidecars(spark):
    rows, tomb = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), events(spark, ("1", 1, "a", "retracted"), ("1", 1, "b", "retracted"))
    from tapewright.operators.reconcile import fingerprint

    state = fingerprint(rows, []).withColumn("serving_count", F.lit(2))
    assert H.noop_decision(rows, state, rows).first().noop and not H.noop_decision(rows, state, rows.limit(1)).first().noop
    assert not H.noop_decision(rows.withColumn("v", F.lit(1)), state, rows).first().noop
    assert H.sidecar_state(tomb).first().valid
    assert not H.sidecar_state(tomb.union(tomb)).first().valid and not H.sidecar_state(tomb.withColumn("status", F.lit("active"))).first().valid
    assert tuple(H.state_counts(tomb.union(events(spark, ("1", 1, "c", "active")))).first()) == (3, 1)


def test_checks(spark):
    listings = spark.createDataFrame([("1", "X", "A", True)], f"{ID}, is_active boolean")
    child = spark.createDataFrame([("1", "X", "A"), ("9", "X", "A")], ID)
    assert H.require_parents(child.limit(1), listings).count() == 1
    with pytest.raises(Exception, match="9"):
        H.require_parents(child, listings).collect()
    assert not H.deactivated(listings, child.filter("isin = '9'")).first().is_active and H.deactivated(listings, child).first().is_active
    assert H.key_integrity(child.union(child), ["isin"]).first()["unique"] is False and H.repeated_keys(child, ["code"]).first().n == 2
    back = spark.createDataFrame([("1", "2.50"), ("2", "x")], "K string, value string")
    assert tuple(H.round_trip_differences(spark.createDataFrame([("1", 2.5), ("2", None)], "k string, value double"), back, ["k"]).first()) == (1, 1)
    with pytest.raises(Exception):
        H.payload_rows(spark.createDataFrame([("{",)], "payload_json string"), "k int").collect()


def test_nested_round_trip_of_repeated_lines(spark, tmp_path):
    """The query takes all the columns it reads from the dealt lines; a key that comes twice counts once."""
    rows = [(1, 1, 10, 5.0), (1, 1, 7, 9.0), (3, 2, 8, 1.0), (9, 2, 8, 2.0), (40, 3, 1, 0.0)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r.l_orderkey, r.l_linenumber): (r.n, r.expected, r.actual, r.same) for r in QUERIES["nested_round_trip"](spark, str(tmp_path)).collect()}
    assert got == {(k, n): (1, True, True, all((k + n) % x for x in (5, 7, 11, 13, 17))) for k, n, _, _ in rows}
