"""The stateful stream against the batch difference, with late and repeated rows."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from tapewright.operators.reconcile import difference, latest_per
from tapewright.streaming.corrections import PROVIDER, corrections

KEYS = ["isin", "exchange", "code", "trade_date"]
SCHEMA = "isin string, exchange string, code string, trade_date date, close int, event_time timestamp"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


@pytest.mark.parametrize("keep_ms", [None, 86_400_000])
def test_stream_equals_batch_difference(rocks, tmp_path, keep_ms):
    spark, rng = rocks, random.Random(6)
    at = lambda h: datetime.datetime(2026, 9, 1) + datetime.timedelta(hours=h)
    quote = lambda k, price, h: (f"I{k}", "X", "A", datetime.date(2026, 8, 1), price, at(h))
    first = [quote(k, k, 1) for k in range(12)]
    second = [quote(k, rng.choice([k, k + 100]), 2) for k in range(6, 18)]
    second += [second[0], quote(0, 55, 0), quote(1, 1, 0), quote(20, 1, 2), quote(20, 2, 3)]  # a repeat, a late row, a late repeat, an insert that is corrected
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    told, empty = [], []

    def note(df, number):
        (told if (x := [tuple(r) for r in df.select("isin", "kind", "meaning").collect()]) else empty).append(x)

    for rows in (first, second):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = corrections(stream, ["close"], keep_ms).writeStream.foreachBatch(note)
        query, expected = query.option("checkpointLocation", out).outputMode("update"), len(told) + 1
        if keep_ms is None:
            query.trigger(availableNow=True).start().awaitTermination()
            continue
        running, end = query.start(), time.time() + 90  # it runs on, as states may expire at any time
        while len(told) < expected and time.time() < end and running.isActive:
            time.sleep(0.2)
        seen = len(empty)  # the next batch begins when the last one is committed
        while len(empty) <= seen and time.time() < end and running.isActive:
            time.sleep(0.2)
        running.stop()
    assert sorted(told[0]) == sorted((f"I{k}", "insert", f'{{"close":{k}}}') for k in range(12))
    kinds = sorted((i, k) for i, k, _ in told[1])
    assert [x for x in kinds if x[1] == "late"] == [("I0", "late")]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    newest = latest_per(frame(first + second), KEYS, [F.desc("event_time"), F.desc("close")]).drop("event_time")
    ops = {"insert": "insert", "update": "correction"}
    want = {(r.isin, ops[r.op]) for r in difference(newest, frame(first).drop("event_time"), KEYS).collect()}
    assert {x for x in kinds if x[1] != "late"} - {("I20", "correction")} == want and ("I20", "correction") in kinds
