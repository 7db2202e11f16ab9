import datetime
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tapewright.sources.lake import orphaned_paths, publish, quarantined_keys, read_dataset, read_manifest, remove_orphans, safe_part, shared_paths, verify
from tapewright.streaming import overlap
from tapewright.streaming.overlap import publish_stream

AT = datetime.datetime(2026, 9, 1)
SCHEMA = "isin string, exchange string, code string, trade_date date, close int"


def rows(spark, *values):
    return spark.createDataFrame([("I" + c, "X", c, datetime.date(2026, 8, d), p) for c, d, p in values], SCHEMA)


def test_publish_reuse_and_orphans(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    first = rows(spark, ("A", 1, 1), ("A", 2, 2), ("B", 1, 3))
    assert read_dataset(spark, root, first.schema).count() == 0
    assert publish(first, root, ["exchange", "code"], AT) == 2
    assert publish(first, root, ["exchange", "code"], AT) == 0
    changed = rows(spark, ("A", 1, 1), ("A", 2, 9), ("B", 1, 3))
    assert publish(changed, root, ["exchange", "code"], AT) == 1
    assert sorted(read_dataset(spark, root, first.schema).collect()) == sorted(changed.collect())
    assert publish(rows(spark, ("B", 1, 3)), root, ["exchange", "code"], AT) == 0
    assert read_dataset(spark, root, first.schema).count() == 1
    assert all(r.valid for r in verify(spark, root, first.schema).collect())
    disk = spark.createDataFrame([(r.path,) for r in read_manifest(spark, root).collect()] + [("data/old",)], "path string")
    assert [r.path for r in orphaned_paths(read_manifest(spark, root), disk).collect()] == ["data/old"]


def test_an_unfinished_manifest_is_not_seen(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    first = rows(spark, ("A", 1, 1))
    publish(first, root, ["code"], AT)
    os.makedirs(tmp_path / "lake/manifests/0000000002")
    assert read_dataset(spark, root, first.schema).collect() == first.collect()


def test_tampering_is_found(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    publish(rows(spark, ("A", 1, 1), ("B", 1, 3)), root, ["code"], AT)
    path = read_manifest(spark, root).filter("partition = 'code=A'").first().path
    shutil.rmtree(tmp_path / "lake" / path)
    rows(spark, ("A", 1, 2)).write.parquet(f"{root}/{path}")
    assert {r.partition: r.valid for r in verify(spark, root, spark.createDataFrame([], SCHEMA).schema).collect()} == {"code=A": False, "code=B": True}


def test_odd_partition_values_stay_apart(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    first = rows(spark, ("A/B", 1, 1), ("A_B", 1, 2), ("null", 1, 3), ("..", 1, 4), ("ü%", 1, 5)).union(rows(spark, ("x", 1, 6)).withColumn("code", F.lit(None).cast("string")))
    assert publish(first, root, ["code"], AT) == 6
    assert sorted(map(str, read_dataset(spark, root, first.schema).collect())) == sorted(map(str, first.collect()))
    assert shared_paths(read_manifest(spark, root)).count() == 0 and all(r.valid for r in verify(spark, root, first.schema).collect())


def test_partial_publish_and_orphan_removal(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    publish(rows(spark, ("A", 1, 1), ("B", 1, 3), ("C", 1, 4)), root, ["code"], AT)
    assert publish(rows(spark, ("B", 1, 9)), root, ["code"], AT, partial=True) == 1
    state = read_dataset(spark, root, spark.createDataFrame([], SCHEMA).schema)
    assert {r.code: r.close for r in state.collect()} == {"A": 1, "B": 9, "C": 4}
    only = spark.createDataFrame([("code=B",)], "partition string")
    assert {r.code for r in read_dataset(spark, root, state.schema, only).collect()} == {"B"}
    assert len(remove_orphans(spark, root)) == 1 and remove_orphans(spark, root) == []
    assert {r.code: r.close for r in read_dataset(spark, root, state.schema).collect()} == {"A": 1, "B": 9, "C": 4}


def test_manifest_paths_stay_below_root(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/lake"
    publish(rows(spark, ("A", 1, 1)), root, ["code"], AT)
    bad = read_manifest(spark, root).withColumn("path", F.lit("data/../../secret"))
    monkeypatch.setattr("tapewright.sources.lake.read_manifest", lambda *_: bad)
    with pytest.raises(ValueError, match="folder name"):
        read_dataset(spark, root, spark.createDataFrame([], SCHEMA).schema)


def test_stream_first_rows_within_the_watermark(spark, tmp_path):
    """Of the rows of one instrument and date that come within the delay, the first stays."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = f"{SCHEMA}, event_time timestamp"
    for k, (hour, price) in enumerate(((1, 1), (2, 2), (5, 3))):
        spark.createDataFrame([("IA", "X", "A", datetime.date(2026, 8, 1), price, datetime.datetime(2026, 9, 1, hour))], schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    overlap.deduplicated(stream).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).option("path", out).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_folder_names():
    assert safe_part("A.B-1") == "A.B-1"
    for bad in ("", "..", "a/b", "a\\b", "a\0"):
        with pytest.raises(ValueError):
            safe_part(bad)


def test_quarantine_log(spark):
    line = "2026-09-01 10:00:0{} WARNING quarantined quote isin=I exchange=X code=A date=2026-08-0{}"
    lines = spark.createDataFrame([(line.format(1, 1),), (line.format(2, 1),), (line.format(9, 2),), ("INFO fine",)], "value string")
    assert [r.trade_date.day for r in quarantined_keys(lines, "2026-09-01 10:00:00", "2026-09-01 10:00:05").collect()] == [1]
    with pytest.raises(Exception, match="can't be read"):
        quarantined_keys(spark.createDataFrame([("quarantined, but how",)], "value string"), "2026-01-01", "2027-01-01").collect()


def test_stream_replaces_late_rows(spark, tmp_path):
    root, source = f"file://{tmp_path}/lake", str(tmp_path / "in")
    schema = f"{SCHEMA}, event_time timestamp"
    batch = lambda *v: spark.createDataFrame([("I" + c, "X", c, datetime.date(2026, 8, d), p, datetime.datetime(2026, 9, 1, h)) for c, d, p, h in v], schema)
    columns = SCHEMA.replace(" string", "").replace(" date", "").replace(" int", "").split(", ")
    for rows_ in (batch(("A", 1, 1, 1), ("A", 2, 2, 1)), batch(("A", 2, 7, 3), ("A", 2, 6, 2), ("B", 1, 5, 1))):
        rows_.coalesce(1).write.mode("append").parquet(source)
        publish_stream(spark.readStream.schema(schema).parquet(source), root, str(tmp_path / "check"), columns, AT).awaitTermination()
    got = {(r.code, r.trade_date.day): r.close for r in read_dataset(spark, root, spark.createDataFrame([], SCHEMA).schema).collect()}
    assert got == {("A", 1): 1, ("A", 2): 7, ("B", 1): 5}
