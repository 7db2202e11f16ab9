"""Sinks: what is written again and what stays, by paths and footers; batches that come twice."""

import datetime
import glob
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapewright.operators.history import gold_artifacts
from tapewright.sources.lake import footer_counts, last_batch, publish, read_dataset, read_manifest
from tapewright.sources.sinks import _files, _place, gold_files, sink_gold, sink_raw_actions, sink_raw_listings, sink_raw_quotes
from tapewright.streaming.overlap import publish_stream

AT, DAY = datetime.datetime(2026, 9, 1), datetime.date(2026, 9, 1)
RAW = "isin string, exchange string, code string, date string, close int, seq int"


def raw(spark, *rows):
    return spark.createDataFrame([("I" + c, "X", c, d, p, n) for c, d, p, n in rows], RAW)


def paths(spark, root):
    return {r.partition: r.path for r in read_manifest(spark, root).collect()}


def test_raw_quotes_merge_by_month(spark, tmp_path):
    root = f"file://{tmp_path}/raw"
    assert sink_raw_quotes(raw(spark, ("A", "2026-01-05", 1, 0), ("A", "2026-02-05", 2, 0), ("B", "2026-01-05", 3, 0), ("B", None, 9, 0)), root, AT, "seq") == 3
    old = paths(spark, root)
    assert sink_raw_quotes(raw(spark, ("A", "2026-02-05", 5, 1), ("A", "2026-02-05", 4, 2), ("A", "2026-02-06", 6, 1), ("B", "2026-01-05", 3, 0)), root, AT, "seq") == 1
    new = paths(spark, root)
    assert {k for k in new if new[k] != old[k]} == {"isin=IA/exchange=X/code=A/month=2026-02"} and new.keys() == old.keys()
    held = read_dataset(spark, root, spark.createDataFrame([], RAW + ", month string").schema)
    assert sorted((r.code, r.date, r.close) for r in held.collect()) == [("A", "2026-01-05", 1), ("A", "2026-02-05", 4), ("A", "2026-02-06", 6), ("B", "2026-01-05", 3)]
    assert sink_raw_quotes(raw(spark), root, AT, "seq") == 0 and paths(spark, root) == new


def test_raw_actions_drop_stale_months(spark, tmp_path):
    root = f"file://{tmp_path}/raw"
    ids = lambda *c: raw(spark, *[(x, None, 0, 0) for x in c])
    first = raw(spark, ("A", "2026-01-05", 1, 0), ("A", "2026-02-05", 2, 0), ("B", "2026-01-05", 3, 0), ("C", None, 4, 0))
    sink_raw_actions(first, ids("A", "B", "C"), root, AT, DAY)
    old = paths(spark, root)
    assert "isin=IC/exchange=X/code=C/month=2026-09" in old
    assert sink_raw_actions(raw(spark, ("A", "2026-01-05", 1, 0)), ids("A", "C"), root, AT, DAY) == 0
    assert paths(spark, root) == {k: v for k, v in old.items() if "month=2026-01" in k}
    with pytest.raises(Exception, match="not refreshed"):
        sink_raw_actions(raw(spark, ("B", "2026-01-05", 1, 0)), ids("A"), root, AT, DAY)


def test_raw_listings(spark, tmp_path):
    root = f"file://{tmp_path}/raw"
    listing = lambda *rows: spark.createDataFrame(rows, "Code string, Exchange string, Type string, Name string")
    assert sink_raw_listings(listing(("A", "X", "ETF", "a"), (None, None, None, "b")), root, AT, DAY) == 2
    assert sink_raw_listings(listing(("A", "X", "ETF", "changed"), ("B", "X", "ETF", "c")), root, AT, DAY, skip_existing=True) == 1
    assert sink_raw_listings(listing(("A", "X", "ETF", "changed")), root, AT, DAY) == 1
    assert len(paths(spark, root)) == 3


def test_lost_files_and_changed_types_are_written_again(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    rows = raw(spark, ("A", "x", 1, 0), ("B", "x", 2, 0), ("C", "x", 3, 0), ("C", "y", 3, 0))
    assert publish(rows, root, ["code"], AT) == 3 and publish(rows, root, ["code"], AT) == 0
    assert {r.file_rows for r in footer_counts(spark, root).collect()} == {1, 2}
    plan = footer_counts(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    (lost,) = glob.glob(str(tmp_path / "lake" / paths(spark, root)["code=B"] / "*.parquet"))
    os.remove(lost)
    assert publish(rows, root, ["code"], AT) == 1
    wide = rows.withColumn("close", F.col("close").cast("long"))
    assert publish(wide, root, ["code"], AT) == 3 and publish(wide, root, ["code"], AT) == 0
    assert read_dataset(spark, root, wide.schema).count() == 4


def test_a_batch_is_published_once(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    rows = raw(spark, ("A", "x", 1, 0))
    assert last_batch(spark, root, "s") is None
    assert publish(rows, root, ["code"], AT, batch=("s", 3)) == 1
    other = raw(spark, ("A", "x", 2, 0))
    assert publish(other, root, ["code"], AT, batch=("s", 3)) == 0 and publish(other, root, ["code"], AT, batch=("s", 2)) == 0
    assert read_dataset(spark, root, rows.schema).first().close == 1 and len(os.listdir(tmp_path / "lake/manifests")) == 1
    assert publish(other, root, ["code"], AT, batch=("t", 0)) == 1 and last_batch(spark, root, "s") == 3
    assert publish(rows, root, ["code"], AT, batch=("s", 4)) == 1 and last_batch(spark, root, "t") == 0


def test_a_stream_that_repeats_its_last_batch(spark, tmp_path):
    """The checkpoint loses its last commit, as after a crash between publishing and committing."""
    root, source, check = f"file://{tmp_path}/lake", str(tmp_path / "in"), tmp_path / "check"
    schema = "isin string, exchange string, code string, trade_date date, close int, event_time timestamp"
    spark.createDataFrame([("IA", "X", "A", DAY, 1, AT)], schema).write.parquet(source)
    run = lambda: publish_stream(spark.readStream.schema(schema).parquet(source), root, str(check), ["isin", "exchange", "code", "trade_date", "close"]).awaitTermination()
    run()
    for name in glob.glob(str(check / "commits" / "*")) + glob.glob(str(check / "commits" / ".*crc")):
        os.remove(name)
    run()
    assert len(os.listdir(tmp_path / "lake/manifests")) == 1 and last_batch(spark, root, str(check)) == 0


def test_many_small_partitions_are_written_by_several_tasks_and_read_by_few_paths(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    rows = spark.range(100).select(F.concat(F.lit("P"), "id").alias("code"), F.col("id").alias("v"))
    assert publish(rows, root, ["code"], AT) == 100
    assert len({p.split("part-")[1][:5] for p in glob.glob(str(tmp_path / "lake/data/*/*/*.parquet"))}) > 1  # one task for a hundred files before
    held = read_dataset(spark, root, rows.schema)
    assert "1 paths" in held._jdf.queryExecution().executedPlan().toString() and sorted(r.v for r in held.collect()) == list(range(100))
    assert publish(rows.filter("v = 7").withColumn("v", F.lit(-7).cast("long")), root, ["code"], AT, partial=True) == 1
    held = read_dataset(spark, root, rows.schema)  # a folder of the first publication is out of date: the others by themselves
    assert "100 paths" in held._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.v for r in held.collect()) == sorted({*range(100), -7} - {7})


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tapewright.sources.lake.FOLDER_ROWS", 100)
    root, rows = f"file://{tmp_path}/lake", spark.range(1000).withColumn("code", F.lit("A"))
    monkeypatch.setattr("tapewright.sources.lake.folder_tasks", lambda *_: 8)
    assert publish(rows, root, ["code"], AT) == 1
    assert len(glob.glob(str(tmp_path / "lake/data/*/*/*.parquet"))) > 1 and read_dataset(spark, root, rows.schema).distinct().count() == 1000
    assert publish(rows, root, ["code"], AT) == 0


def test_gold_files_are_written_once(spark, tmp_path):
    root = f"file://{tmp_path}/gold"
    rows = spark.createDataFrame([("I1", "X", "A b+c/%", 1), ("I1", "X", "A b+c/%", 2), ("I2", "X/Y", "B", 3)], "isin string, exchange string, code string, v int")
    names = lambda: {os.path.relpath(p, tmp_path): os.stat(p).st_mtime_ns for p in glob.glob(str(tmp_path / "gold/*/*.parquet"))}
    assert [r.written for r in sink_gold(rows, root, "h").collect()] == [True, True]
    first = names()
    assert len(first) == 2 and all("_GOLD_h_" in n for n in first)
    assert [r.written for r in sink_gold(rows, root, "h").collect()] == [False, False] and names() == first
    assert {r.code: r.written for r in sink_gold(rows.filter("v < 3").union(rows.limit(0)).union(spark.createDataFrame([("I2", "X/Y", "B", 4)], rows.schema)), root, "h").collect()} == {"A b+c/%": False, "B": True}
    assert len(names()) == 3 and sorted(r.v for r in spark.read.option("recursiveFileLookup", True).parquet(root).collect()) == [1, 2, 3, 4]
    with pytest.raises(Exception, match="no exchange or code"):
        sink_gold(rows.withColumn("code", F.lit(" ")), root, "h")


def test_gold_footers_are_counted_by_path_before_names_are_made(spark, tmp_path):
    root = f"file://{tmp_path}/gold"
    rows = spark.createDataFrame([("X", "_A", 1), ("X", "_A", 2), ("Y", "B", 3)], "exchange string, code string, v int")
    sink_gold(rows, root, "h")
    counted = _files(spark, root)
    assert "HashAggregate(keys=[file_path" in counted._jdf.queryExecution().executedPlan().toString()  # names are made once a file, not once a row
    assert [(r.file.split("_GOLD")[0], r.file_rows) for r in counted.collect()] == [("exchange=Y/B", 1)]
    assert {r.code: r.written for r in sink_gold(rows, root, "h").collect()} == {"_A": True, "B": False}  # a listing leaves out _A; it is put in its own place
    assert len(glob.glob(str(tmp_path / "gold/*/*.parquet"))) == 2


def test_gold_names_are_those_of_gold_artifacts(spark, tmp_path):
    """One pass in a task hashes what the grouped form does, with repeated rows, batches that cut instruments, and odd names."""
    root = f"file://{tmp_path}/a%20b/gold"
    code = F.concat(F.element_at(F.array(*map(F.lit, ("A", "ü~b", "x+y z", "a/b%*", "q'(!)"))), (F.col("id") % 5 + 1).cast("int")), F.lit(" "), F.col("id") % 3)
    rows = spark.range(700).select(F.lit("X Y").alias("exchange"), code.alias("code"), F.concat(F.lit("I"), F.col("id") % 4).alias("isin"), (F.col("id") % 90).alias("v"), F.expr("IF(id % 7 = 0, NULL, id % 3 / 4)").alias("w"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        made = sink_gold(rows, root, "h 1")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    name = lambda c: F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    want = gold_artifacts(rows, "h 1").withColumn("file", F.concat(F.lit("exchange="), name("exchange"), F.lit("/"), name("file")))
    columns = ["exchange", "code", "row_count", "source_hash", "file"]
    assert sorted(made.select(columns).collect()) == sorted(want.select(columns).collect())
    assert {os.path.relpath(x, tmp_path / "a%20b/gold") for x in glob.glob(f"{tmp_path}/a[%]20b/gold/*/*")} == {r.file for r in want.collect()}
    held = spark.read.option("recursiveFileLookup", True).parquet(root)
    assert held.dtypes == rows.dtypes and sorted(held.collect(), key=str) == sorted(rows.collect(), key=str)
    assert sorted((r.exchange, r.code, f"exchange=X%20Y/{r.file_name}") for r in gold_files(spark, root).collect()) == sorted((r.exchange, r.code, r.file) for r in want.collect())


def test_a_broken_gold_file_is_written_again(spark, tmp_path):
    root = f"file://{tmp_path}/gold"
    rows = spark.createDataFrame([("X", "A", 1), ("X", "B", 2), ("X", "C", 3)], "exchange string, code string, v int")
    files = {r.code: tmp_path / "gold" / r.file for r in sink_gold(rows, root, "h").collect()}
    files["A"].write_bytes(files["A"].read_bytes()[:-9])  # an error before, when all footers were read
    files["B"].unlink()
    assert {r.code: r.written for r in sink_gold(rows, root, "h").collect()} == {"A": True, "B": True, "C": False}
    assert sorted(r.v for r in spark.read.option("recursiveFileLookup", True).parquet(root).collect()) == [1, 2, 3]
    assert not glob.glob(f"{tmp_path}/gold-staging-*/data")


def test_placing_gold_files_goes_on_where_a_lost_task_stopped(spark, tmp_path):
    root = f"file://{tmp_path}/gold"
    rows = spark.createDataFrame([("X", "A", 1), ("X", "B", 2)], "exchange string, code string, v int")
    a, b = (r.file for r in sink_gold(rows, root, "h").orderBy("code").collect())
    (tmp_path / "gold" / b).rename(tmp_path / "staged-b")
    todo = pa.RecordBatch.from_pylist([{"file": f, "row_count": 1, "_replaces": False, "_staged": f"{tmp_path}/staged-{k}"} for f, k in ((a, "a"), (b, "b"))])
    list(_place(iter([todo]), root))  # a is in place already
    assert (tmp_path / "gold" / a).exists() and (tmp_path / "gold" / b).exists()
    (tmp_path / "gold" / a).unlink()
    with pytest.raises(FileNotFoundError):
        list(_place(iter([todo]), root))
