"""Order checks over files, and fingerprints that depend on the order, against plain Python."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tapewright.operators import ordering
from tapewright.operators import ordering
from tapewright.operators.ordering import enveloped_fingerprint, fingerprint_ranges, order_state, ordered_fingerprint, read_sidecar, require_sorted, sorted_by

SCHEMA = "a string, b int, v int"


def stored(spark, path, *files):
    """One file for each list of rows, in this order of their names."""
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/f{k}")
    return spark.read.option("recursiveFileLookup", True).parquet(str(path))


def state(df, keys=("a", "b")):
    r = order_state(df, list(keys)).first()
    return r.row_count, r.falls, r["ties"], r.sorted, r.unique


def plain_state(files):
    rows = [(x[0] is not None, x[0] or "", x[1] is not None, x[1] or 0) for f in files for x in f]
    falls, ties = sum(y < x for x, y in zip(rows, rows[1:])), sum(y == x for x, y in zip(rows, rows[1:]))
    return len(rows), falls, ties, falls == 0, ties == 0


def test_order_state_equals_plain(spark, tmp_path):
    rng = random.Random(4)
    for case in range(4):
        rows = [(rng.choice([None, "", "a", "b", "é"]), rng.choice([None, 0, 1, 2]), 0) for _ in range(60)]
        if case % 2:
            rows.sort(key=lambda x: (x[0] is not None, x[0] or "", x[1] is not None, x[1] or 0))
        files = [rows[:1], rows[1:25], rows[25:]]
        df = stored(spark, tmp_path / str(case), *files)
        assert state(df) == plain_state(files)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        try:
            assert state(df) == plain_state(files)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sorted_files_are_not_sorted_again(spark, tmp_path):
    df = stored(spark, tmp_path / "s", [("a", 1, 0), ("a", 2, 0)], [("b", 1, 0), ("b", 3, 0)])
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(sorted_by(df, ["a", "b"])) and "Exchange" not in plan(ordering.order_runs(df, ["a", "b"]))
    assert "Exchange" in plan(sorted_by(df, ["b", "a"]))
    assert [r.b for r in sorted_by(df, ["b", "a"]).collect()] == [1, 1, 2, 3]
    assert state(spark.createDataFrame([], SCHEMA)) == (0, 0, 0, True, True)
    assert state(spark.range(9).selectExpr("cast(null as string) a", "cast(id as int) b", "0 v").repartitionByRange(3, "b").sortWithinPartitions("b")) == (9, 0, 0, True, True)


def test_swapped_rows_and_sidecars_are_refused(spark, tmp_path):
    good, swapped, twice = ([("a", 1, 0), ("b", 2, 0), ("c", 3, 0)], [("a", 1, 0), ("c", 3, 0), ("b", 2, 0)], [("a", 1, 0), ("a", 1, 1)])
    frames = [stored(spark, tmp_path / str(k), f) for k, f in enumerate((good, swapped, twice))]
    assert require_sorted(frames[0], ["a", "b"]).count() == 3
    for df in frames[1:]:
        with pytest.raises(Exception, match="not in the order of a, b"):
            require_sorted(df, ["a", "b"]).collect()
    assert require_sorted(frames[2], ["a", "b"], unique=False).count() == 2
    side = lambda name, *rows: spark.createDataFrame(rows, "event_key string, status string").coalesce(1).write.parquet(str(tmp_path / name))
    side("ok", ("a", "retracted"), ("b", "retracted"))
    side("order", ("b", "retracted"), ("a", "retracted"))
    side("alive", ("a", "retracted"), ("b", "active"))
    read = lambda name: read_sidecar(spark, str(tmp_path / name), "event_key string, status string", ["event_key"]).collect()
    assert len(read("ok")) == 2
    for name, message in (("order", "not in the order"), ("alive", "not retracted")):
        with pytest.raises(Exception, match=message):
            read(name)


def plain_link(items, mark):
    """items: (first, last, n, d) in their order."""
    out = []
    for first, last, n, d in items:
        if not out or d.startswith(mark):
            out.append([first, last, 0, []])
        out[-1][1], out[-1][2] = last, out[-1][2] + n
        out[-1][3].append(d)
    return [(f, la, n, hashlib.sha256("".join(ds).encode()).hexdigest()) for f, la, n, ds in out]


@pytest.mark.parametrize("mark", ["0", "00", "zz"])
def test_ordered_fingerprint_equals_plain(spark, monkeypatch, mark):
    monkeypatch.setattr(ordering, "RANGE_MARK", mark)
    rows = [(f"k{k % 7}", k, k * k % 11) for k in range(700)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    digest = lambda a, b, v: hashlib.sha256(f'tapewright:row:v1\n{{"a":"{a}","b":{b},"v":{v}}}'.encode()).hexdigest()
    items = [(f'["{a}","{b}"]',) * 2 + (1, digest(a, b, v)) for a, b, v in sorted(rows)]
    ranges = plain_link(items, mark)
    assert sorted(map(tuple, fingerprint_ranges(df, ["a", "b"]).collect())) == sorted(ranges)
    want = hashlib.sha256(",".join(d for *_, d in plain_link(ranges, mark)).encode()).hexdigest()
    got = ordered_fingerprint(df, ["a", "b"]).first()
    assert (got.row_count, got.fingerprint) == (700, want)


def test_order_and_tombstones_change_the_fingerprint(spark):
    rows = spark.createDataFrame([(f"k{k}", k, k) for k in range(30)], SCHEMA)
    gone = spark.createDataFrame([("x", 1, 0), ("y", 2, 0)], SCHEMA)
    print_ = lambda a, r: enveloped_fingerprint(a, r, ["b"], ["a"]).first().fingerprint
    first = print_(rows, gone)
    assert print_(rows.repartition(5), gone.orderBy(F.desc("a"))) == first
    assert print_(rows, gone.withColumn("a", F.concat("a", F.lit("z")))) != first
    assert print_(rows, gone.limit(1)) != first and print_(rows.filter("b > 0"), gone) != first
    place = F.when(F.col("b") == 3, 4).when(F.col("b") == 4, 3).otherwise(F.col("b"))
    values = lambda df: ordered_fingerprint(df, ["place"], ["a", "v"]).first().fingerprint
    assert values(rows.withColumn("place", F.col("b"))) != values(rows.withColumn("place", place))  # the same rows, two of them swapped
    with pytest.raises(Exception, match="unique keys"):
        ordered_fingerprint(rows.union(rows), ["b"]).collect()
    assert ordered_fingerprint(rows.limit(0), ["b"]).first().row_count == 0


def test_rows_are_dealt_and_sorted_before_their_digests(spark):
    """The sample that ranges are cut by, and the shuffle, hold the rows' own columns and no key or digest."""
    rows = spark.range(100).selectExpr("id AS k", "id % 7 AS v", "id AS other")
    plan = ordering._rows_of(rows, ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    assert "sha2" in above and "sha2" not in below and "to_json" not in below and "other" not in below.splitlines()[1]
