"""Reading a part of the lake: what the manifest settles, against the same condition on the rows."""

import datetime
import re
import shutil

import pytest
from pyspark.sql import functions as F

from tapewright.sources.lake import publish, read_dataset, read_manifest

AT = datetime.datetime(2026, 9, 1)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Rows in partitions of text, whole numbers, dates and flags, nulls and odd characters among them."""
    root = f"file://{tmp_path_factory.mktemp('lake')}/lake"
    rows = spark.sql("""SELECT CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'a/b c' WHEN 2 THEN 'ü%+=' WHEN 3 THEN '%null' ELSE concat('I', id % 7) END AS isin, CAST(nullif(id % 3, 2) - 1 AS INT) AS k,
        CASE WHEN id % 5 > 1 THEN date_add(DATE '2024-01-30', CAST(id % 5 AS INT)) END AS day, id % 2 = 0 AS even, id AS v, CASE WHEN id % 6 = 0 THEN double('NaN') ELSE double(id) END AS x FROM range(420)""")
    publish(rows, root, ["isin", "k", "day", "even"], AT)
    return root, rows


def same(got, want):
    return sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def opened(df):
    """The folders that the plan of a scan names."""
    return {re.search(r"data/[0-9a-f]+/_folder=[0-9a-f]+", path).group() for path in df.inputFiles()}


@pytest.mark.parametrize(
    "where",
    [
        "isin = 'I4'", "isin = 'a/b c'", "isin = 'ü%+='", "isin = '%null'", "isin <=> NULL", "NOT isin <=> 'I4'", "isin IS NULL", "isin IN ('I4', 'ü%+=')", "isin NOT IN ('I4', 'I5')", "isin NOT IN ('I4', NULL)",
        "isin LIKE 'I%'", "NOT isin LIKE '%c'", "isin > 'I4'", "k = -1", "k <> 0", "NOT k >= 0", "k IN (0, NULL)", "day > DATE '2024-02-01' AND k = 0", "day IS NULL AND isin = 'I5'",
        "isin = 'I4' OR k = 0", "even", "NOT even AND year(day) = 2024", "upper(isin) = 'I5' AND length(isin) > k", "isin = 'no such'",
    ],
)
def test_a_condition_reads_its_partitions_only(spark, lake, where):
    root, rows = lake
    got, want = read_dataset(spark, root, rows.schema, where=where), rows.filter(where)
    assert same(got, want)
    assert len(opened(got)) == want.select("isin", "k", "day", "even").distinct().count()


def test_scans_of_one_lake_do_not_touch_each_other(spark, lake):
    root, rows = lake
    whole = read_dataset(spark, root, rows.schema)
    a, b = (read_dataset(spark, root, rows.schema, where=F.col("isin") == c) for c in ("I4", "I5"))
    assert same(a.union(b), rows.filter("isin IN ('I4', 'I5')")) and same(whole, rows)
    assert same(a.join(b, "k").select(a.v, b.v), rows.filter("isin = 'I4'").alias("a").join(rows.filter("isin = 'I5'").alias("b"), "k").select("a.v", "b.v"))


def test_other_columns_are_left_to_the_scan(spark, lake, capsys):
    root, rows = lake
    with pytest.raises(Exception, match="(?i)v.*cannot be resolved"):
        read_dataset(spark, root, rows.schema, where="v > 7").collect()
    part = read_dataset(spark, root, rows.schema, where="isin = 'I4'").filter("v > 200 AND x > 0").select("v")
    assert same(part, rows.filter("isin = 'I4' AND v > 200 AND x > 0").select("v"))
    part.explain("formatted")
    plan = capsys.readouterr().out
    scan = plan[plan.index("PushedFilters"):]
    assert "GreaterThan(v,200)" in scan and re.search(r"ReadSchema: struct<isin:string,v:bigint,x:double>", plan) and "Exchange" not in plan


def test_an_instrument_is_read_with_the_others_gone(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    rows = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "code string, v int")
    assert read_dataset(spark, root, rows.schema, where="code = 'A'").collect() == []  # nothing published yet
    publish(rows, root, ["code"], AT)
    shutil.rmtree(tmp_path / "lake" / read_manifest(spark, root).filter("partition = 'code=B'").first().path)
    assert sorted(r.v for r in read_dataset(spark, root, rows.schema, where="code = 'A'").collect()) == [1, 2]
    only = spark.createDataFrame([("code=A",), ("code=B",)], "partition string")
    assert read_dataset(spark, root, rows.schema, only, "code < 'B' AND code > 'A'").collect() == []


def test_partitions_named_by_other_columns_are_kept(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    rows = spark.createDataFrame([("A", 1), ("B", 2)], "code string, v int")
    publish(rows, root, ["code"], AT)
    more = spark.createDataFrame([("A", 5), ("B", 6)], "code string, v int")
    publish(more, root, ["v"], AT, partial=True)
    for where in ("code = 'A'", "code = 'B'"):
        assert same(read_dataset(spark, root, rows.schema, where=where), rows.union(more).filter(where))
