import json

import pytest

from tapewright.sources.legacy import json_manifest, json_rows, newest_version, union_rows


def test_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"Code": "A", "n": 1}, {"Code": "B"}], indent=1))
    assert [(r.Code, r.n) for r in json_rows(spark, str(tmp_path / "a.json"), "Code string, n int").orderBy("Code").collect()] == [("A", 1), ("B", None)]
    (tmp_path / "bad.json").write_text('[{"Code": ')
    with pytest.raises(Exception):
        json_rows(spark, str(tmp_path / "bad.json"), "Code string").collect()


def test_json_manifests(spark, tmp_path):
    write = lambda *paths: (tmp_path / "m.json").write_text(json.dumps({"version": 1, "artifacts": [{"path": p, "row_count": 2} for p in paths]}))
    write("data/a.parquet", "b.parquet")
    assert [tuple(r) for r in json_manifest(spark, str(tmp_path / "m.json")).orderBy("path").collect()] == [("b.parquet", 2), ("data/a.parquet", 2)]
    for bad in ("../x", "/etc/x", "a/../../x", "a//b", ""):
        write(bad)
        with pytest.raises(Exception, match="not a path"):
            json_manifest(spark, str(tmp_path / "m.json")).collect()


def test_versions_and_unions(spark, tmp_path):
    root = f"{tmp_path}/v"
    assert newest_version(spark, root, "x int").collect() == []
    for n in (2, 10):
        spark.createDataFrame([(n,)], "x int").write.parquet(f"{root}/version={n}")
    assert [r.x for r in newest_version(spark, root, "x int").collect()] == [10]
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/u")
    got = union_rows(spark, [f"{root}/version=2", f"{tmp_path}/u"]).orderBy("x").collect()
    assert [(r.x, r.y) for r in got] == [(1, "a"), (2, None)]
