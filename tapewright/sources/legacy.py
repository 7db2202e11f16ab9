"""Readers of older layouts: JSON arrays, JSON manifests, versioned folders, files whose columns differ."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lake import safe_part


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of JSON files that hold one array each (or one object); a missing field is null, a file that isn't such JSON an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_manifest(spark: SparkSession, path: str) -> DataFrame:
    """path and row_count of each artifact of JSON manifests; a path that leads out of their folder is an error."""
    listed = json_rows(spark, path, "artifacts array<struct<path: string, row_count: long>>").select(F.inline("artifacts"))
    odd = F.col("path").isNull() | F.col("path").rlike(r"(^|[/\\])\.{0,2}([/\\]|$)")
    return listed.withColumn("path", F.when(odd, F.raise_error(F.concat(F.lit("not a path below the manifest: "), F.coalesce("path", F.lit("null")))).cast("string")).otherwise(F.col("path")))


def newest_version(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of the folder version=N below root with the largest N; none without one."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
    found = [(int(m[1]), n) for n in names if (m := re.fullmatch(r"version=(\d+)", n))]
    return spark.read.schema(schema).parquet(f"{root}/{safe_part(max(found)[1])}") if found else spark.createDataFrame([], schema)


def union_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The rows of Parquet files whose columns differ, under all their columns; what a file lacks is null."""
    return spark.read.option("mergeSchema", True).parquet(*sorted(paths))
