"""Folders for what a query writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); a session in one process gets one of its own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        found = "file://" + tempfile.mkdtemp(prefix="tapewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def written(rows: DataFrame, what: str) -> DataFrame:
    """The rows, written once: for rows that several branches or jobs read, or whose order is sampled first."""
    path = scratch_path(rows.sparkSession, what)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def tasks_for(rows: DataFrame, most: int = 500_000) -> int:
    """Into how many partitions to deal stored rows so that each gets about so many, the session's number at least. The count reads footers only."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // most))
