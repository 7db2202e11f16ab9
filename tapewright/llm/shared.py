"""Helpers that several corpus operators share: tables, intermediate storage, digests, hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every operator's words and line keys: blank, tab, \n, \v, \f, \r.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_MAP = {ord(c): ord(c) + 32 for c in UPPER}


#: An input of fewer bytes for each core is dealt out to all cores. Larger ones are split by Spark and never shuffled for this.
SMALL_PART = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table; a small one, which one file of one row group would give to one task, is dealt out to all cores."""
    path, cores = f"{sf_dir}/{name}.parquet", spark.sparkContext.defaultParallelism
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()
    rows = spark.read.parquet(path)
    return rows.repartition(cores) if size < cores * SMALL_PART else rows


def work_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Where it is unset, a session in one process gets a new one; a cluster gets an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors and the driver share")
        found = "file://" + tempfile.mkdtemp(prefix="tapewright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{work_dir(spark)}/{what}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write a result that several jobs read to the shared folder, and read it back.

    A lost executor then costs a re-read, not a recomputation of the whole lineage.
    """
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Removes the folder of a materialized result that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clash(carry: Sequence[str], id_col: str, made: Sequence[str]) -> None:
    """An error for carried columns that are named as the id or as a column that the operator makes (in any case)."""
    taken = {c.lower() for c in (id_col, *made)}
    if found := sorted(c for c in carry if c.lower() in taken):
        raise ValueError(f"carried columns are named as the result's own: {', '.join(found)}")


def sha256_hex(col) -> F.Column:
    return F.sha2(col.cast("binary"), 256)


def mix64(x: np.ndarray) -> np.ndarray:
    """An invertible 64-bit finalizer (xor-shift and multiply), applied to each element."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def slices(batch: pa.RecordBatch, text_at: int, most: int = 4_000_000, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that a piece's texts hold at most so many bytes, or one text, and so many rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        to = min(to, at + rows) if rows else to
        yield batch.slice(at, to - at)
        at = to
