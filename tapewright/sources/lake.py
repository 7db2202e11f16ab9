"""A Parquet lake of partitions named by content, published by one manifest write.

A partition's folder bears its fingerprint, so an unchanged one is neither rewritten nor reread. The manifest lists the
folders that make up the dataset; readers open only those. Writing the next manifest is the commit: before it, readers
see the old state, whatever has failed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import row_digest
from ..operators.reconcile import fingerprint

MANIFEST = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("published_at_utc", T.TimestampType()), T.StructField("partition", T.StringType()),
    T.StructField("path", T.StringType()), T.StructField("row_count", T.LongType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("schema", T.StringType()), T.StructField("batches", T.MapType(T.StringType(), T.LongType())),
])
FOLDER = r"(data/[0-9a-f]+/_folder=[0-9a-f]+)/[^/]+$"
#: A folder with more rows is written by several tasks.
FOLDER_ROWS = 1_000_000


def safe_part(value: str) -> str:
    """A value as one folder name; it can't lead out of the folder above."""
    if not value or value in (".", "..") or re.search(r"[/\\\x00]", value):
        raise ValueError(f"not a folder name: {value!r}")
    return value


def _versions(spark: SparkSession, root: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifests")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName()) for p in done)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete manifest; without one, no rows."""
    versions = _versions(spark, root)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{versions[-1]:010d}") if versions else spark.createDataFrame([], MANIFEST)


def _guarded(root: str, path: str) -> str:
    """A manifest's path below root; one that leads elsewhere is an error."""
    return "/".join([root, *map(safe_part, path.split("/"))])


def partition_label(by: Sequence[str]) -> Column:
    """Names a row's partition, differently for different values: odd characters are percent-encoded, null is %null."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit("%null"))) for c in by])


def folder_tasks(spark: SparkSession, folders: int, rows: int) -> int:
    """Into how many tasks to deal the writing of so many folders. A file takes its task some milliseconds whatever it holds, so folders count beside rows."""
    return max(1, -(-rows // 500_000), -(-folders // 500), min(spark.sparkContext.defaultParallelism, -(-folders // 20)))


def _to_read(listed: DataFrame, root: str) -> list[str]:
    """The paths of the listed folders. Where they are all that a publication's folder holds, its path stands for them, so a large dataset has few paths."""
    spark = listed.sparkSession
    top = F.substring_index("path", "/", 2)  # data and the publication
    many = listed.groupBy(top.alias("top")).agg(F.countDistinct("path").alias("n")).filter("n > 32")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    whole = [r["top"] for r in many.toLocalIterator() if len(fs.globStatus(path(path(_guarded(root, r["top"])), "_folder=*"))) == r["n"]]
    single = listed.filter(~top.isin(whole)) if whole else listed
    return sorted(_guarded(root, x) for x in [*whole, *(r["path"] for r in single.select("path").toLocalIterator())])


def _meets(listed: DataFrame, schema: T.StructType, where: Column | str) -> DataFrame:
    """The listed partitions whose values, spelled in their names and typed as in schema, satisfy where; those named by columns that can't settle it stay."""
    naming = F.array_sort(F.transform(F.split("partition", "/"), lambda x: F.substring_index(x, "=", 1)))
    names = [r["names"] for r in listed.select(naming.alias("names")).distinct().collect()]  # one row for each set of columns
    kinds = {f.name: f.dataType for f in schema}
    spelled = F.str_to_map("partition", F.lit("/"), F.lit("="))
    met, unsettled, refused = [], [], None
    for by in names:
        text = {c: F.try_element_at(spelled, F.lit(c)) for c in by}
        values = [F.when(text[c] != "%null", F.url_decode(text[c])).cast(kinds.get(c, T.StringType())).alias(c) for c in by]
        alike = listed.filter(naming == F.array(*map(F.lit, by)))
        try:
            met.append(alike.select(F.struct(*listed.columns).alias("_listed"), *values).filter(where).select("_listed.*"))
        except AnalysisException as e:
            unsettled.append(alike)
            refused = e
    if refused and not met:
        raise refused
    return reduce(DataFrame.union, met + unsettled) if names else listed


def read_dataset(spark: SparkSession, root: str, schema: T.StructType, only: DataFrame | None = None, where: Column | str | None = None) -> DataFrame:
    """The rows of the folders that the manifest lists, and of no others. only: a table of the partitions to read.

    where: a condition on the columns that partitions are made by, such as "isin = 'A' AND month >= '2024-01'". The manifest
    settles it, so the scan's plan names the folders of matching partitions only; the rows have to meet it too. Conditions on
    other columns belong in a filter of the result, which the Parquet scan takes on, as it does the choice of columns.
    """
    listed = read_manifest(spark, root)
    listed = listed if only is None else listed.join(only.select("partition"), "partition", "left_semi")
    listed = listed if where is None else _meets(listed, schema, where)
    paths = _to_read(listed, root)
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows if where is None else rows.filter(where)


def footer_counts(spark: SparkSession, root: str) -> DataFrame:
    """path and file_rows of each data folder on disk, from the files' footers: no column is read."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    if not top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top):
        return spark.createDataFrame([], "path string, file_rows long")
    files = spark.read.schema(T.StructType()).option("recursiveFileLookup", True).parquet(f"{root}/data").select("_metadata.file_path")
    by_file = files.groupBy("file_path").agg(F.count("*").alias("n"))
    return by_file.groupBy(F.regexp_extract("file_path", FOLDER, 1).alias("path")).agg(F.sum("n").alias("file_rows"))


def last_batch(spark: SparkSession, root: str, stream: str) -> int | None:
    """The number of the last batch of that stream that the newest manifest holds."""
    row = read_manifest(spark, root).agg(F.max(F.try_element_at("batches", F.lit(stream))).alias("n")).first()
    return row["n"] if row else None


def publish(
    rows: DataFrame, root: str, by: Sequence[str], published_at: datetime, partial: bool = False, replaces: DataFrame | None = None, batch: tuple[str, int] | None = None
) -> int:
    """Makes rows the dataset's new state, by partitions of the `by` columns. Returns how many partitions were written.

    partial: only the partitions that rows have get a new state, and those that `replaces` (partition) names; a named one
    without rows goes, all others stay. A partition is reused if its fingerprint (names and values of all columns), its row
    count and its columns' types are as listed and its files, by their footers, hold as many rows; so a lost file or a
    changed type is written again. batch: a stream's name and a batch number; a batch that the manifest holds already
    publishes nothing and returns 0.
    """
    spark = rows.sparkSession
    if batch and (done := last_batch(spark, root, batch[0])) is not None and done >= batch[1]:
        return 0
    types = rows.schema.simpleString()
    named = rows.withColumn("_partition", partition_label(by))
    now = fingerprint(named, ["_partition"]).withColumnRenamed("_partition", "partition")
    listed = read_manifest(spark, root)
    versions = _versions(spark, root)
    version, staging = (versions[-1] if versions else 0) + 1, f"data/{uuid.uuid4().hex}"
    plan_path = f"{root}/plans/{uuid.uuid4().hex}"
    now.write.parquet(plan_path)  # one row per partition: the rows are fingerprinted once
    now = spark.read.schema(now.schema).parquet(plan_path)
    old = listed.filter(F.col("schema") == types).select("partition", "fingerprint", "row_count", F.col("path").alias("old_path"))
    alike = now.join(old, ["partition", "fingerprint", "row_count"])
    if alike.isEmpty():  # no footer has to be read
        plan = now.withColumn("old_path", F.lit(None).cast("string"))
    else:
        there = footer_counts(spark, root).withColumnsRenamed({"path": "old_path", "file_rows": "row_count"})
        plan = now.join(alike.join(there, ["old_path", "row_count"]).select("partition", "old_path"), "partition", "left")
    plan = plan.withColumn("same", F.col("old_path").isNotNull())
    plan.write.parquet(f"{plan_path}-kept")
    plan = spark.read.schema(plan.schema).parquet(f"{plan_path}-kept")
    changed = plan.filter("NOT same").select(F.col("partition").alias("_partition"), F.ceil(F.col("row_count") / FOLDER_ROWS).alias("_parts"))
    todo = named.join(changed, "_partition").withColumn("_folder", F.sha2("_partition", 256))
    todo = todo.withColumn("_part", F.when(F.col("_parts") > 1, F.crc32(row_digest(rows.columns)) % F.col("_parts")).otherwise(0))
    n = plan.filter("NOT same").agg(F.count("*").alias("folders"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")).first()
    dealt = todo.repartition(folder_tasks(spark, n["folders"], n["rows"]), "_folder", "_part")
    dealt.drop("_partition", "_parts", "_part").write.partitionBy("_folder").option("compression", "zstd").parquet(f"{root}/{staging}")
    folder = F.concat(F.lit(f"{staging}/_folder="), F.sha2("partition", 256))
    manifest = plan.select("partition", F.when(F.col("same"), F.col("old_path")).otherwise(folder).alias("path"), "row_count", "fingerprint", F.lit(types).alias("schema"))
    if partial:
        gone = now.select("partition") if replaces is None else now.select("partition").union(replaces.select("partition"))
        manifest = manifest.unionByName(listed.select(*manifest.columns).join(gone, "partition", "left_anti"))
    seen = dict(held[0]) if (held := listed.select("batches").filter("batches IS NOT NULL").first()) else {}
    seen |= dict([batch]) if batch else {}
    batches = F.create_map(*[x for k, v in sorted(seen.items()) for x in (F.lit(k), F.lit(v).cast("long"))]) if seen else F.lit(None)
    manifest = manifest.select(F.lit(version).cast("long").alias("version"), F.lit(published_at).alias("published_at_utc"), *manifest.columns, batches.cast("map<string,bigint>").alias("batches"))
    manifest.coalesce(1).write.option("compression", "zstd").parquet(f"{root}/manifests/{version:010d}")
    for where in map(spark._jvm.org.apache.hadoop.fs.Path, (plan_path, f"{plan_path}-kept")):
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return n["folders"]


def verify(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """One row per listed partition: whether its rows still have the manifest's count and fingerprint. One job reads all folders."""
    listed = read_manifest(spark, root)
    paths = _to_read(listed, root)
    if not paths:
        return spark.createDataFrame([], "partition string, valid boolean")
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
    placed = rows.select("*", F.regexp_extract(F.col("_metadata.file_path"), FOLDER, 1).alias("path"))
    found = fingerprint(placed, ["path"]).select("path", F.col("row_count").alias("_rows"), F.col("fingerprint").alias("_print"))
    valid = F.coalesce((F.col("row_count") == F.col("_rows")) & (F.col("fingerprint") == F.col("_print")), F.lit(False))
    return listed.join(found, "path", "left").select("partition", valid.alias("valid"))


def remove_orphans(spark: SparkSession, root: str) -> list[str]:
    """Removes the folders below data/ that the newest manifest doesn't name, and returns them. To be called once it is out, with no writer or older reader at work."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    top = fs_path(f"{root}/data")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    on_disk = [f"data/{w.getPath().getName()}/{f.getPath().getName()}" for w in fs.listStatus(top) for f in fs.listStatus(w.getPath()) if f.isDirectory()]
    named = {r["path"] for r in read_manifest(spark, root).select("path").toLocalIterator()}
    gone = sorted(set(on_disk) - named)
    for path in gone:
        fs.delete(fs_path(_guarded(root, path)), True)
    return gone


def orphaned_paths(listed: DataFrame, on_disk: DataFrame) -> DataFrame:
    """Folders on disk that no manifest row names; they may go once the manifest is out."""
    return on_disk.select("path").distinct().join(listed.select("path"), "path", "left_anti")


def shared_paths(listed: DataFrame) -> DataFrame:
    """Folders that manifest rows of several partitions name, with their number; each must have one owner."""
    return listed.groupBy("path").agg(F.countDistinct("partition").alias("owners")).filter("owners > 1")


LOG_LINE = r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d) .*quarantined .*isin=(\S+) exchange=(\S+) code=(\S+) date=(\d{4}-\d\d-\d\d)"


def quarantined_keys(lines: DataFrame, start: str, end: str, column: str = "value") -> DataFrame:
    """The distinct keys of quarantine lines in a time window. A line that says quarantined but can't be parsed is an error."""
    said = lines.filter(F.col(column).contains("quarantined"))
    at = F.regexp_extract(column, LOG_LINE, 1)
    parts = said.select(F.when(at == "", F.raise_error(F.lit("a quarantine line can't be read")).cast("timestamp")).otherwise(F.try_to_timestamp(at)).alias("at"), *[F.regexp_extract(column, LOG_LINE, n).alias(c) for n, c in ((2, "isin"), (3, "exchange"), (4, "code"), (5, "trade_date"))])
    return parts.filter(F.col("at").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))).select("isin", "exchange", "code", F.to_date("trade_date").alias("trade_date")).distinct()
