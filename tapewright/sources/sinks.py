"""Sinks of the raw and the feature layers: monthly raw partitions, raw listings, one content-named file per instrument."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from datetime import date, datetime
from hashlib import sha256
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import row_digest
from ..operators.frames import places, whole_instruments
from ..operators.history import listing_partitions, merge_bronze_quotes
from ..operators.normalize import IDENTITY
from .lake import folder_tasks, partition_label, publish, read_dataset, read_manifest, safe_part
from .scratch import tasks_for

RAW_BY = (*IDENTITY, "month")
GOLD_BY = ("exchange", "code")
LISTING_BY = ("partition_exchange", "partition_type", "symbol", "timeframe", "month")


def _month(day: Column, otherwise: date | None) -> Column:
    """yyyy-mm of a date or of text that begins like one; that of `otherwise` where there is none."""
    text = F.substring(day.cast("string"), 1, 7)
    return F.coalesce(F.when(text.rlike(r"^\d{4}-\d\d$"), text), F.lit(otherwise.strftime("%Y-%m") if otherwise else None))


def _labels(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.select(partition_label(by).alias("partition")).distinct()


def sink_raw_quotes(incoming: DataFrame, root: str, published_at: datetime, order: str) -> int:
    """Lays raw quotes over the stored ones, by instrument and month; the last of `order` wins for one date. Returns the months written.

    Only months that incoming rows have are read, and of these only changed ones are written; all other files stay in the
    manifest with their paths. Rows without a date go.
    """
    new = incoming.filter("date IS NOT NULL").withColumn("month", _month(F.col("date"), None))
    stored = read_dataset(incoming.sparkSession, root, new.schema, _labels(new, RAW_BY))
    return publish(merge_bronze_quotes(stored, new, order), root, RAW_BY, published_at, partial=True)


def sink_raw_actions(incoming: DataFrame, refreshed: DataFrame, root: str, published_at: datetime, as_of: date) -> int:
    """Replaces the raw events of the refreshed instruments whole: months that they no longer have leave the manifest.

    refreshed: the identities that were fetched, with or without events. Events without a date lie in the month of as_of.
    Incoming events of other instruments are an error when they are written.
    """
    spark, keys = incoming.sparkSession, refreshed.select(*IDENTITY).distinct()
    known = incoming.join(keys.withColumn("_known", F.lit(True)), list(IDENTITY), "left")
    told = F.when(F.col("_known"), F.col("isin")).otherwise(F.raise_error(F.lit("an event of an instrument that was not refreshed")))
    new = known.withColumn("isin", told).select(*incoming.columns).withColumn("month", _month(F.col("date"), as_of))
    owner = F.regexp_replace("partition", "/month=[^/]*$", "")
    listed = read_manifest(spark, root).select("partition", owner.alias("owner"))
    stale = listed.join(keys.select(partition_label(IDENTITY).alias("owner")), "owner", "left_semi")
    return publish(new, root, RAW_BY, published_at, partial=True, replaces=stale)


def sink_raw_listings(raw: DataFrame, root: str, published_at: datetime, as_of: date, skip_existing: bool = False) -> int:
    """Writes raw listings as given, by exchange, type and symbol, in the month of as_of. Returns the partitions written.

    skip_existing: listings whose partition is there already are left as they are.
    """
    rows = listing_partitions(raw).withColumn("month", F.lit(as_of.strftime("%Y-%m")))
    if skip_existing:
        label = partition_label(LISTING_BY)
        there = read_manifest(raw.sparkSession, root).select(F.col("partition").alias("_partition"))
        rows = rows.withColumn("_partition", label).join(there, "_partition", "left_anti").drop("_partition")
    return publish(rows, root, LISTING_BY, published_at, partial=True)


def _files(spark: SparkSession, root: str) -> DataFrame:
    """file and file_rows of the files that a listing of root finds, by their footers. The sink itself looks for files by name."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top):
        return spark.createDataFrame([], "file string, file_rows long")
    files = spark.read.schema(T.StructType()).option("recursiveFileLookup", True).parquet(root)
    by_path = files.select("_metadata.file_path").groupBy("file_path").agg(F.count("*").alias("file_rows"))  # paths are taken apart once for each file
    name = F.url_decode(F.regexp_extract("file_path", r"([^/]+/[^/]+)$", 1))  # names hold no plus sign
    return by_path.select(name.alias("file"), "file_rows")


def _name(value: str) -> str:
    """A value as part of a file name, percent-encoded."""
    return quote(value, safe="*").replace("~", "%7E")


def _source_hash(digests: pa.ChunkedArray) -> str:
    """What operators.reconcile.fingerprint makes of one group's row digests: in order, those with the same three first digits hashed together, then those hashes."""
    held = pa.concat_arrays(digests.cast(pa.binary()).cast(pa.binary(64)).chunks)
    texts = np.sort(np.frombuffer(held.buffers()[1], "S64", len(held), 64 * held.offset))
    starts = texts.astype("S3")
    cuts = [0, *(np.flatnonzero(starts[1:] != starts[:-1]) + 1).tolist(), len(texts)]
    joined = memoryview(b",".join(texts.tolist()))
    buckets = [sha256(joined[65 * at : 65 * end - 1]).hexdigest() for at, end in zip(cuts, cuts[1:])]
    return sha256(",".join(buckets).encode()).hexdigest()


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """The store that holds root, and root's path in it. A percent sign in it stands for itself, as in Spark's paths."""
    return fs.FileSystem.from_uri(root.replace("%", "%25") if "://" in root else root)


def _rows_there(store: fs.FileSystem, path: str) -> int | None:
    """How many rows a file has by its footer; None without a file, -1 for one that can't be read."""
    try:
        with store.open_input_file(path) as f:
            return pq.read_metadata(f).num_rows
    except FileNotFoundError:
        return None
    except pa.ArrowInvalid:
        return -1


_PLAN = "file string, exchange string, code string, row_count long, source_hash string, written boolean, _replaces boolean, _staged string"


def _stage(batches: Iterator[pa.RecordBatch], root: str, staging: str, feature_hash: str) -> Iterator[pa.RecordBatch]:
    """One row per instrument for its rows, which come with their digests; the files that aren't there yet are written aside, in a folder of this run's own."""
    store, base = _opened(root)
    aside = f"{_opened(staging)[1]}/data/{uuid.uuid4().hex}"
    store.create_dir(aside)
    for table in whole_instruments(batches, GOLD_BY):
        cuts = np.flatnonzero(places(table, GOLD_BY) == 0).tolist()
        made = []
        for at, end in zip(cuts, [*cuts[1:], table.num_rows]):
            own = table.slice(at, end - at)
            exchange, code = (own.column(c)[0].as_py() for c in GOLD_BY)
            source_hash = _source_hash(own.column("_digest"))
            name = _name(f"{code}_GOLD_{feature_hash}_{source_hash}.parquet")
            file, hidden = f"exchange={_name(exchange)}/{name}", name[0] in "_."  # which a listing leaves out
            there = _rows_there(store, f"{base}/{file}")
            written, staged = hidden or there != own.num_rows, None
            if written:
                staged = f"{aside}/{len(made)}-{source_hash}.parquet"
                with store.open_output_stream(staged) as out:
                    pq.write_table(own.drop_columns("_digest"), out, compression="zstd")
            made.append((file, exchange, code, own.num_rows, source_hash, written, there is not None, staged))
        yield pa.RecordBatch.from_arrays([pa.array(x) if n != "_staged" else pa.array(x, pa.string()) for n, x in zip(_PLAN_NAMES, zip(*made))], _PLAN_NAMES)


_PLAN_NAMES = [x.split()[0] for x in _PLAN.split(", ")]


def _place(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """Renames the staged files. A run after one that got half way goes on where it stopped."""
    store, base = _opened(root)
    folders = set()
    for batch in batches:
        for r in batch.to_pylist():
            to = "/".join([base, *map(safe_part, r["file"].split("/"))])
            if (folder := to.rsplit("/", 1)[0]) not in folders:
                store.create_dir(folder)
                folders.add(folder)
            if store.get_file_info(r["_staged"]).type == fs.FileType.NotFound and _rows_there(store, to) == r["row_count"]:
                continue
            if r["_replaces"] and store.get_file_info(to).type != fs.FileType.NotFound:
                store.delete_file(to)
            store.move(r["_staged"], to)
        yield batch.select(["file"])


def sink_gold(rows: DataFrame, root: str, feature_hash: str) -> DataFrame:
    """One file for each exchange and code, named by the features' and the rows' hashes (those of gold_artifacts). exchange, code, row_count, file, written.

    A file that is there, with as many rows by its footer, is not written again. One pass over an instrument's rows makes its
    hash, looks for the file by its name and writes a new one aside; when all are made, tasks rename them, so a reader sees
    whole files only. Spark's own writer takes many times as long for a small file. A null or empty exchange or code is an error.
    rows: stored ones, as they are counted first. A task holds one instrument's rows at a time.
    """
    spark = rows.sparkSession
    named = F.when(F.coalesce(F.trim("exchange") != "", F.lit(False)) & F.coalesce(F.trim("code") != "", F.lit(False)), F.col("code"))
    tasks = tasks_for(rows, 250_000)
    rows = rows.withColumn("code", F.coalesce(named, F.raise_error(F.lit("a row has no exchange or code"))))
    own = [c for c in rows.columns if c not in GOLD_BY]
    dealt = rows.select(*GOLD_BY, *own).repartition(tasks, *GOLD_BY).sortWithinPartitions(F.xxhash64(*GOLD_BY), *GOLD_BY, *own)  # numbers first: names begin alike
    staging = f"{root}-staging-{uuid.uuid4().hex}"
    made = dealt.withColumn("_digest", row_digest(own)).mapInArrow(lambda batches: _stage(batches, root, staging, feature_hash), _PLAN)
    made.write.parquet(f"{staging}/plan")  # once: what a task finds in place must be from before
    plan = spark.read.schema(made.schema).parquet(f"{staging}/plan")
    new = plan.filter("written").select("file", "row_count", "_replaces", "_staged")
    new.mapInArrow(lambda batches: _place(batches, root), "file string").write.format("noop").mode("overwrite").save()
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(root).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(f"{staging}/data"), True)
    return plan.drop("_replaces", "_staged")


def gold_files(spark: SparkSession, root: str) -> DataFrame:
    """exchange, code and file_name of the gold files that a listing finds, as their rows have them. Both columns are read whole."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    paths = listed.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file"))  # names alone: no content is read by this

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        for batch in batches:
            files, held = batch.column(0).to_pylist(), []
            for k, file in enumerate(files, 1):
                with store.open_input_file(f"{base}/{file}") as f:
                    rows = pq.ParquetFile(f).read(columns=list(GOLD_BY), use_threads=False)
                held.append(rows.append_column("file_name", pa.repeat(file.rsplit("/", 1)[1], rows.num_rows)))
                if k % 100 == 0 or k == len(files):
                    yield from pa.concat_tables(held).group_by([*GOLD_BY, "file_name"], use_threads=False).aggregate([]).combine_chunks().to_batches()
                    held = []

    return paths.repartition(folder_tasks(spark, paths.count(), 0)).mapInArrow(read, "exchange string, code string, file_name string")
