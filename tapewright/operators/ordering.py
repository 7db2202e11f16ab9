"""Order of stored rows: whether they are sorted, sorting where they aren't, and fingerprints that depend on the order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import entity_key, row_digest
from ..sources.scratch import scratch_path
from .history import guarded

#: A range of rows ends before a row whose digest begins so: one in 4,096, wherever rows are added or removed.
RANGE_MARK = "000"


def _placed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys with each row's file and place in it, or its partition and place where rows don't come from files."""
    try:
        return rows.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), *keys)
    except Exception as e:  # noqa: BLE001
        if "_metadata" not in str(e):
            raise
        return rows.select(F.lpad(F.spark_partition_id().cast("string"), 10, "0").alias("_file"), F.monotonically_increasing_id().alias("_at"), *keys)


def _compared(columns: Sequence[pa.Array]) -> tuple[pa.Array, pa.Array]:
    """For each row but the first: whether it comes before the row above, and whether it equals it. Nulls come first."""
    n = len(columns[0]) - 1
    less, same = pa.array([False] * n, pa.bool_()), pa.array([True] * n, pa.bool_())
    for c in columns:
        above, here = c.slice(0, n), c.slice(1)
        falls = pc.if_else(pc.or_(above.is_null(), here.is_null()), pc.and_(above.is_valid(), here.is_null()), pc.greater(above, here))
        equal = pc.if_else(pc.or_(above.is_null(), here.is_null()), pc.and_(above.is_null(), here.is_null()), pc.equal(above, here))
        less = pc.or_(less, pc.and_(same, falls))
        same = pc.and_(same, equal)
    return less, same


def order_runs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run of rows that one task reads from one file: its place, first and last keys, rows, falls and ties.

    A fall is a row that comes before the row above it; a tie is one with equal keys. No rows are shuffled.
    """
    placed = _placed(rows, keys)
    names = ["_file", "_at", "rows", "falls", "ties", *[f"first_{k}" for k in keys], *[f"last_{k}" for k in keys]]
    kinds = {f.name: f.dataType for f in placed.schema.fields}
    schema = T.StructType([T.StructField("_file", T.StringType()), *[T.StructField(n, T.LongType()) for n in names[1:5]], *[T.StructField(n, kinds[k]) for n, k in zip(names[5:], [*keys, *keys])]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # first and last row of the run so far
        counts = [0, 0, 0]

        def told() -> pa.RecordBatch:
            first, last = held.slice(0, 1), held.slice(held.num_rows - 1, 1)
            made = [first.column("_file"), first.column("_at"), *[pa.chunked_array([pa.array([n])]) for n in counts], *[first.column(k) for k in keys], *[last.column(k) for k in keys]]
            return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in made], names=names)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                file = batch.column("_file")[at]
                other = pc.not_equal(batch.column("_file").slice(at), file)
                size = pc.index(other, True).as_py()
                part = pa.Table.from_batches([batch.slice(at, batch.num_rows - at if size < 0 else size)])
                if held is not None and held.column("_file")[0].as_py() != file.as_py():
                    yield told()
                    held, counts[:] = None, [0, 0, 0]
                joined = part if held is None else pa.concat_tables([held.slice(held.num_rows - 1, 1), part])
                less, same = _compared([joined.column(k).combine_chunks() for k in keys])
                counts[0] += part.num_rows
                counts[1] += pc.sum(less).as_py() or 0
                counts[2] += pc.sum(same).as_py() or 0
                held = pa.concat_tables([(part if held is None else held).slice(0, 1), part.slice(part.num_rows - 1, 1)])
                at += part.num_rows
        if held is not None:
            yield told()

    return placed.mapInArrow(run, schema)


def order_state(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: row_count, falls and ties over all files in the order of their names, and whether rows are sorted and unique.

    Each run's first keys are held against the last keys of the run before; one row per run takes part in that.
    """
    runs = order_runs(rows, keys)
    first, last = (F.struct(*[F.col(f"{w}_{k}").alias(k) for k in keys]) for w in ("first", "last"))
    above = F.lag(last).over(Window.orderBy("_file", "_at"))  # one row per run: files and splits bound their number
    met = runs.withColumn("_first", first).withColumn("_above", above)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    edge = lambda c: F.coalesce(c & F.col("_above").isNotNull(), F.lit(False)).cast("long")
    counted = met.agg(total("rows").alias("row_count"), total(F.col("falls") + edge(F.col("_first") < F.col("_above"))).alias("falls"), total(F.col("ties") + edge(F.col("_first") == F.col("_above"))).alias("ties"))
    return counted.withColumn("sorted", F.col("falls") == 0).withColumn("unique", F.col("ties") == 0)


def sorted_by(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows sorted by keys: as they are, without a shuffle, where their files (by name) hold them in this order."""
    return rows if order_state(rows, keys).first()["sorted"] else rows.orderBy(*keys)


def require_sorted(rows: DataFrame, keys: Sequence[str], unique: bool = True) -> DataFrame:
    """The rows; an error when they are read if a row comes before the one above it, or (unique) has its keys."""
    state = order_state(rows, keys)
    return guarded(rows, state.select((F.col("sorted") & (F.col("unique") | F.lit(not unique))).alias("ok")), f"rows are not in the order of {', '.join(keys)}")


def read_sidecar(spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str]) -> DataFrame:
    """The tombstones of a retraction sidecar, which must be sorted, unique and all retracted."""
    rows = spark.read.schema(schema).parquet(path)
    held = require_sorted(rows, keys)
    told = F.when(F.col("status").eqNullSafe("retracted"), F.col("status")).otherwise(F.raise_error(F.lit("a sidecar's row is not retracted")))
    return held.withColumn("status", told)


_LINK = "part int, seq int, opens boolean, closed boolean, first string, last string, n long, d string"


def _linked(rows: DataFrame) -> DataFrame:
    """part, seq, first, last, n and d of each range of sorted rows (first, last, n, d): d is the digest of its rows' in their order.

    A range begins at a row whose d begins with RANGE_MARK, so a change moves no other range's ends. Ranges inside one
    sorted partition are hashed there. The pieces at a partition's ends are kept as text and joined afterwards: two per
    partition, of some 4,096 digests each.
    """
    spark, mark = rows.sparkSession, RANGE_MARK
    names = [f.split()[0] for f in _LINK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, None  # held: opens, first, last, n, texts
        last_key = None

        def told(closed: bool) -> pa.RecordBatch:
            opens, first, last, n, texts = held
            text = hashlib.sha256(b"".join(texts)).hexdigest() if opens and closed else b"".join(texts).decode()
            return pa.RecordBatch.from_pylist([dict(zip(names, (part, seq, opens, opens and closed, first, last, n, text)))], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("opens", pa.bool_()), ("closed", pa.bool_()), ("first", pa.string()), ("last", pa.string()), ("n", pa.int64()), ("d", pa.string())]))

        for batch in batches:
            if not batch.num_rows:
                continue
            first, last, n, d = (batch.column(k) for k in ("first", "last", "n", "d"))
            if first[0].as_py() == last_key or pc.any(pc.equal(first.slice(1), first.slice(0, len(first) - 1))).as_py():
                raise ValueError("an ordered fingerprint needs unique keys")
            last_key = first[len(first) - 1].as_py()
            marks = pc.indices_nonzero(pc.starts_with(d, mark)).to_pylist()
            edges = [0, *[m for m in marks if m], len(d)]
            for a, b in zip(edges, edges[1:]):
                opens = a in marks[:1] or a > 0
                if held is not None and opens:
                    yield told(True)
                    seq, held = seq + 1, None
                held = held or [opens, first[a].as_py(), None, 0, []]
                held[2], held[3] = last[b - 1].as_py(), held[3] + pc.sum(n.slice(a, b - a)).as_py()
                held[4].append("".join(d.slice(a, b - a).to_pylist()).encode())
        if held is not None:
            yield told(False)

    path = scratch_path(spark, "ranges")
    rows.select("first", "last", "n", "d").mapInArrow(run, _LINK).write.parquet(path)
    links = spark.read.schema(_LINK).parquet(path)
    group = F.sum(F.col("opens").cast("int")).over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, 0))  # two rows per partition
    pieces = links.filter("NOT closed").withColumn("_group", group).groupBy("_group").agg(F.array_sort(F.collect_list(F.struct("part", "seq", "first", "last", "n", "d"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["d"]), "")
    total = F.aggregate(F.transform("p", lambda x: x["n"]), F.lit(0).cast("long"), lambda s, x: s + x)
    joined = pieces.select(F.col("p")[0]["part"].alias("part"), F.col("p")[0]["seq"].alias("seq"), F.col("p")[0]["first"].alias("first"), F.element_at("p", -1)["last"].alias("last"), total.alias("n"), F.sha2(text, 256).alias("d"))
    return links.filter("closed").select(*joined.columns).unionByName(joined)


def _ordered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _rows_of(rows: DataFrame, order: Sequence[str], values: Sequence[str] | None) -> DataFrame:
    """Sorted as they are; keys and digests, which are longer, are made afterwards, and not for the sample that the ranges are cut by."""
    names, key = list(values or rows.columns), entity_key(order)
    held = _ordered(rows.select(*dict.fromkeys([*order, *names])), order)
    return held.select(key.alias("first"), key.alias("last"), F.lit(1).cast("long").alias("n"), row_digest(names).alias("d"))


def fingerprint_ranges(rows: DataFrame, order: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """range_start, range_end, row_count and range_sha256 of the ranges that the rows fall into, in the order of unique keys.

    values: the columns that count (all by default); the order counts besides. Two states differ in the ranges that only one
    of them has. Equal keys are an error.
    """
    linked = _linked(_rows_of(rows, order, values))
    return linked.select(F.col("first").alias("range_start"), F.col("last").alias("range_end"), F.col("n").alias("row_count"), F.col("d").alias("range_sha256"))


def ordered_fingerprint(rows: DataFrame, order: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """One row: row_count and a fingerprint of the rows in the order of unique keys.

    Ranges of rows are hashed, then ranges of these hashes, and what is left (one in 16 million rows) is joined.
    """
    ranges = _linked(_ordered(_linked(_rows_of(rows, order, values)), ["part", "seq"]))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "seq", "d"))), lambda x: x["d"]), ",")
    return ranges.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.sha2(parts, 256).alias("fingerprint"))


def enveloped_fingerprint(active: DataFrame, retracted: DataFrame, order: Sequence[str], retracted_keys: Sequence[str]) -> DataFrame:
    """One row: row_count of the active rows, retracted_count, and one fingerprint of both: the rows and the tombstones' keys, in their orders."""
    a, r = ordered_fingerprint(active, order), ordered_fingerprint(retracted.select(*retracted_keys), retracted_keys)
    r = r.select(F.col("row_count").alias("retracted_count"), F.col("fingerprint").alias("_retracted"))
    whole: Column = F.sha2(F.concat(F.lit('{"retracted":"'), F.col("_retracted"), F.lit('","rows":"'), F.col("fingerprint"), F.lit('"}')), 256)
    return a.crossJoin(F.broadcast(r)).select("row_count", "retracted_count", whole.alias("fingerprint"))  # one row each
