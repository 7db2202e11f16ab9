"""Hard negatives by a full sort of each anchor's scores.

Rows lie in blocks of about ROWS, anchors in blocks of about ANCHORS, both as packed tables of the shared folder. Every task
takes row blocks and streams all anchor blocks past them. For each anchor all scores with a block are sorted, ties by
id; the first rows of its own label are candidates for its positives, and once these are settled over all blocks, each
positive's upper limit is found by binary search in the sorted scores and the next rows of other labels are read from there
down to its lower limit. Only those few rows per anchor and block leave a task, whatever the number of rows of a label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .integer_vectors import matrix, products, quantized
from .shared import materialize, remove

ROWS = 2048
ANCHORS = 128
#: Row blocks' parts that a task holds at most: 64 parts of 2,048 vectors of 64 components take 64 MB.
HELD = 64
_BLOCK = "block long, size int, dims int, ids binary, labels binary, vectors binary"


def _blocks(rows: DataFrame, size: int, what: str) -> tuple[DataFrame, int]:
    """The rows (id, label, vector) in blocks of about so many, at most twice as many, and in how many parts blocks were made; shorter vectors are filled up with zeros.

    Rows are dealt out evenly, so a label's or an id's share of them doesn't matter. A block's number is part of what is
    written, and so stays the same when a reader runs again; its upper half is the part.
    """
    names = [f.split()[0] for f in _BLOCK.split(", ")]

    def pack(part: pa.Table) -> list:
        ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
        vectors = [np.frombuffer(v, "<i8") for v in part.column("vector").to_pylist()]
        dims = max(map(len, vectors))
        if min(map(len, vectors)) < dims:
            vectors = [np.concatenate([v, np.zeros(dims - len(v), np.int64)]) for v in vectors]
        by = np.argsort(ids, kind="stable")
        x = np.stack(vectors)[by] if dims else np.zeros((len(ids), 0), np.int64)
        return [len(ids), dims, ids[by].astype("<i8").tobytes(), labels[by].astype("<i8").tobytes(), x.astype(_width(x)).tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held.append(batch.slice(at, size))
                n += held[-1].num_rows
                if n >= size:
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([number, *pack(pa.Table.from_batches(held))], _KINDS)], names=names)
                    number, held, n = number + 1, [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([number, *pack(pa.Table.from_batches(held))], _KINDS)], names=names)

    parts = max(1, -(-rows.count() // size))
    return materialize(rows.repartition(parts).mapInArrow(run, _BLOCK), what), parts


_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def _width(x: np.ndarray) -> str:
    most = int(np.abs(x).max(initial=0))
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"


class _Block:
    """Ids in their order, labels and vectors of one packed block."""

    def __init__(self, size: int, dims: int, ids: bytes, labels: bytes, vectors: bytes) -> None:
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        kind = f"<i{len(vectors) // (size * dims)}" if dims else "<i8"
        self.vectors = np.frombuffer(vectors, kind).reshape(size, dims).astype(np.int64)

    def scores(self, rows: _Block) -> np.ndarray:
        """The integer scores of all pairs; components that one side lacks count as zero."""
        dims = min(self.vectors.shape[1], rows.vectors.shape[1])
        return products(self.vectors[:, :dims], rows.vectors[:, :dims])


def _past(anchors: DataFrame, rows: DataFrame, parts: int, each, schema: str) -> DataFrame:
    """What `each` yields for every anchor block with each group of row blocks, which lie in so many parts.

    A group has HELD parts at most; a task holds its row blocks and reads all anchor blocks one after the other.
    """
    groups = min(parts, max(4 * rows.sparkSession.sparkContext.defaultParallelism, -(-parts // HELD)))
    more = [c for c in anchors.columns if c not in rows.columns]
    group = (F.shiftright("block", 32) % groups).cast("int")
    left = rows.select(group.alias("part"), F.lit(0).alias("side"), *rows.columns, *[F.lit(None).cast(anchors.schema[c].dataType).alias(c) for c in more])
    right = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.lit(1).alias("side"), *rows.columns, *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)}
                if row["part"].as_py() != part:
                    part, held = row["part"].as_py(), []
                block = _Block(*(row[n].as_py() for n in ("size", "dims", "ids", "labels", "vectors")))
                if row["side"].as_py() == 0:
                    held.append(block)
                else:
                    yield from each(row, block, held)

    both = left.unionByName(right).repartitionById(groups, F.col("part")).sortWithinPartitions("part", "side")
    return both.mapInArrow(run, schema)


def _rows_out(kinds: dict[str, pa.DataType], rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def mine_hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchors: Column | None = None,
    n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: hard negatives of each anchor and positive.

    A score is the inner product of the integer vectors; higher scores come first, ties by the smaller id. Anchors are the
    rows for which `anchors` is true (by default, those whose id is divisible by 50). An anchor's positives are its first
    n_positives rows of its label and of another id; for each, the first n_negatives rows of another label and id follow whose
    score lies between `low` and `high` percent of the positive's.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Components that one of two vectors
    lacks count as zero. Rows that repeat an id are rows of their own, each an anchor and each a candidate. Other columns
    are not read. Scores that could leave 64 bits are an error. An empty table gives no rows.
    """
    number, known = pa.int64(), rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = anchors if anchors is not None else F.col(id_col) % 50 == 0
    named = known.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"), chosen.alias("anchor"))
    whole = materialize(quantized(named, "vector", {"id": "id", "label": "label", "anchor": "anchor"}, scale), "scored-rows")
    all_, parts = _blocks(whole.drop("anchor"), ROWS, "row-blocks")
    asking, _ = _blocks(whole.filter("anchor").drop("anchor"), ANCHORS, "anchor-blocks")
    remove(whole)
    near_kinds = {"block": number, "place": pa.int32(), "id": number, "score": number}

    def positives(row: dict, anchor: _Block, held: list[_Block]) -> Iterator[pa.RecordBatch]:
        found: list[list[tuple[int, int]]] = [[] for _ in anchor.ids]
        for other in held:
            scores = anchor.scores(other)
            order = np.argsort(-scores, axis=1, kind="stable")  # a block's rows lie in the order of their ids, so ties stay so
            for k, by in enumerate(order):
                same = by[(other.labels[by] == anchor.labels[k]) & (other.ids[by] != anchor.ids[k])][:n_positives]
                found[k] += zip((-scores[k, same]).tolist(), other.ids[same].tolist())
        block = row["block"].as_py()
        yield from _rows_out(near_kinds, [(block, k, i, -s) for k, f in enumerate(found) for s, i in sorted(f)[:n_positives]])

    near = _past(asking, all_, parts, positives, "block long, place int, id long, score long")
    best = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), "id"))
    first = near.withColumn("rank", best).filter(F.col("rank") <= n_positives)
    lists = first.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", "rank", "id", "score"))).alias("positives"))  # 2 * ANCHORS * n_positives at most
    asking = materialize(asking.join(lists, "block"), "anchor-positives")

    kinds = {"block": number, "place": pa.int32(), "position": pa.int32(), "anchor_id": number, "positive_id": number, "negative_id": number, "positive_score": number, "negative_score": number}

    def negatives(row: dict, anchor: _Block, held: list[_Block]) -> Iterator[pa.RecordBatch]:
        asked = row["positives"].as_py()
        found: list[list[tuple[int, int]]] = [[] for _ in asked]
        for other in held:
            scores = anchor.scores(other)
            order = np.argsort(-scores, axis=1, kind="stable")
            of = None
            for n, p in enumerate(asked):  # in the order of their anchors
                if p["place"] != of:
                    of = p["place"]
                    by = order[of][(other.labels[order[of]] != anchor.labels[of]) & (other.ids[order[of]] != anchor.ids[of])]
                    falling = -scores[of, by]
                upper, lower = high * p["score"] // 100, -(-low * p["score"] // 100)
                at, end = int(np.searchsorted(falling, -upper)), int(np.searchsorted(falling, -lower, side="right"))
                read = slice(at, max(at, min(at + n_negatives, end)))
                found[n] += zip(falling[read].tolist(), other.ids[by[read]].tolist())
        block = row["block"].as_py()
        yield from _rows_out(kinds, [(block, p["place"], p["rank"], int(anchor.ids[p["place"]]), p["id"], i, p["score"], -s) for p, f in zip(asked, found) for s, i in sorted(f)[:n_negatives]])

    schema = ", ".join(f"{n} {'int' if t == pa.int32() else 'long'}" for n, t in kinds.items())
    found = _past(asking, all_, parts, negatives, schema)
    rank = F.row_number().over(Window.partitionBy("block", "place", "position").orderBy(F.desc("negative_score"), "negative_id"))
    last = found.withColumn("rank", rank).filter(F.col("rank") <= n_negatives)
    return last.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
