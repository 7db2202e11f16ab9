"""K-means on integer vectors with Drake's adaptive bounds.

Each vector keeps an upper bound of its distance to its centroid, lower bounds of its distances to several of the nearest
other centroids, and one lower bound for all the rest. When centroids move, bounds move with them. A vector whose upper
bound is below every lower bound keeps its centroid unseen; otherwise its listed centroids are measured, in the order of
their bounds and only as deep as the upper bound reaches; and where the bound for the rest can't rule the rest out, all are
scanned anew. Lists start with a quarter of the centroids and shrink to the depth that a round used, an eighth at least.

Distances are exact integers and bounds are rounded away from the truth, so results equal those of full scans. The vectors
and their bounds are a table of the shared folder, written once a round; centroids are few and travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .integer_vectors import EXACT, matrix, quantized
from .shared import materialize, remove

#: A bound is rounded by this share of the numbers it is made from, many times more than doubles lose.
_SLACK = 1e-12
#: Vectors are worked through in pieces of so many.
_ROWS = 4096


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of c, exact."""
    most = x.shape[1] * (int(np.abs(x).max(initial=0)) + int(np.abs(c).max(initial=0))) ** 2
    if most >= 1 << 63:
        raise ValueError("squared distances don't fit in 64 bits")
    if most >= EXACT:
        return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
    a, b = x.astype(np.float64), c.astype(np.float64)
    return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)


def _own(x: np.ndarray, c: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x to the centroids that its row of `of` names."""
    return np.stack([((x - c[of[:, k]]) ** 2).sum(axis=1) for k in range(of.shape[1])], axis=1) if of.shape[1] else np.zeros(of.shape, np.int64)


class Bounds:
    """The state of some vectors: cluster, upper bound, the listed centroids and their lower bounds, the last one for the rest."""

    def __init__(self, cluster: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray) -> None:
        self.cluster, self.upper, self.near, self.lower = cluster, upper, near, lower

    @classmethod
    def scanned(cls, x: np.ndarray, c: np.ndarray, listed: int) -> Bounds:
        d = squared(x, c)
        every = np.arange(len(x))
        cluster = d.argmin(axis=1)  # the first of equal ones
        upper = np.sqrt(d[every, cluster].astype(np.float64)) * (1 + _SLACK)
        others = d.astype(np.float64)
        others[every, cluster] = np.inf
        near = np.argsort(others, axis=1, kind="stable")[:, : listed + 1]
        lower = np.sqrt(np.take_along_axis(others, near, axis=1)) * (1 - _SLACK)
        if near.shape[1] <= listed:  # fewer centroids than the list has places
            lower = np.concatenate([lower, np.full((len(x), listed + 1 - near.shape[1]), np.inf)], axis=1)
            near = np.concatenate([near, np.zeros((len(x), listed - near.shape[1]), near.dtype)], axis=1)
        return cls(cluster, upper, near[:, :listed], lower)

    def shrunk(self, listed: int) -> Bounds:
        """With shorter lists: the bound for the rest takes in those that go."""
        rest = self.lower[:, listed:].min(axis=1)
        return Bounds(self.cluster, self.upper, self.near[:, :listed], np.concatenate([self.lower[:, :listed], rest[:, None]], axis=1))

    def moved(self, by: np.ndarray) -> Bounds:
        """After each centroid has moved by at most so much."""
        gone = np.concatenate([by[self.near], np.full((len(self.near), 1), by.max(initial=0))], axis=1)
        lower = self.lower - gone
        lower = np.where(np.isinf(lower), lower, lower - _SLACK * (np.abs(self.lower) + gone))
        return Bounds(self.cluster, (self.upper + by[self.cluster]) * (1 + _SLACK), self.near, lower)

    def assigned(self, x: np.ndarray, c: np.ndarray) -> tuple[Bounds, np.ndarray]:
        """The state with each vector at its nearest centroid, and how many listed centroids each vector needed."""
        cluster, upper, near, lower = self.cluster.copy(), self.upper.copy(), self.near.copy(), self.lower.copy()
        depth = np.zeros(len(x), np.int64)
        floor = lower.min(axis=1)
        open_ = np.flatnonzero(upper >= floor)
        upper[open_] = np.sqrt(_own(x[open_], c, cluster[open_][:, None])[:, 0].astype(np.float64)) * (1 + _SLACK)
        open_ = open_[upper[open_] >= floor[open_]]
        if len(open_):
            reached = lower[open_, :-1] <= upper[open_][:, None]
            depth[open_] = np.where(reached.any(axis=1), reached.shape[1] - reached[:, ::-1].argmax(axis=1), 0)
            far = int(depth[open_].max())
            of = np.concatenate([cluster[open_][:, None], near[open_, :far]], axis=1)
            d = _own(x[open_], c, of)
            asked = np.arange(far + 1)[None, :] <= depth[open_][:, None]  # the own centroid, and as deep as this vector's bound reaches
            best = np.where(asked, d, np.iinfo(np.int64).max).min(axis=1)
            place = np.where(asked & (d == best[:, None]), of, len(c)).argmin(axis=1)  # of equal ones the smallest number
            root = np.sqrt(d.astype(np.float64))
            low = np.where(asked, root * (1 - _SLACK), np.concatenate([root[:, :1], lower[open_, :far]], axis=1))
            every = np.arange(len(open_))
            cluster[open_], upper[open_] = of[every, place], root[every, place] * (1 + _SLACK)
            of[every, place], low[every, place] = of[:, 0].copy(), low[:, 0].copy()  # the old centroid takes the new one's place
            by = np.argsort(low[:, 1:], axis=1, kind="stable")
            near[open_, :far], lower[open_, :far] = np.take_along_axis(of[:, 1:], by, axis=1), np.take_along_axis(low[:, 1:], by, axis=1)
            again = open_[lower[open_, -1] <= upper[open_]]  # the rest can't be ruled out
            if len(again):
                new = Bounds.scanned(x[again], c, near.shape[1])
                cluster[again], upper[again], near[again], lower[again] = new.cluster, new.upper, new.near, new.lower
        return Bounds(cluster, upper, near, lower), depth


def _packed(values: np.ndarray, kind: str) -> pa.Array:
    values = np.ascontiguousarray(values.astype(kind))
    ends = np.arange(len(values) + 1, dtype=np.int32) * (values.itemsize * values.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def _assign(rows: DataFrame, centroids: np.ndarray, moved: np.ndarray | None, was: int, listed: int) -> DataFrame:
    """The vectors (with bounds of `was` listed centroids, unless moved is None) with their new state; with listed 0 it has no bounds any more."""
    id_type = rows.schema["id"].dataType.simpleString()
    dims, final = centroids.shape[1], listed == 0
    names = ["id", "vector", "cluster", "upper", "near", "lower", "depth", "distance"]

    def unpack(column: pa.Array, kind: str, width: int) -> np.ndarray:
        column = column.cast(pa.large_binary())
        at = int(np.frombuffer(column.buffers()[1], np.int64)[column.offset]) if len(column) else 0
        return np.frombuffer(column.buffers()[2] or b"", kind, len(column) * width, at).reshape(len(column), width) if width else np.zeros((len(column), 0), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x = matrix(batch.column(1), dims)
                if moved is None:
                    state, depth = Bounds.scanned(x, centroids, listed), np.zeros(len(x), np.int64)
                else:
                    state = Bounds(batch.column(2).to_numpy(), batch.column(3).to_numpy(), unpack(batch.column(4), "<i4", was), unpack(batch.column(5), "<f8", was + 1))
                    state, depth = state.shrunk(listed or was).moved(moved).assigned(x, centroids)
                distance = _own(x, centroids, state.cluster[:, None])[:, 0]
                near, lower = (state.near[:, :0], state.lower[:, :0]) if final else (state.near, state.lower)
                columns = [pa.array(state.cluster.astype(np.int32)), pa.array(state.upper), _packed(near, "<i4"), _packed(lower, "<f8"), pa.array(depth.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    return rows.mapInArrow(run, f"id {id_type}, vector binary, cluster int, upper double, near binary, lower binary, depth int, distance long")


def _totals(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each cluster's size and exact component sums, and the deepest list that was needed. Tasks send one row per cluster and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, deepest = np.zeros((k, dims + 1), np.int64), 0
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x, cluster = matrix(batch.column(0), dims), batch.column(1).to_numpy()
                by = np.argsort(cluster, kind="stable")
                first = np.flatnonzero(np.diff(cluster[by], prepend=-1))
                held[cluster[by][first], :dims] += np.add.reduceat(x[by], first, axis=0)
                held[:, dims] += np.bincount(cluster, minlength=k)
                deepest = max(deepest, int(batch.column(2).to_numpy().max(initial=0)))
        of, part = np.nonzero(held)
        columns = [pa.array(of, pa.int64()), pa.array(part, pa.int64()), pa.array(held[of, part]), pa.array(np.full(len(of), deepest))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "part", "total", "depth"])

    parts = state.select("vector", "cluster", "depth").mapInArrow(run, "cluster long, part long, total long, depth long")
    sums, deepest = np.zeros((k, dims + 1), np.int64), 0
    for r in parts.groupBy("cluster", "part").agg(F.sum("total").alias("total"), F.max("depth").alias("depth")).collect():  # k * (dims + 1) rows at most
        sums[r["cluster"], r["part"]] = r["total"]
        deepest = max(deepest, r["depth"])
    return sums[:, dims], sums[:, :dims], deepest


def cluster_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2"
) -> tuple[DataFrame, DataFrame]:
    """(id, cluster, distance) of each vector, and (cluster, centroid, size, inertia) of each centroid.

    Vectors of other than `dims` components, or with a null or non-finite one, are left out. The first centroids are the k
    vectors with the smallest SHA-256 of `seed:id`, ties by the vector; all vectors if they are fewer. Each round assigns
    every vector to its nearest centroid (squared Euclidean distance, ties to the smaller number) and replaces each centroid
    that has vectors by the floor of their mean; then all are assigned once more. Rows that repeat an id are vectors of their
    own; those with a null id are clustered but never are first centroids. Other columns are not read. Without vectors both
    tables are empty. Components whose squared distances could leave 64 bits are an error.
    """
    spark = rows.sparkSession
    id_type = rows.schema[id_col].dataType.simpleString()
    state = materialize(quantized(rows, vector_col, {"id": id_col}, scale, dims), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = state.filter("id IS NOT NULL").orderBy(order, "vector").limit(k).select("vector").collect()  # k rows
    if not first:
        return spark.createDataFrame([], f"`{id_col}` {id_type}, cluster int, distance long"), spark.createDataFrame([], "cluster int, centroid array<long>, size long, inertia long")
    centroids = np.stack([np.frombuffer(bytes(r["vector"]), "<i8") for r in first])
    k = len(centroids)
    was, listed, moved = 0, max(1, k // 4), None
    for n in range(rounds + 1):
        new = materialize(_assign(state, centroids, moved, was, 0 if n == rounds else listed), f"round-{n}")
        remove(state)
        state, was = new, listed
        if n == rounds:
            break
        sizes, sums, deepest = _totals(state, k, dims)
        next_ = np.where(sizes[:, None] > 0, sums // np.maximum(sizes, 1)[:, None], centroids)
        moved = np.sqrt(_own(next_, centroids, np.arange(k)[:, None])[:, 0].astype(np.float64)) * (1 + _SLACK)
        centroids = next_
        if n:  # the first round scans all and says nothing on depths
            listed = min(listed, max(1, k // 8, deepest))
    by_cluster = state.groupBy("cluster").agg(F.count("*").alias("size"), F.sum("distance").alias("inertia"))
    named = spark.createDataFrame([(j, c.tolist()) for j, c in enumerate(centroids)], "cluster int, centroid array<long>")
    whole = named.join(F.broadcast(by_cluster), "cluster", "left").select("cluster", "centroid", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("inertia", F.lit(0)).alias("inertia"))
    return state.select(F.col("id").alias(id_col), "cluster", "distance"), whole
