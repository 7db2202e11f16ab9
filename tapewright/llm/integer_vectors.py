"""Vectors of floats as integer vectors: floor(scale * x) of each component, packed as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Whole numbers up to here are exact as doubles, sums and products among them.
EXACT = 1 << 53


def quantized(rows: DataFrame, vector_col: str, keep: dict[str, str], scale: int, dims: int | None = None) -> DataFrame:
    """The kept columns (new name: old name) and `vector`: each component's floor(scale * x) as little-endian 64-bit integers.

    Rows whose vector is null, has a null or non-finite component, or has not `dims` components (if given) are left out.
    A component that doesn't fit in 62 bits is an error.
    """
    sized = rows.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) == dims if dims is not None else F.lit(True)))
    plain = sized.select(*[F.col(old).alias(new) for new, old in keep.items()], F.col(vector_col).cast("array<double>").alias("vector"))
    names = [*keep, "vector"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(len(names) - 1)
            sizes = pc.list_value_length(vectors).to_numpy()
            values = np.floor(pc.fill_null(vectors.flatten(), np.nan).to_numpy(zero_copy_only=False) * scale)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = bad[bounds[1:]] == bad[bounds[:-1]]
            values = values[np.repeat(good, sizes)]
            if len(values) and np.abs(values).max() >= 1 << 62:
                raise ValueError("a component is too large for exact integer results")
            data, ends = values.astype("<i8").tobytes(), np.concatenate([[0], np.cumsum(sizes[good] * 8)]).astype(np.int64)
            packed = pa.Array.from_buffers(pa.large_binary(), int(good.sum()), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())
            held = [batch.column(k).filter(pa.array(good)) for k in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*held, packed], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:-1])
    return plain.mapInArrow(run, f"{kinds}, vector binary")


def matrix(packed: pa.Array, dims: int) -> np.ndarray:
    """Packed vectors of one size as the rows of a matrix."""
    packed = packed.cast(pa.large_binary())
    _, ends, data = packed.buffers()
    at = np.frombuffer(ends, np.int64)[packed.offset]
    return np.frombuffer(data, "<i8", len(packed) * dims, int(at)).reshape(-1, dims) if len(packed) and dims else np.zeros((len(packed), dims), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of all rows of a with all of b, exact; an error where one could leave 64 bits."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most >= 1 << 63:
        raise ValueError("inner products don't fit in 64 bits")
    if most < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T
