"""Line dedup with two Bloom filters.

One pass over the texts fills a filter of line keys seen in one document and one of keys seen in a second. Only lines
that the second filter suspects are shuffled, with their whole keys: that confirms repeats exactly and finds the
smallest document id of each. The filters are sized by the number of lines, up to MOST_LOG2_BITS, which bounds the
broadcast; beyond that they fill up, more lines are suspected and shuffled, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import SPACES, clash, materialize, slices

SLICE_BYTES = 1 << 16
HASHES = 3
#: Bits of a filter for each line, and the size in bits at which it stops growing, as a power of two (128 MB).
BITS_PER_LINE = 12
LEAST_LOG2_BITS, MOST_LOG2_BITS = 20, 30
STRIPPED = SPACES.encode()


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """Line numbers and keys of the lines whose key is long enough to count."""
    out = []
    for n, line in enumerate(text.split(b"\n")):
        key = line.strip(STRIPPED).lower()  # of bytes: A-Z alone change
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
            out.append((n, key))
    return out


def _bits(hashes: np.ndarray, log2_bits: int) -> np.ndarray:
    """The places of each hash: HASHES rows of bit numbers, by double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * step) & np.uint64((1 << log2_bits) - 1) for k in range(HASHES)])


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(filter_, (flat >> np.uint64(3)).astype(np.int64), np.left_shift(1, (flat & np.uint64(7)).astype(np.uint8)).astype(np.uint8))


def _has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    hit = filter_[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)
    return (hit & 1).all(axis=0)


def _texts(part: pa.RecordBatch, at: int) -> list[bytes]:
    return [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]


def seen_twice(docs: DataFrame, id_col: str, text_col: str, min_chars: int, log2_bits: int) -> np.ndarray:
    """The filter of keys that at least two documents hold. A key counts once a document.

    Filters of two tasks join as counters do: twice = twice | twice' | (once & once'), once = once | once'.
    """
    size = (1 << log2_bits) // 8

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for batch in batches:
            for part in slices(batch, 0):
                each = [xxhash.xxh3_64_intdigest(k) for t in _texts(part, 0) for k in {k for _, k in line_keys(t, min_chars)}]
                hashes, counts = np.unique(np.array(each, np.uint64), return_counts=True)
                places = _bits(hashes, log2_bits)
                _set(twice, places[:, (counts > 1) | _has(once, places)])
                _set(once, places)
        step = min(SLICE_BYTES, size)
        for k in range(0, size, step):
            if once[k : k + step].any():
                packed = [pa.compress(x[k : k + step].tobytes(), "zstd", asbytes=True) for x in (once, twice)]
                yield pa.RecordBatch.from_arrays([pa.array([k // step], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]], names=["slice", "once", "twice"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, own, once, twice = min(SLICE_BYTES, size), None, None, None
        row = lambda: pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([pa.compress(twice.tobytes(), "zstd", asbytes=True)], pa.binary())], names=["slice", "twice"])
        for batch in batches:
            for k, a, b in zip(*(batch.column(c).to_pylist() for c in range(3))):
                a, b = (np.frombuffer(pa.decompress(x, step, "zstd"), np.uint8) for x in (a, b))
                if k != own:
                    if own is not None:
                        yield row()
                    own, once, twice = k, np.zeros(step, np.uint8), np.zeros(step, np.uint8)
                twice |= b | (once & a)
                once |= a
        if own is not None:
            yield row()

    parts = docs.filter(F.col(id_col).isNotNull()).select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(fill, "slice int, once binary, twice binary")
    joined = parts.repartition(16, "slice").sortWithinPartitions("slice").mapInArrow(join, "slice int, twice binary")
    step, whole = min(SLICE_BYTES, size), np.zeros(size, np.uint8)
    for r in joined.toLocalIterator():  # at most the filter's fixed size
        whole[r["slice"] * step : (r["slice"] + 1) * step] = np.frombuffer(pa.decompress(bytes(r["twice"]), step, "zstd"), np.uint8)
    return whole


def filter_bits(docs: DataFrame, text_col: str) -> int:
    """The size that suits the number of lines, as a power of two."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.agg(F.sum(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 1
    return min(MOST_LOG2_BITS, max(LEAST_LOG2_BITS, (BITS_PER_LINE * lines - 1).bit_length()))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), min_chars: int = 10, log2_bits: int | None = None) -> DataFrame:
    """One row per input row: id, the carried columns, n_lines, n_dropped, kept_text.

    A line's key is the line without white space at its ends, A-Z lower-cased. A key of at least min_chars code points
    that at least two documents hold stays only in the document with the smallest id, in all its lines there. A null or
    empty text is one empty line. A row without an id keeps all its lines and counts as no document. Rows that repeat an
    id are one document. Columns that aren't carried are not read, so their names can't clash; carried ones must not be
    named as the result's own columns, id, text or drop. log2_bits sets the size of each Bloom filter by hand.
    """
    clash(carry, id_col, ("n_lines", "n_dropped", "kept_text", "id", "text", "drop"))
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    log2_bits = filter_bits(docs, text_col) if log2_bits is None else log2_bits
    filter_ = spark.sparkContext.broadcast(seen_twice(docs, id_col, text_col, min_chars, log2_bits))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows, hashes = [], []
                for at, text in enumerate(_texts(part, 1)):
                    held: dict[bytes, list[int]] = {}
                    for n, key in line_keys(text, min_chars):
                        held.setdefault(key, []).append(n)
                    rows += [(at, key, lines) for key, lines in held.items()]
                    hashes += [xxhash.xxh3_64_intdigest(key) for key in held]
                keep = _has(filter_.value, _bits(np.array(hashes, np.uint64), log2_bits))
                at, keys, lines = zip(*[r for r, k in zip(rows, keep) if k]) if keep.any() else ((), (), ())
                ids = part.column(0).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), pa.array(lines, pa.list_(pa.int32()))], names=["id", "key", "lines"])

    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    suspects = materialize(texts.mapInArrow(suspect, f"id {kind}, key binary, lines array<int>"), "line-suspects")
    # written, so that the join below has two plain sides and Spark can split a key that very many documents hold
    firsts = materialize(suspects.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("key", "first"), "line-firsts")
    drops = suspects.join(firsts, "key").filter("id > first").groupBy("id").agg(F.flatten(F.collect_list("lines")).alias("drop"))

    fields = [docs.schema[c] for c in carry]
    row = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carry).join(drops, "id", "left")
    row = row.select("id", "text", "drop", *carry)
    names = [id_col, *carry, "n_lines", "n_dropped", "kept_text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                counts, dropped, kept = [], [], []
                for text, drop in zip(_texts(part, 1), part.column(2).to_pylist()):
                    lines = text.split(b"\n")
                    gone = set(drop or ())
                    counts.append(len(lines))
                    dropped.append(len(gone))
                    kept.append(b"\n".join([x for n, x in enumerate(lines) if n not in gone]) if gone else text)
                made = [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[3:], *made], names=names)

    carried = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return row.mapInArrow(cut, f"`{id_col}` {kind}, {carried}n_lines long, n_dropped long, kept_text string")
