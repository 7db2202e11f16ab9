"""Removal of byte strings that appear earlier, by suffix arrays built in two stages.

A string of LENGTH bytes that appears twice has the same anchor in both places: the smallest of its ANCHOR-byte hashes.
So texts are cut into stretches, one for each run of windows with the same anchor, and only stretches that share their
anchor with another stretch can hold repeats. Equal stretches are settled at once; of the different stretches of one
anchor the bytes are gathered, many anchors to a task, and sorted as suffixes: suffixes smaller than their successors
are sorted directly, the others are induced from them bucket by bucket, and adjacent common prefixes of LENGTH bytes
show the equal windows. Everything is exact but for collisions of two 64-bit hashes taken together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import PrefixHash, joined_bytes
from .shared import materialize, mix64, slices

ANCHOR = 32
CHUNK_BYTES = 4 << 20
#: A longer text is cut into stretches piece by piece.
PIECE_BYTES = 4 << 20
#: An anchor with more different stretches is dealt out by two hashes of its windows; their bytes never meet in one task.
HOT_STRETCHES = 20_000


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each stretch of so many elements."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def stretches(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each run of windows with one anchor: text number, first window's start in the text, count, two hashes."""
    sizes = np.diff(bounds)
    valid = np.repeat(np.arange(len(sizes)), np.maximum(0, sizes - length + 1))
    none = np.zeros(0, np.int64)
    if not len(valid):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    counts = np.maximum(0, sizes - length + 1)
    at = np.arange(len(valid)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[valid]
    prefix = PrefixHash(data)
    grams = prefix.windows(ANCHOR)
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(keyed, length - ANCHOR + 1)[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    n = np.diff(np.append(first, len(anchor)))
    start = at[first]
    whole = mix64(prefix.of(start, start + n - 1 + length) + n.astype(np.uint64))
    return valid[first], start - bounds[valid[first]], n, grams[anchor[first]], whole


def all_stretches(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """stretches(), of a single long text in pieces; a stretch that a piece ends becomes two, which anchors bring together again."""
    if len(data) <= PIECE_BYTES or len(bounds) > 2:
        return stretches(data, bounds, length)
    found = []
    for a in range(0, len(data) - length + 1, PIECE_BYTES):
        part = data[a : a + PIECE_BYTES + length - 1]
        of, start, *rest = stretches(part, np.array([0, len(part)]), length)
        found.append((of, start + a, *rest))
    return tuple(np.concatenate(c) for c in zip(*found))


def suffix_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions by the order of their suffixes' first `depth` bytes (more of them may be included).

    text: bytes from 1 on, with a 0 behind each stretch. Stage one sorts the suffixes that are smaller than their
    successors; stage two scans the buckets of first bytes upwards and puts each remaining suffix, which is larger than
    its successor, in its own bucket in the order in which its successor is met.
    """
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=1))
    step[-1] = 1
    turn = np.where(step != 0, np.arange(n), n)
    ahead = np.minimum.accumulate(turn[::-1])[::-1]  # the next place where the byte changes
    smaller = step[ahead] > 0
    stop = np.minimum.accumulate(np.where(smaller, np.arange(n), n)[::-1])[::-1]
    # successors are wanted too, up to the first one that is sorted directly
    reach = np.zeros(n + 2, np.int32)
    np.add.at(reach, wanted, 1)
    np.add.at(reach, stop[wanted] + 1, -1)
    needed = np.cumsum(reach[:n]) > 0
    larger = needed & ~smaller

    direct = np.flatnonzero(needed & smaller)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)[direct])
    direct = direct[pc.sort_indices(pa.FixedSizeBinaryArray.from_buffers(pa.binary(depth), len(direct), [None, pa.py_buffer(rows)])).to_numpy()]
    del rows
    edges = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    for c in range(256):
        front, induced = np.concatenate(waiting[c]) if waiting[c] else direct[:0], []
        while len(front):
            induced.append(front)
            before = front[front > 0] - 1
            front = before[larger[before] & (text[before] == c)]
        bucket = np.concatenate([*induced, direct[edges[c] : edges[c + 1]]])
        waiting[c] = []
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (text[before] > c)]
        if len(before):
            byte = text[before]
            by = np.argsort(byte, kind="stable")
            before, byte = before[by], byte[by]
            cuts = np.flatnonzero(np.diff(byte)) + 1
            for piece in np.split(before, cuts):
                waiting[text[piece[0]]].append(piece)
    return np.concatenate(out)


def adjacent_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """The length of the common prefix, depth at most, of each suffix with the one before it; 0 for the first."""
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    view, out = np.lib.stride_tricks.sliding_window_view(padded, depth), np.zeros(len(order), np.int32)
    for a in range(1, len(order), 65536):
        b = min(len(order), a + 65536)
        differ = view[order[a:b]] != view[order[a - 1 : b - 1]]
        out[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def later_windows(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (number of the stretch, first window's start in its text, count) of windows that an earlier one equals."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # the separator becomes 0
    base = np.cumsum(sizes + 1) - sizes - 1
    of = np.repeat(np.arange(len(pieces)), counts)
    within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = base[of] + within
    number = np.full(len(text), -1, np.int64)
    number[place] = np.arange(len(place))
    order = suffix_order(text, place, length)
    order = order[number[order] >= 0]
    class_ = np.cumsum(adjacent_prefixes(text, order, length) < length)
    window = number[order]
    doc, at = ids[of[window]], starts[of[window]] + within[window]
    by = np.lexsort((at, doc, class_))
    window, doc, at, class_ = window[by], doc[by], at[by], class_[by]
    first = np.concatenate([[True], class_[1:] != class_[:-1]])
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    late = np.sort(window[(doc != doc[head]) | (at != at[head])])
    if not len(late):
        return late, late, late
    run = np.concatenate([[True], (np.diff(late) != 1) | (of[late[1:]] != of[late[:-1]])])
    lead = late[run]
    return of[lead], starts[of[lead]] + within[lead], np.diff(np.append(np.flatnonzero(run), len(late)))


def _anchored(texts: DataFrame, length: int) -> DataFrame:
    """id, h (anchor), g (whole stretch), at = start << 8 | count << 1 | settled. Settled: an equal one stands earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                part = part.take(pc.sort_indices(part.column(0)))
                of, start, n, h, g = all_stretches(*joined_bytes(part.column(1)), length)
                ids = part.column(0).to_numpy()[of]
                _, lead, back = np.unique(mix64(h + mix64(g)), return_index=True, return_inverse=True)
                settled = (ids != ids[lead[back]]) | (start != start[lead[back]])
                h = np.where(settled, mix64(g + mix64(ids.astype(np.uint64)) + start.astype(np.uint64)), h)  # spread; it meets nothing
                at = start << 8 | n << 1 | settled
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(at)], names=["id", "h", "g", "at"])

    return texts.mapInArrow(run, "id long, h long, g long, at long")


def _sorted_out(anchored: DataFrame) -> DataFrame:
    """id, start, n, h: runs of windows to remove (h null) and stretches whose anchor has other stretches too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shared = None, False  # the first row of the last (h, g), and whether its h has another g
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy() for c in batch.columns], axis=1)  # h, g, id, at
            if held is not None:
                x = np.concatenate([held[None], x])
            new_h = np.concatenate([[True], x[1:, 0] != x[:-1, 0]])
            new = new_h | np.concatenate([[True], x[1:, 1] != x[:-1, 1]])
            lead = np.flatnonzero(new)
            head = lead[np.cumsum(new) - 1]
            settled = (x[:, 3] & 1 == 1) | (x[:, 2] != x[head, 2]) | (x[:, 3] >> 8 != x[head, 3] >> 8)
            same = ~new_h[lead]
            multi = same | np.append(same[1:], False)
            multi[0] |= shared
            held, shared = x[lead[-1]], bool(multi[-1])
            kept = lead[:-1][multi[:-1] & ~settled[lead[:-1]]]
            yield rows(x[settled & ((np.arange(len(x)) != lead[-1]))], x[kept])
        if held is not None:
            settled = held[3] & 1 == 1
            yield rows(held[None][: int(settled)], held[None][: int(shared and not settled)])

    def rows(gone: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
        x = np.concatenate([gone, open_])
        h = pa.array(x[:, 0], mask=np.arange(len(x)) < len(gone))
        return pa.RecordBatch.from_arrays([pa.array(x[:, 2]), pa.array(x[:, 3] >> 8), pa.array(x[:, 3] >> 1 & 127), h], names=["id", "start", "n", "h"])

    keyed = anchored.select("h", "g", "id", "at").repartition("h").sortWithinPartitions("h", "g", "id", "at")
    return keyed.mapInArrow(run, "id long, start long, n long, h long")


def _gathered(texts: DataFrame, open_: DataFrame, length: int) -> tuple[DataFrame, DataFrame | None]:
    """key, id, start, n, piece: the bytes of the open stretches of bounded anchors. And k, k2, id, start: two hashes of each window of hot anchors, if there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for id_, text, spans in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                    out += [(s["h"], id_, s["start"], s["n"], text[s["start"] : s["start"] + s["n"] - 1 + length]) for s in spans or () if not s["hot"]]
                columns = zip(*out) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.binary()])], names=["key", "id", "start", "n", "piece"])

    # written, so that the join below has two plain sides and Spark can split the rows of a hot anchor
    hot = materialize(open_.groupBy("h").agg(F.count("*").alias("many")).filter(F.col("many") > HOT_STRETCHES).select("h", F.lit(True).alias("hot")), "hot-anchors")
    some = not hot.isEmpty()
    flagged = open_.join(hot, "h", "left") if some else open_.withColumn("hot", F.lit(False))
    spans = flagged.groupBy("id").agg(F.collect_list(F.struct("start", "n", "h", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("spans"))
    held = texts.join(spans, "id", "left").select("id", "text", "spans")
    pieces = held.mapInArrow(run, "key long, id long, start long, n long, piece binary")
    return pieces, materialize(_hot_windows(texts, flagged.filter("hot"), hot, length), "hot-windows") if some else None


def _hot_windows(texts: DataFrame, open_: DataFrame, hot: DataFrame, length: int) -> DataFrame:
    """k, k2, id, start: two hashes of each window of the open stretches of hot anchors.

    The texts are read again and cut as before, so that they are not shuffled a second time: only hot stretches are. Their
    anchors go through the driver, at most one for HOT_STRETCHES stretches.
    """
    anchors = np.sort(np.array([r["h"] for r in hot.select("h").collect()], np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                data, bounds = joined_bytes(part.column(1))
                of, start, n, h, _ = all_stretches(data, bounds, length)
                at = np.minimum(np.searchsorted(anchors, h.view(np.int64)), len(anchors) - 1)
                pick = np.flatnonzero(anchors[at] == h.view(np.int64))
                of, start, n = of[pick], start[pick], n[pick]
                lead = bounds[of] + start
                pieces = [data[x : x + k - 1 + length].tobytes() for x, k in zip(lead, n)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of)), pa.array(start), pa.array(pieces, pa.binary())], names=["id", "start", "piece"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                data, bounds = joined_bytes(part.column(2))
                counts = np.diff(bounds) - length + 1
                of = np.repeat(np.arange(len(counts)), counts)
                within = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = bounds[of] + within
                k, k2 = (PrefixHash(d).of(at, at + length).view(np.int64) for d in (data, data ^ np.uint8(0x5A)))
                ids, starts = (part.column(c).to_numpy() for c in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(k2), pa.array(ids[of]), pa.array(starts[of] + within)], names=["k", "k2", "id", "start"])

    cut = texts.filter("id is not null").mapInArrow(run, "id long, start long, piece binary")
    held = cut.join(open_.select("id", "start"), ["id", "start"], "left_semi").select("id", "start", "piece")
    return held.mapInArrow(windows, "k long, k2 long, id long, start long")


def _later(windows: DataFrame) -> DataFrame:
    """id, start, n: windows that an earlier one equals. Equal ones are reduced to the first in each task before they meet."""
    first = windows.groupBy("k", "k2").agg(F.count("*").alias("many"), F.min(F.struct("id", "start")).alias("first")).filter("many > 1")
    late = windows.join(materialize(first, "hot-firsts"), ["k", "k2"]).filter(F.struct("id", "start") > F.col("first"))
    return late.select("id", "start", F.lit(1).cast("long").alias("n"))


def _compared(pieces: DataFrame, length: int) -> DataFrame:
    """id, start, n: runs of windows that an earlier window equals. All stretches of one key meet in one chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= CHUNK_BYTES:
                whole = pa.Table.from_batches(held).combine_chunks()
                keys = whole.column(0).to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield from compare(whole.slice(0, cut))
                    whole = whole.slice(cut)
                held, size = whole.to_batches(), whole.nbytes
        if held:
            yield from compare(pa.Table.from_batches(held))

    def compare(whole: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = whole.column(0).to_numpy()
        ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
        sizes = np.cumsum(pc.binary_length(whole.column(4)).to_numpy())
        at = 0
        while at < len(keys):
            most = (sizes[at - 1] if at else 0) + CHUNK_BYTES
            to = int(max(ends[np.searchsorted(ends, at, side="right")], ends[max(0, np.searchsorted(sizes[ends - 1], most, side="right") - 1)]))
            part = whole.slice(at, to - at)
            ids, starts, counts = (part.column(k).to_numpy() for k in (1, 2, 3))
            of, start, n = later_windows(ids, starts, counts, part.column(4).to_pylist(), length)
            yield pa.RecordBatch.from_arrays([pa.array(ids[of]), pa.array(start), pa.array(n.astype(np.int64))], names=["id", "start", "n"])
            at = to

    keyed = pieces.repartition("key").sortWithinPartitions("key")
    return keyed.mapInArrow(run, "id long, start long, n long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, spans (array of removed runs: start, end), kept (binary).

    Removes each byte covered by a string of `length` bytes that also starts earlier: in a document with a smaller id, or
    earlier in the same one. Strings are judged on the input and never cross documents. Ids are integers. A null text is
    empty. A row with a null id is no document and stays whole. Rows that repeat an id with the same text are one
    document, and each gets its result. Other columns are not read. What is kept may end inside a character, so it is
    binary.
    """
    if length < 2 * ANCHOR or length > ANCHOR + 127:
        raise ValueError(f"length must lie between {2 * ANCHOR} and {ANCHOR + 127}")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = materialize(_sorted_out(_anchored(texts.filter("id is not null"), length)), "stretches")
    pieces, windows = _gathered(texts, spans.filter("h is not null"), length)
    late = _compared(pieces, length)
    late = late.union(_later(windows)) if windows is not None else late
    gone = spans.filter("h is null").select("id", "start", "n").union(late).groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for text, gone in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                    runs: list[list[int]] = []
                    for a, b in sorted((g["start"], g["start"] + g["n"] - 1 + length) for g in gone or ()):
                        if runs and a <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], b)
                        else:
                            runs.append([a, b])
                    ends = [0, *(x for r in runs for x in r), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
                    out.append((len(text), len(text) - len(kept), runs, kept))
                size, removed, runs, kept = zip(*out)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "n_removed", "spans", "kept"])

    return texts.join(gone, "id", "left").select("id", "text", "gone").mapInArrow(cut, f"`{id_col}` long, n_bytes long, n_removed long, spans array<array<long>>, kept binary")
