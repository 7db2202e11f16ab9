"""Packing of tokenized documents into sequences of a fixed length, neighbours in content side by side.

A document's tokens are hashed into a signed vector of BUCKETS numbers, which a fixed random rotation projects to DIMS
dimensions. Its cell there has a key on the Hilbert curve; documents are range-sorted by that key and laid end to end, and
the line of tokens is cut every `length` tokens. Only the line's end is shorter: it is cut into powers of two, which need no
padding. Places on the line come from running totals in each sorted partition and one number per partition.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import joined_bytes
from .shared import materialize, mix64, slices

BUCKETS = 256
DIMS = 4
#: Bits of each dimension in the key.
BITS = 15
#: Parts of texts whose ids a worker keeps from one task to the next, in some 120 MB; beyond that it starts anew.
KEPT_WORDS = 2_000_000
#: Texts are encoded in pieces of so many bytes, each different part of a piece looked up once.
PIECE_BYTES = 4 << 20

_OTHER, _SPACE, _LETTER, _MARK = range(4)
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
_KIND[[ord(c) for c in ".,;:!?"]] = _MARK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Masks of the first 0 to 8 bytes of a number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def projection() -> np.ndarray:
    """DIMS orthogonal directions among the BUCKETS, from a fixed seed."""
    return np.linalg.qr(np.random.Generator(np.random.PCG64(12)).standard_normal((BUCKETS, DIMS)))[0]


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each cell (a row of whole numbers below 2**bits).

    From the highest bit down, the cell's half in each dimension reflects or exchanges what is left of the first dimension;
    the Gray code of the result, its bits interleaved, is the place.
    """
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for d in range(n):
            upper = (x[d] >> np.uint64(bit) & np.uint64(1)).astype(bool)
            swap = np.where(upper, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] >> np.uint64(bit) & np.uint64(1), np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << np.uint64(1) | x[d] >> np.uint64(bit) & np.uint64(1)
    return key.astype(np.int64)


def content_keys(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The Hilbert key of each document's tokens."""
    n = len(bounds) - 1
    hashed = mix64(ids.astype(np.uint64) + np.uint64(1))
    of = np.repeat(np.arange(n), np.diff(bounds)) * BUCKETS + (hashed % np.uint64(BUCKETS)).astype(np.int64)
    vectors = np.bincount(of, np.where(hashed >> np.uint64(63), 1.0, -1.0), n * BUCKETS).reshape(n, BUCKETS)
    size = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    placed = (vectors / np.where(size > 0, size, 1)) @ projection()
    spread = np.tanh(0.8 * np.sqrt(BUCKETS) * placed)  # about evenly over (-1, 1), as projections of unit vectors are about normal
    return hilbert_keys(np.clip(np.floor((spread + 1) * (1 << (BITS - 1))), 0, (1 << BITS) - 1).astype(np.int64))


def _parts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each part of the texts' bytes, and each text's bounds among the parts.

    Texts part at white space, and before a mark that follows an ASCII letter: tokens never reach over either.
    """
    kind = _KIND[data]
    last = np.concatenate([[_SPACE], kind[:-1]])  # the byte before
    last[bounds[:-1][bounds[:-1] < len(data)]] = _SPACE
    solid = kind != _SPACE
    starts = np.flatnonzero(solid & ((last == _SPACE) | ((kind == _MARK) & (last == _LETTER))))
    stops = np.flatnonzero(np.diff(solid.astype(np.int8), append=0) == -1) + 1  # where solid bytes end, whatever the text
    ends = np.minimum(np.append(starts[1:], len(data)), stops[np.searchsorted(stops, starts, side="right")]) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, bounds)


class _Words:
    """Ids of texts by a tokenizer that never joins tokens over white space: each different part of a text is encoded once.

    Parts of up to 16 bytes are told apart by two numbers that hold all their bytes, longer ones by their text.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.known = np.zeros((0, 3), np.uint64)  # hash and both numbers of each short part, in the order of hashes
        self.at = np.zeros(0, np.int64)
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _added(self, parts: list[bytes]) -> np.ndarray:
        """The places of new parts among the encoded ones."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in parts], add_special_tokens=False)]
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.uint32)])
        first = len(self.ends) - 1
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(f) for f in found], dtype=np.int64)])
        return np.arange(first, len(self.ends) - 1)

    def _short(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """The places of parts of up to 16 bytes, or None if two of them share a hash.

        A-Z count as a-z where a part is all ASCII and there are no special tokens.
        """
        size = (ends - starts).astype(np.uint64)
        wide = np.zeros(len(data) + 16, np.uint8)
        wide[: len(data)] = data if ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any() else _LOWER[data]  # a special token in capitals is plain text
        plain = np.concatenate([[0], np.cumsum(data >= 128, dtype=np.int32)])
        for s, e in zip(starts[odd := plain[ends] > plain[starts]].tolist(), ends[odd].tolist()):
            wide[s:e] = data[s:e]
        eight = np.ndarray(len(data) + 9, "<u8", wide, 0, (1,))  # the eight bytes from each place on
        a = eight[starts] & _FIRST[np.minimum(size, 8)]
        b = eight[starts + 8] & _FIRST[np.maximum(size, 8) - np.uint64(8)]
        h = mix64(a + mix64(b + size))
        by = np.argsort(h)
        new = np.concatenate([[True], h[by][1:] != h[by][:-1]])
        lead, of = by[new], np.empty(len(h), np.int64)
        of[by] = np.cumsum(new) - 1
        one = h[lead]
        if (a != a[lead][of]).any() or (b != b[lead][of]).any():
            return None
        near = np.minimum(np.searchsorted(self.known[:, 0], one), max(len(self.known) - 1, 0))
        new = np.ones(len(one), bool) if not len(self.known) else self.known[near, 0] != one
        places = np.zeros(len(one), np.int64)
        if not new.all():
            if (self.known[near[~new], 1:] != np.stack([a[lead[~new]], b[lead[~new]]], axis=1)).any():
                return None
            places[~new] = self.at[near[~new]]
        if new.any():
            text = [data[s:e].tobytes() for s, e in zip(starts[lead[new]].tolist(), ends[lead[new]].tolist())]
            places[new] = self._added(text)
            to = np.searchsorted(self.known[:, 0], one[new])
            self.known = np.insert(self.known, to, np.stack([one[new], a[lead[new]], b[lead[new]]], axis=1), axis=0)
            self.at = np.insert(self.at, to, places[new])
        return places[of]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and each text's bounds among them."""
        data, bounds = joined_bytes(texts)
        if len(self.ends) > KEPT_WORDS:
            self.forget()
        starts, ends, of_text = _parts(data, bounds) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64))
        at = np.zeros(len(starts), np.int64)
        short = ends - starts <= 16
        if short.any():
            found = self._short(data, starts[short], ends[short])
            short &= found is not None
            at[short] = found if found is not None else 0
        long = [data[s:e].tobytes() for s, e in zip(starts[~short].tolist(), ends[~short].tolist())]
        if new := list(dict.fromkeys(p for p in long if p not in self.place)):
            self.place.update(zip(new, self._added(new).tolist()))
        at[~short] = np.fromiter(map(self.place.__getitem__, long), np.int64, len(long))
        start, size = self.ends[at], self.ends[at + 1] - self.ends[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.arange(ends[-1]) + np.repeat(start - ends[:-1], size)], ends[of_text]


@cache
def _words(path: str) -> _Words:
    """One for each worker process, which serves many tasks."""
    return _Words(path)


def id_width(path: str, end_id: int) -> int:
    """Bytes of a stored id: two where all ids fit, else four."""
    return 2 if max(end_id, *_words(path).tokenizer.get_vocab(with_added_tokens=True).values()) < 1 << 16 else 4


def tokenized(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, width: int) -> DataFrame:
    """id, key, n and ids (little-endian, of `width` bytes each) of each document; the end id follows its tokens. A null text is empty."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _words(tokenizer)
        for batch in batches:
            for part in slices(batch, 1, PIECE_BYTES, rows=4096):
                ids, bounds = coder.encode(part.column(1))
                key = content_keys(ids, bounds)
                n = np.diff(bounds) + 1
                ends = np.cumsum(n)
                whole = np.full(int(ends[-1]), end_id, f"<u{width}")
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                data = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(np.concatenate([[0], ends * width]).astype(np.int64)), pa.py_buffer(whole.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(key), pa.array(n), data.cast(pa.binary())], names=["id", "key", "n", "ids"])

    return texts.mapInArrow(run, f"id {kind}, key long, n long, ids binary")


def cuts(start: int, n: int, total: int, length: int) -> list[tuple[int, int, int]]:
    """(sequence, offset, size) of each piece of the tokens from `start` to `start + n` of a line of `total` tokens.

    Sequences have `length` tokens each; the line's rest is cut into powers of two, the largest first.
    """
    out, full, end = [], total // length * length, start + n
    while start < min(end, full):
        size = min(end, (start // length + 1) * length) - start
        out.append((start // length, start % length, size))
        start += size
    sequence, at, rest = full // length, full, total - full
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            a, b = max(start, at), min(end, at + (1 << bit))
            if a < b:
                out.append((sequence, a - at, b - a))
            sequence, at = sequence + 1, at + (1 << bit)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece: id, start (the document's tokens before it), length, ids (32-bit little-endian), doc_tokens, sequence_id, offset.

    Every document ends with end_id and lies whole in the line, cut where sequences end. Sequences are numbered along the
    curve from 0 and all hold `length` tokens, but for the last ones, whose sizes are powers of two that differ. Null and empty texts are one end id. Rows that repeat an id are documents of their own, those with a null id too. Documents with equal keys
    are in the order of id, tokens and their place in the table, so one key's many documents are dealt to several partitions. Other
    columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    width = id_width(tokenizer, end_id)
    rows = materialize(tokenized(docs, id_col, text_col, tokenizer, end_id, width).withColumn("row", F.monotonically_increasing_id()), "tokens")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = total + np.cumsum(n)
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n)]
            total = int(ends[-1]) if len(n) else total
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "ids", "part", "before"])

    ordered = rows.repartitionByRange("key", "id", "row").sortWithinPartitions("key", "id", "row")
    line = materialize(ordered.select("id", "n", "ids").mapInArrow(running, f"id {id_type}, n long, ids binary, part int, before long"), "line")
    sizes = line.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row per partition
    firsts, total = {}, 0
    for r in sizes:
        firsts[r["part"]], total = total, total + r["n"]
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, made, parts = [], [], []
            for k, (n, part, before) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 3, 4)))):
                data, at = memoryview(batch.column(2)[k].as_buffer()), 0
                for sequence, offset, size in cuts(firsts[part] + before, n, total, length):
                    of.append(k)
                    parts.append(np.frombuffer(data[width * at : width * (at + size)], f"<u{width}").astype("<u4").tobytes())
                    made.append((at, size, n, sequence, offset))
                    at += size
            start, size, n, sequence, offset = (pa.array(c, pa.int64()) for c in (zip(*made) if made else [()] * 5))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), start, size, pa.array(parts, pa.binary()), n, sequence, offset], names=names)

    return line.mapInArrow(pieces, f"`{id_col}` {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
