"""Lags and trailing frames over one instrument's rows: all window calls of a step in one ordered pass.

Spark computes a sliding frame anew for each row and call, value by value; here a task does it for all frames of a block of
rows at once, directly from the frames' values (no running sums, so a price that doesn't move has a deviation of exactly 0).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..functions.features import KEYS

_PARTS = re.compile(r"(\w+)\((.*)\) OVER (\w+)")
_FRAME = re.compile(r"(w|before)(\d+)")
#: Frames that are held at once, so that they stay in a core's cache.
BLOCK = 512


def in_order(rows: DataFrame, placed: bool = False) -> DataFrame:
    """Each instrument's rows in one partition, by date. placed: they are in one partition already."""
    return (rows if placed else rows.repartition(*KEYS)).sortWithinPartitions(*KEYS, "trade_date")


def _starts(table: pa.Table | pa.RecordBatch, keys: Sequence[str] = KEYS) -> np.ndarray:
    """For each row but the first: whether its keys differ from those above."""
    out = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for k in keys:
        c = pc.fill_null(table.column(k), "\0")
        out |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return out


def whole_instruments(batches: Iterator[pa.RecordBatch], keys: Sequence[str] = KEYS) -> Iterator[pa.Table]:
    """Rows in_order() as tables that hold each of their instruments whole; one instrument and one batch are held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        above = [held[-1].slice(held[-1].num_rows - 1)] if held else []
        cuts = np.flatnonzero(_starts(pa.Table.from_batches([*above, batch]), keys)) + 1 - len(above)
        if len(cuts):
            yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def places(table: pa.Table, keys: Sequence[str] = KEYS) -> np.ndarray:
    """Each row's place among its instrument's, from 0."""
    at = np.arange(table.num_rows)
    return at - np.maximum.accumulate(np.where(np.concatenate([[True], _starts(table, keys)]), at, 0))


def _centred(frames: np.ndarray) -> np.ndarray:
    moved = frames - frames[:, :1]  # exactly 0 where nothing moves
    return moved - moved.mean(axis=1, keepdims=True)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def _pairs(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    y, x = _centred(y), _centred(x)
    return np.stack([_products(x, x), _products(y, y), _products(x, y)], axis=1)


def _spread(less: int) -> Callable[[np.ndarray], np.ndarray]:
    def made(frames: np.ndarray) -> np.ndarray:
        moved = _centred(frames)
        return np.sqrt(_products(moved, moved) / (frames.shape[1] - less))

    return made


_OF_ONE: dict[str, Callable[[np.ndarray], np.ndarray]] = {
    "sum": lambda f: f.sum(axis=1), "avg": lambda f: f.mean(axis=1), "max": lambda f: f.max(axis=1), "min": lambda f: np.fmin.reduce(f, axis=1),
    "stddev_samp": _spread(1), "stddev_pop": _spread(0),
}
_OF_PAIRS = ("regr_sxx", "regr_syy", "regr_sxy")


def _framed(f: Callable[..., np.ndarray], n: int, *columns: np.ndarray) -> np.ndarray:
    """f of the n values up to each row, one value or a row of them; the first n - 1 rows have none."""
    rows, made = len(columns[0]), [f(*[np.empty((0, n)) for _ in columns])]
    for at in range(n - 1, rows, BLOCK):
        made.append(f(*[np.lib.stride_tricks.sliding_window_view(x[at - n + 1 : at + BLOCK], n) for x in columns]))
    none = np.full((min(n - 1, rows), *made[0].shape[1:]), np.nan)
    return np.concatenate([none, *made])


class _Pass:
    """The calls over one table of whole instruments."""

    def __init__(self, table: pa.Table) -> None:
        self.table, self.place, self.held = table, places(table), {}

    def column(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name not in self.held:
            c = self.table.column(name).combine_chunks()
            self.held[name] = c.to_numpy(zero_copy_only=False).astype("float64"), c.is_valid().to_numpy(zero_copy_only=False)
        return self.held[name]

    def counts(self, names: Sequence[str], n: int) -> np.ndarray:
        """How many of the last n rows have all of the columns."""
        if ("count", *names, n) not in self.held:
            total = np.concatenate([[0], np.cumsum(np.logical_and.reduce([self.column(c)[1] for c in names]))])
            at = np.arange(len(self.place))
            self.held["count", *names, n] = total[at + 1] - total[at + 1 - np.minimum(n, self.place + 1)]
        return self.held["count", *names, n]

    def moved(self, x: np.ndarray, k: int, otherwise: float) -> np.ndarray:
        """What x has k rows above, in the same instrument."""
        out = np.full(len(x), otherwise, dtype=x.dtype)
        out[k:] = x[: max(len(x) - k, 0)]
        out[self.place < k] = otherwise
        return out

    def value(self, call: str) -> pa.Array:
        """A count, or else the value where all rows of the frame have the columns, and null elsewhere."""
        name, text, frame = _PARTS.fullmatch(call).groups()
        names = tuple(w for w in re.findall(r"\w+", text) if w in self.table.column_names)
        if name == "lag":
            x, valid = self.column(names[0])
            k = int(text.rsplit(",", 1)[1])
            return pa.array(self.moved(x, k, np.nan), mask=~self.moved(valid, k, False))
        kind, size = _FRAME.fullmatch(frame).groups()
        n = int(size)
        whole = self.counts(names, n)
        if name == "count":
            return pa.array(self.moved(whole, 1, 0) if kind == "before" else whole, pa.int64())
        columns = [self.column(c)[0] for c in names]
        if name in _OF_PAIRS:
            if (names, n) not in self.held:
                self.held[names, n] = _framed(_pairs, n, *columns)
            x = self.held[names, n][:, _OF_PAIRS.index(name)]
        else:
            x = _framed(_OF_ONE[name], n, *columns)
        full = whole == n
        if kind == "before":
            x, full = self.moved(x, 1, np.nan), self.moved(full, 1, False)
        return pa.array(np.ascontiguousarray(x), mask=~full)


def with_calls(rows: DataFrame, calls: dict[str, str]) -> DataFrame:
    """Adds the window calls (the catalog's text: lag, or an aggregate over w{n} or before{n}) by their names to rows in_order().

    An aggregate other than a count is null unless all rows of its frame have its columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_instruments(batches):
            with np.errstate(all="ignore"):
                made = _Pass(table)
                for n, call in calls.items():
                    table = table.append_column(n, made.value(call))
            yield from table.to_batches(max_chunksize=10_000)

    kinds = ", ".join(f"{n} {'long' if c.startswith('count') else 'double'}" for n, c in calls.items())
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{given}, {kinds}")
