"""The feature view: quotes in, one row per quote with levels and the catalog's features out."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import HIST, KEYS, MARKET, MARKET_DAILY, MARKET_WINDOWS, RECURRENT, STAGES, WINDOWED, window_clause
from ..operators.frames import in_order, with_calls
from ..operators.normalize import with_availability
from ..operators.recurrences import COLUMNS, with_recurrences

BASE = (
    "SELECT isin, exchange, code, trade_date, CAST(adjusted_close AS DOUBLE) AS p, CAST(volume AS DOUBLE) AS v, CAST(open AS DOUBLE) AS o, "
    "CAST(high AS DOUBLE) AS h, CAST(low AS DOUBLE) AS l, CAST(close AS DOUBLE) AS c FROM {source}"
)


_CALL = re.compile(r"\w+\([^()]*\) OVER \w+")


def shared_windows(columns: dict[str, str], source: str, keep: str) -> str:
    """A query for the columns in which each window call that several of them use is computed once, in a step below."""
    calls = {c: f"_{source.strip("{}")}_{k}" for k, c in enumerate(dict.fromkeys(c for x in columns.values() for c in _CALL.findall(x)))}
    named = {n: _CALL.sub(lambda m: calls[m[0]], x) for n, x in columns.items()}
    below = f"(SELECT *, {', '.join(f'{c} AS {n}' for c, n in calls.items())} FROM {source} {window_clause()}) AS below" if calls else source
    return f"SELECT {keep}, {', '.join(f'{x} AS {n}' for n, x in named.items())} FROM {below}"


def staged(source: str, stages: Iterable[dict[str, str]], select: str) -> str:
    """A query that adds the stages one after the other to the rows of source."""
    named = [("s0", source)]
    for k, columns in enumerate(stages):
        named.append((f"s{k + 1}", shared_windows(columns, f"s{k}", "*")))
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in named) + f" {select.format(last=f's{len(named) - 1}')}"


def _chosen(families: Iterable[str]) -> tuple[dict[str, str], dict[str, str]]:
    own = {n: x for f in families if f in WINDOWED for n, x in WINDOWED[f].items()}
    return own, {n: x for f in families if f in RECURRENT for n, x in RECURRENT[f].items()}


def _words(texts: Iterable[str]) -> set[str]:
    return set(re.findall(r"[A-Za-z_]\w*", " ".join(texts)))


def _step(rows: DataFrame, columns: dict[str, str], needed: set[str]) -> DataFrame:
    """Rows in_order() with the columns; of their own ones, those that are needed stay."""
    if not columns:
        return rows
    calls = {c: f"_call_{k}" for k, c in enumerate(dict.fromkeys(c for x in columns.values() for c in _CALL.findall(x)))}
    named = {n: _CALL.sub(lambda m: calls[m[0]], x) for n, x in columns.items()}
    kept = [c for c in rows.columns if c in needed]
    rows = rows.select(*[c for c in rows.columns if c in needed | _words(columns.values())])
    if calls:
        rows = with_calls(rows, {n: c for c, n in calls.items()})
    return rows.selectExpr(*kept, *[f"{x} AS {n}" for n, x in named.items()])


def market_rows(quotes: DataFrame) -> DataFrame:
    """One row per date: breadth and dispersion of the day's returns, and their means over trailing dates.

    The window over dates has no partition; it runs over one row per date, after the aggregation.
    """
    spark = quotes.sparkSession
    daily = ", ".join(f"{x} AS {n}" for n, x in MARKET_DAILY.items())
    by_date = spark.sql(staged(BASE.format(source="{quotes}"), STAGES[:2], f"SELECT trade_date, {daily} FROM {{last}} GROUP BY trade_date").replace("{{quotes}}", "{quotes}"), quotes=quotes)
    rolled = ", ".join(f"{x} AS {n}" for n, x in MARKET.items())
    return spark.sql(f"SELECT *, {rolled} FROM {{daily}} {MARKET_WINDOWS}", daily=by_date)


def features(quotes: DataFrame, families: Iterable[str] | None = None, market: bool = True, levels: bool = True, placed: bool = False) -> DataFrame:
    """The keys, trade_date, availability, the two levels and the features of the chosen families (all by default).

    quotes: isin, exchange, code, trade_date, open, high, low, close, adjusted_close, volume; one row per instrument and
    date. Only the stages and columns that the chosen families use are computed. placed: each instrument's quotes are in one
    partition, so they aren't exchanged; with no join since they were put there, which could split a partition.
    """
    own, recurrent = _chosen(families if families is not None else [*WINDOWED, *RECURRENT])
    steps = [*STAGES, *([{"hist": HIST}] if recurrent else []), own | recurrent]
    used = [{*KEYS, "trade_date", *(("p", "v") if levels else ()), *own, *recurrent}]  # after each step, from the last one upwards
    for k in reversed(range(len(steps))):
        steps[k] = {n: x for n, x in steps[k].items() if n in used[0]}
        used.insert(0, used[0] | _words(steps[k].values()))
    rows = quotes.sparkSession.sql(BASE.format(source="{quotes}"), quotes=quotes)
    held = [c for c in COLUMNS if c in used[0]]
    rows = in_order(rows.select(*[c for c in rows.columns if c in used[0] or (held and c == "p")]), placed)
    out = with_recurrences(rows, held) if held else rows
    for columns, needed in zip(steps, used[1:]):
        out = _step(out, columns, needed)
    names = [*KEYS, "trade_date", *own, *recurrent]
    out = out.select(*names[:4], *([F.col("p").alias("adjusted_close_level"), F.col("v").alias("volume_level")] if levels else []), *names[4:])
    if levels:
        out = with_availability(out, "trade_date")
    # one row per date: calendar dates bound its size, whatever the number of instruments
    return out.join(F.broadcast(market_rows(quotes)), "trade_date") if market else out


def refreshed_view(
    stored: DataFrame, quotes: DataFrame, changed: DataFrame, families: Iterable[str] | None = None, levels: bool = True, shaped: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """A stored view after some instruments' quotes changed (as after a corporate action): their rows are computed anew, others are kept.

    changed: the identities. The market's columns depend on all instruments, so they are made anew for every date.
    shaped: a change to the values (not to keys, dates or names), made to each part before they meet. Made to all columns of the whole,
    it can give Spark a method that is too long for Java to compile, which then runs many times as slow.
    """
    market = shaped(market_rows(quotes))
    keys = changed.select(*KEYS).distinct()
    own = features(quotes.join(keys, list(KEYS), "left_semi"), families, market=False, levels=levels)
    kept = stored.join(keys, list(KEYS), "left_anti").select(*own.columns)
    return shaped(kept).unionByName(shaped(own)).join(F.broadcast(market), "trade_date")  # one row per date


__all__ = ["COLUMNS", "features", "market_rows", "refreshed_view", "staged"]
