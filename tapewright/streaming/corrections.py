"""Inserts, corrections and late rows of a quote stream, by the last accepted row of each instrument and date as state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.canonical import canonical_json
from ..operators.normalize import IDENTITY

#: The state store that keeps such state; to be set as spark.sql.streaming.stateStore.providerClass.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Corrections(StatefulProcessor):
    """One key's rows against the newest accepted one, which expires after `keep_ms` without change."""

    def __init__(self, keys: Sequence[str], keep_ms: int | None) -> None:
        self.keys, self.keep_ms = list(keys), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "meaning string, event_time timestamp", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat(list(rows)).sort_values(["event_time", "meaning"])
        meaning, newest = self.held.get() if self.held.exists() else (None, None)
        before, kinds = meaning, []
        for row in new.itertuples():
            kind = "insert" if meaning is None else "repeat" if row.meaning == meaning else "late" if row.event_time < newest else "correction"
            if kind in ("insert", "correction"):
                meaning, newest = row.meaning, row.event_time
            kinds.append(kind)
        if meaning != before:
            self.held.update((meaning, newest))
        told = new.assign(kind=kinds)[lambda x: x["kind"] != "repeat"]
        yield told[[*self.keys, "event_time", "meaning", "kind"]]

    def close(self) -> None:
        pass


def corrections(stream: DataFrame, values: Sequence[str], keep_ms: int | None = None, keys: Sequence[str] = (*IDENTITY, "trade_date")) -> DataFrame:
    """Keys, event_time, meaning (the values as canonical JSON) and kind of each row of the stream that is news.

    kind: insert (the key's first row), correction (another meaning, not older than the accepted row), late (another
    meaning, but older; it changes nothing). Rows that say what is accepted already are repeats and give no row. A batch's
    rows of one key count in the order of event_time, then meaning. keep_ms: how long a key's state lives without a change;
    a row after that is an insert again. With it the stream looks for expired states even without new rows, so it runs until
    it is stopped, also where it is started for what is available now.
    """
    rows = stream.select(*keys, "event_time", canonical_json(list(values)).alias("meaning"))
    out = T.StructType([*[rows.schema[c] for c in (*keys, "event_time", "meaning")], T.StructField("kind", T.StringType())])
    return rows.groupBy(*keys).transformWithStateInPandas(_Corrections(keys, keep_ms), out, "Update", "ProcessingTime" if keep_ms else "None")
