"""Late quotes as a stream: each micro-batch replaces its instruments' overlap windows in the stored state."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.normalize import IDENTITY
from ..operators.reconcile import latest_per
from ..sources.lake import last_batch, partition_label, publish, read_dataset


def deduplicated(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """The stream's first row for each instrument and date, within the time that late rows may take."""
    return stream.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([*IDENTITY, "trade_date"])


def merge_batch(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored rows with the batch's laid over them: for one instrument and date, the batch's newest row wins."""
    newest = latest_per(batch, [*IDENTITY, "trade_date"], [F.col("event_time").desc(), *[F.col(c).desc() for c in batch.columns]])
    newest = newest.select(*stored.columns)
    return stored.join(newest.select(*IDENTITY, "trade_date"), [*IDENTITY, "trade_date"], "left_anti").unionByName(newest)


def publish_stream(stream: DataFrame, root: str, checkpoint: str, columns: list[str], published_at: datetime | None = None) -> StreamingQuery:
    """Publishes every micro-batch as the lake's next state, reading and writing only the partitions that it touches.

    The manifest holds the last batch of each stream, named by its checkpoint, so a batch that is repeated after a failure
    publishes nothing. published_at: one time for all batches; by default each batch's own.
    """
    schema, by = stream.select(*columns).schema, ["exchange", "code"]

    def apply(batch: DataFrame, number: int) -> None:
        if (done := last_batch(batch.sparkSession, root, checkpoint)) is not None and done >= number:
            return
        touched = batch.select(partition_label(by).alias("partition")).distinct()
        stored = read_dataset(batch.sparkSession, root, schema, touched)
        publish(merge_batch(stored, batch), root, by, published_at or datetime.now(UTC), partial=True, batch=(checkpoint, number))

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
