"""Stored history: windows per instrument, snapshots, raw merges, repairs, folds, and the decisions made from small counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import canonical_json, next_business_day, trimmed
from ..functions.equality import same_value
from .normalize import IDENTITY
from .reconcile import fingerprint


def guarded(rows: DataFrame, check: DataFrame, message: str) -> DataFrame:
    """The rows; an error when they are read if the check, one row with a boolean `ok`, isn't true."""
    held = check.select(F.when(F.coalesce("ok", F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")).alias("_ok"))
    return rows.join(F.broadcast(held), how="cross").filter("_ok").drop("_ok")  # one row


def _within(previous: DataFrame, starts: DataFrame) -> DataFrame:
    """previous with _refreshed and _inside: an event without a date can't lie before a window, so it lies inside."""
    windows = starts.select(*IDENTITY, F.col("start").alias("_start"), F.lit(True).alias("_refreshed"))
    held = previous.join(windows, list(IDENTITY), "left")
    inside = F.col("_refreshed").isNotNull() & ~F.coalesce(F.col("event_date") < F.col("_start"), F.lit(False))
    return held.withColumn("_inside", inside).withColumn("_refreshed", F.coalesce("_refreshed", F.lit(False)))


def reconcile_action_windows(previous: DataFrame, current: DataFrame, starts: DataFrame) -> DataFrame:
    """Merged events with their status, each instrument with a window of its own.

    previous, current: identity, event_date, event_key, status and more. starts: one row per refreshed instrument, with the
    inclusive first day of its window, or null if all its history lies inside. Events before the window and those of
    instruments that weren't refreshed stay. Inside, current events are active, and previous ones that are gone are retracted.
    """
    keys, columns = [*IDENTITY, "event_key"], previous.columns
    was = _within(previous, starts)
    now = current.dropDuplicates(keys).withColumn("status", F.lit("active")).select(*columns)
    left = was.join(now.select(*keys), keys, "left_anti")
    status = F.when(F.col("_inside"), F.lit("retracted")).otherwise(F.col("status"))
    return left.withColumn("status", status).select(*columns).unionByName(now)


def action_window_counts(previous: DataFrame, current: DataFrame, starts: DataFrame) -> DataFrame:
    """One row: added, removed, corrections (an added and a removed event of one instrument and date) and retractions."""
    keys = [*IDENTITY, "event_key"]
    was = _within(previous, starts).filter("_inside AND status = 'active'").select(*keys, "event_date", F.lit(1).alias("had"))
    now = current.dropDuplicates(keys).select(*keys, F.col("event_date").alias("date_now"), F.lit(1).alias("has"))
    both = was.join(now, keys, "full_outer").groupBy(*IDENTITY, F.coalesce("event_date", "date_now").alias("event_date"))
    by_date = both.agg(F.count(F.when(F.col("had").isNull(), 1)).alias("added"), F.count(F.when(F.col("has").isNull(), 1)).alias("removed"))
    pairs, total = F.least("added", "removed"), lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by_date.agg(total(F.col("added")).alias("added"), total(F.col("removed")).alias("removed"), total(pairs).alias("corrections"), total(F.col("removed") - pairs).alias("retractions"))


def replace_action_windows(previous: DataFrame, refreshed: DataFrame, starts: DataFrame) -> DataFrame:
    """Stored events with each refreshed instrument's window replaced, without retractions.

    An instrument with a start keeps what lies before it; one with a null start was refreshed whole and keeps its tombstones.
    A refreshed event wins over a kept one of its key, so it comes back to life.
    """
    keys, columns = [*IDENTITY, "event_key"], previous.columns
    was = _within(previous, starts)
    stays = ~F.col("_inside") | (F.col("_start").isNull() & F.col("_refreshed") & (F.col("status") == "retracted"))
    now = refreshed.dropDuplicates(keys).select(*columns)
    return was.filter(stays).select(*columns).join(now.select(*keys), keys, "left_anti").unionByName(now)


def active(rows: DataFrame) -> DataFrame:
    return rows.filter("status = 'active'")


def retracted(rows: DataFrame) -> DataFrame:
    return rows.filter("status = 'retracted'")


def deactivated(listings: DataFrame, current: DataFrame) -> DataFrame:
    """The listings; those that the current snapshot lacks are no longer active."""
    seen = current.select(*IDENTITY).distinct().withColumn("_seen", F.lit(True))
    return listings.join(seen, list(IDENTITY), "left").withColumn("is_active", F.col("is_active") & F.col("_seen").isNotNull()).drop("_seen")


def with_instrument_types(rows: DataFrame, types: DataFrame, on: Sequence[str]) -> DataFrame:
    """Adds instrument_type by lookup; unknown where the lookup has none."""
    one = types.groupBy(*on).agg(F.min("instrument_type").alias("instrument_type"))
    return rows.join(one, list(on), "left").withColumn("instrument_type", F.coalesce("instrument_type", F.lit("unknown")))


def key_integrity(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and whether they are as many. Keys without nulls are expected."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"), F.count("*").alias("key_count"))
    return counts.withColumn("unique", F.col("row_count") == F.col("key_count"))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that more than one row has, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def require_parents(child: DataFrame, parents: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    """The child rows; one whose parent is missing is an error that names it."""
    known = parents.select(*keys).distinct().withColumn("_known", F.lit(True))
    name = F.concat(F.lit("no listing for "), F.to_json(F.array(*[F.col(k).cast("string") for k in keys])))
    held = child.join(known, list(keys), "left").withColumn("_known", F.when(F.col("_known"), True).otherwise(F.raise_error(name).cast("boolean")))
    return held.filter("_known").drop("_known")


def canonical_rows(rows: DataFrame) -> Column:
    return canonical_json(rows.columns)


def positions(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds each row's position, from 1, among the rows of `by`; rows that tie in `order` come in the order of their canonical JSON."""
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy(*order, canonical_rows(rows))))


def snapshot_sorted(rows: DataFrame) -> DataFrame:
    """By exchange, code, date and isin, then canonical JSON. Sorted ranges are written as files in this order; Spark spills where it must."""
    return rows.orderBy("exchange", "code", "trade_date", "isin", canonical_rows(rows))


def actions_sorted(rows: DataFrame) -> DataFrame:
    return rows.orderBy("event_date", *IDENTITY, "event_key", "status")


def keys_sorted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.orderBy(*keys)


def merge_bronze_quotes(stored: DataFrame, incoming: DataFrame, order: str, tasks: int | None = None) -> DataFrame:
    """Stored raw quotes with the incoming ones laid over them by instrument and date; the last of `order` wins. Rows without a date go.

    tasks: into how many partitions the rows are dealt; the session's number by default.
    """
    rows = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1))).filter("date IS NOT NULL")
    rows = rows.repartition(tasks, *IDENTITY, "date") if tasks else rows
    last = F.row_number().over(Window.partitionBy(*IDENTITY, "date").orderBy(F.desc("_new"), F.desc(order), F.desc(canonical_json(stored.columns))))
    return rows.withColumn("_n", last).filter("_n = 1").drop("_n", "_new")


def replace_bronze_actions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored raw events; an instrument with incoming ones is replaced whole, so months that it no longer has go."""
    return stored.join(incoming.select(*IDENTITY).distinct(), list(IDENTITY), "left_anti").unionByName(incoming)


def bronze_dedup(prior: DataFrame, rows: DataFrame) -> DataFrame:
    """Prior and new raw rows, each different one once (by canonical JSON; a missing column counts as null)."""
    both = prior.unionByName(rows, allowMissingColumns=True)
    return both.withColumn("_json", canonical_rows(both)).dropDuplicates(["_json"]).drop("_json")


def listing_partitions(raw: DataFrame) -> DataFrame:
    """The raw listings with the columns that name their Bronze partition.

    A listing without a code is named by its content: unidentified- and 16 digits of its canonical JSON's SHA-256.
    """
    given = {c.lower(): c for c in raw.columns}
    text = lambda name: trimmed(F.col(given[name])) if name in given else F.lit(None).cast("string")
    own = F.concat(F.lit("unidentified-"), F.substring(F.sha2(canonical_rows(raw), 256), 1, 16))
    made = {"symbol": F.coalesce(text("code"), own), "partition_exchange": F.coalesce(text("exchange"), F.lit("unknown")), "partition_type": F.coalesce(F.lower(text("type")), F.lit("unknown")), "timeframe": F.lit("static")}
    return raw.withColumns(made)


def gold_artifacts(rows: DataFrame, feature_hash: str) -> DataFrame:
    """One row per exchange and code: row_count, source_hash and the content-addressed file name."""
    prints = fingerprint(rows, ["exchange", "code"]).withColumnRenamed("fingerprint", "source_hash")
    return prints.withColumn("file", F.concat("code", F.lit(f"_GOLD_{feature_hash}_"), "source_hash", F.lit(".parquet")))


def sidecar_state(retractions: DataFrame, key: str = "event_key") -> DataFrame:
    """One row on a retraction sidecar: rows, distinct keys, whether all are retracted once, and a fingerprint of its keys."""
    counts = retractions.agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("key_count"), F.count(F.when(F.col("status").eqNullSafe("retracted"), 1)).alias("n"))
    print_ = fingerprint(retractions.select(key), []).select(F.col("fingerprint"))
    return counts.select("row_count", "key_count", ((F.col("row_count") == F.col("key_count")) & (F.col("row_count") == F.col("n"))).alias("valid")).join(F.broadcast(print_), how="cross")  # one row each


def noop_decision(desired: DataFrame, state: DataFrame, serving: DataFrame) -> DataFrame:
    """One row: whether nothing has to be written, and the parts of that: fingerprint, row count and serving count as in the state.

    state: one row of fingerprint, row_count and serving_count. serving: the table that readers see.
    """
    now = fingerprint(desired, []).select(F.col("fingerprint").alias("_print"), F.col("row_count").alias("_rows"))
    seen = serving.agg(F.count("*").alias("_serving"))
    joined = state.join(F.broadcast(now), how="cross").join(F.broadcast(seen), how="cross")  # one row each
    parts = joined.select((F.col("fingerprint") == F.col("_print")).alias("same_rows"), (F.col("row_count") == F.col("_rows")).alias("same_count"), (F.col("serving_count") == F.col("_serving")).alias("same_serving"))
    return parts.withColumn("noop", F.col("same_rows") & F.col("same_count") & F.col("same_serving"))


def state_counts(rows: DataFrame) -> DataFrame:
    """One row: row_count counts tombstones, serving_count doesn't."""
    return rows.agg(F.count("*").alias("row_count"), F.count(F.when(F.col("status") == "active", 1)).alias("serving_count"))


def quarantine_matches(bronze: DataFrame, quarantined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per quarantined key: how many different records the raw rows give for it. One is a repair, none or more is an error."""
    rows = bronze.join(quarantined.select(*keys).distinct(), list(keys), "left_semi")
    values = [c for c in bronze.columns if c not in keys]
    found = rows.groupBy(*keys).agg(F.countDistinct(F.struct(*[F.coalesce(F.to_json(F.struct(c), {"ignoreNullFields": "false"}), F.lit("")).alias(c) for c in values])).alias("records"))
    return quarantined.select(*keys).distinct().join(found, list(keys), "left").withColumn("records", F.coalesce("records", F.lit(0).cast("long")))


def repaired(gold: DataFrame, bronze: DataFrame, quarantined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """gold with the quarantined rows recovered from the raw ones.

    An error if a key has no record or several, or if gold has the key already, so the counts add up.
    """
    wanted = quarantined.select(*keys).distinct()
    recovered = bronze.join(wanted, list(keys), "left_semi").dropDuplicates().select(*gold.columns)
    bad = quarantine_matches(bronze, quarantined, keys).agg(F.coalesce(F.sum(F.when(F.col("records") != 1, 1)), F.lit(0)).alias("bad"))
    known = gold.join(wanted, list(keys), "left_semi").agg(F.count("*").alias("known"))
    check = bad.join(F.broadcast(known), how="cross").select(((F.col("bad") == 0) & (F.col("known") == 0)).alias("ok"))  # one row each
    return guarded(gold.unionByName(recovered), check, "quarantined rows are missing, ambiguous or already there")


def fold_issues(rows: DataFrame, fold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of counts: keys in two splits, rows outside the fold, fold keys without a row, training keys."""
    splits = fold.groupBy(*keys).agg(F.countDistinct("split").alias("splits"), F.count(F.when(F.col("split") == "train", 1)).alias("train"))
    have = rows.select(*keys).distinct().withColumn("_row", F.lit(True))
    count = lambda c: F.count(F.when(c, 1))
    both = splits.join(have, list(keys), "full_outer")
    return both.agg(count(F.col("splits") > 1).alias("overlapping"), count(F.col("splits").isNull()).alias("outside"), count(F.col("_row").isNull()).alias("unknown"), count(F.col("train") > 0).alias("training"))


def split_rows(rows: DataFrame, fold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with their split; the fold must give every row exactly one, name no other row, and have a training row."""
    check = fold_issues(rows, fold, keys).select(((F.col("overlapping") + F.col("outside") + F.col("unknown") == 0) & (F.col("training") > 0)).alias("ok"))
    return guarded(rows.join(fold.select(*keys, "split").distinct(), list(keys)), check, "the fold doesn't cover the rows exactly")


def source_fingerprint(rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row: row count and fingerprint of the selected values alone."""
    return fingerprint(rows.select(*keys, *features), [])


def compared(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of both sides, whether each has a row, and whether the rows mean the same (same_value, over all columns of either).

    Columns are matched by name in any case; one that a side lacks is null. Rows that repeat a key are paired in the order
    of their canonical JSON. Keys are compared as text.
    """

    def side(df: DataFrame, what: str) -> DataFrame:
        given = {c.lower(): c for c in df.columns}
        held = F.struct(F.lit(None).cast("int").alias("_"), *[F.col(c).alias(n) for n, c in given.items() if n not in low])
        named = [F.coalesce(F.col(given[k]).cast("string"), F.lit("\0")).alias(k) for k in low]
        n = F.row_number().over(Window.partitionBy(*low).orderBy(F.to_json(what, {"ignoreNullFields": "false"})))
        return df.select(*named, held.alias(what)).withColumn("_n", n)

    low = [k.lower() for k in keys]
    a, b = side(expected, "_a"), side(actual, "_b")
    both = a.join(b, [*low, "_n"], "full_outer")
    same = same_value(F.col("_a"), a.schema["_a"].dataType, F.col("_b"), b.schema["_b"].dataType)
    has = lambda c: F.col(c).isNotNull()
    named = [F.nullif(F.col(k), F.lit("\0")).alias(old) for k, old in zip(low, keys)]
    return both.select(*named, has("_a").alias("expected"), has("_b").alias("actual"), (has("_a") & has("_b") & same).alias("same"))


def round_trip_differences(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: expected rows without an equal actual row (lost), and actual rows without an equal expected one (new)."""
    count = lambda c: F.count(F.when(F.col(c) & ~F.col("same"), 1)).alias
    return compared(expected, actual, keys).agg(count("expected")("lost"), count("actual")("new"))


def quote_issues(raw: DataFrame) -> DataFrame:
    """One row on provider quotes as text: blank identities, numbers that are no finite decimal, volumes that are negative or broken."""
    count = lambda c: F.count(F.when(F.coalesce(c, F.lit(False)), 1))
    blank, odd = F.lit(False), F.lit(False)
    for c in IDENTITY:
        blank |= trimmed(F.col(c)).isNull()
    for c in ("open", "high", "low", "close", "adjusted_close", "volume"):
        odd |= trimmed(F.col(c)).isNotNull() & trimmed(F.col(c)).try_cast("decimal(38,18)").isNull()
    volume = trimmed(F.col("volume")).try_cast("decimal(38,18)")
    return raw.agg(count(blank).alias("blank_identity"), count(odd).alias("not_finite"), count((volume < 0) | (volume != F.floor(volume))).alias("bad_volume"))


def audit_issues(rows: DataFrame) -> DataFrame:
    """One row on fetched_at_utc and published_at_utc: rows that lack one, and rows that were fetched after they were published."""
    lacks = F.col("fetched_at_utc").isNull() | F.col("published_at_utc").isNull()
    return rows.agg(F.count(F.when(lacks, 1)).alias("missing"), F.count(F.when(F.col("fetched_at_utc") > F.col("published_at_utc"), 1)).alias("fetched_late"))


def with_eod_time(rows: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """timestamp_eod: midnight UTC of the trade date."""
    return rows.withColumn("timestamp_eod", F.to_timestamp(F.to_date(date_col)))


def available_on(kind: str, rows: DataFrame) -> Column:
    """The business day from which a row of quotes, dividends, splits or listings may be used; listings count from their publication."""
    source = {"quotes": "trade_date", "dividends": "event_date", "splits": "event_date", "listings": "published_at_utc"}[kind]
    return next_business_day(F.to_date(rows[source]))


def payload_rows(raw: DataFrame, schema: str, column: str = "payload_json") -> DataFrame:
    """Legacy rows that hold their fields as JSON text, with the fields as columns; text that isn't such JSON is an error."""
    rest = [c for c in raw.columns if c != column]
    kind = T.StructType.fromDDL(schema)
    parsed = raw.select(*rest, F.from_json(column, kind, {"mode": "FAILFAST"}).alias("_p"))
    return parsed.select(*rest, *[F.col(f"_p.{f.name}") for f in kind.fields])
