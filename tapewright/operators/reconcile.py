"""Snapshots against stored history: duplicates, lifecycles, deltas, corrections, retractions, upserts, verification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import AUDIT, canonical_decimal, canonical_json, entity_key, overlap_start, row_digest
from .normalize import IDENTITY

#: Types of which two values are equal if and only if their JSON is.
_EXACT = (T.StringType, T.IntegralType, T.DateType, T.DecimalType, T.BooleanType)


def _same(columns: Sequence[str], left: str = "a", right: str = "b") -> Column:
    """True where all columns are equal, nulls to nulls."""
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def distinct_or_error(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact duplicates collapse; two different rows with one key are an error."""
    once = rows.distinct()
    n = F.count("*").over(Window.partitionBy(*keys))
    checked = once.withColumn("_n", n).withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("conflicting rows for "), entity_key(keys))).cast("long")).otherwise(F.col("_n")))
    return checked.filter("_n = 1").drop("_n")


def merge_lifecycle(active: DataFrame, delisted: DataFrame, previous: DataFrame) -> DataFrame:
    """One row per identity: the active one, else the delisted one, else the previous one; only the first stays active."""
    columns = [c for c in previous.columns if c != "is_active"]
    ranked = None
    for rank, (df, is_active) in enumerate(((active, True), (delisted, False), (previous, False))):
        part = df.select(*columns, F.lit(is_active).alias("is_active"), F.lit(rank).alias("_rank"))
        ranked = part if ranked is None else ranked.unionByName(part)
    best = F.row_number().over(Window.partitionBy(*IDENTITY).orderBy("_rank"))
    return ranked.withColumn("_best", best).filter("_best = 1").drop("_rank", "_best")


def difference(desired: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys and op (insert, update, delete) of each row that differs; audit columns don't count."""
    values = [c for c in desired.columns if c not in (*keys, *AUDIT)]
    a, b = desired.withColumn("_in", F.lit(True)).alias("a"), current.withColumn("_in", F.lit(True)).alias("b")
    on = F.lit(True)
    for k in keys:
        on &= F.col(f"a.{k}") == F.col(f"b.{k}")
    op = F.when(F.col("b._in").isNull(), "insert").when(F.col("a._in").isNull(), "delete").when(~_same(values), "update")
    return a.join(b, on, "full_outer").select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys], op.alias("op")).filter("op IS NOT NULL")


def upserted(desired: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The desired rows; one that means the same as its current row keeps that row's audit columns."""
    values = [c for c in desired.columns if c not in (*keys, *AUDIT)]
    audit = [c for c in desired.columns if c in AUDIT]
    b = current.select(*keys, *values, *audit).withColumn("_in", F.lit(True)).alias("b")
    on = F.lit(True)
    for k in keys:
        on &= F.col(f"a.{k}") == F.col(f"b.{k}")
    kept = F.col("b._in").isNotNull() & _same(values)
    return desired.alias("a").join(b, on, "left").select(*[F.col(f"a.{c}") for c in (*keys, *values)], *[F.when(kept, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in audit])


def replace_quote_window(previous: DataFrame, refreshed: DataFrame, last_dates: DataFrame) -> DataFrame:
    """Previous rows before each instrument's window, and the refreshed rows. An instrument without a last date is replaced.

    last_dates: the identity and last_date. An instrument that wasn't refreshed is not in last_dates and stays whole if it
    has no refreshed rows.
    """
    start = last_dates.select(*IDENTITY, overlap_start(F.col("last_date")).alias("_start"))
    seen = refreshed.select(*IDENTITY).distinct().withColumn("_new", F.lit(True))
    kept = previous.join(start, list(IDENTITY), "left").join(seen, list(IDENTITY), "left")
    kept = kept.filter((F.col("trade_date") < F.col("_start")) | (F.col("_start").isNull() & F.col("_new").isNull())).select(*previous.columns)
    return kept.unionByName(refreshed)


def last_dates(rows: DataFrame, date_col: str = "trade_date") -> DataFrame:
    return rows.groupBy(*IDENTITY).agg(F.max(date_col).alias("last_date"))


def _inside(start: Column | None) -> Column:
    """Whether an event lies in the window; one without a date can't lie before it."""
    return ~F.coalesce(F.col("event_date") < start, F.lit(False)) if start is not None else F.lit(True)


def reconcile_actions(previous: DataFrame, current: DataFrame, start: Column | None = None) -> DataFrame:
    """Merged events with their status. previous, current: identity, event_date, event_key, status and more.

    Previous events before `start` are kept. From it on, current events are active, and previous ones that are gone are
    retracted. Without a start all previous events lie in the window. Equal content collapses.
    """
    keys = [*IDENTITY, "event_key"]
    inside = _inside(start)
    before = previous.filter(~inside)
    now = current.dropDuplicates(keys).withColumn("status", F.lit("active"))
    gone = previous.filter(inside).join(now.select(*keys), keys, "left_anti").withColumn("status", F.lit("retracted"))
    return before.join(now.select(*keys), keys, "left_anti").unionByName(now).unionByName(gone)


def action_counts(previous: DataFrame, current: DataFrame, start: Column | None = None) -> DataFrame:
    """One row: added, removed, corrections (an added and a removed event of one date) and retractions (the other removals)."""
    keys = [*IDENTITY, "event_key"]
    inside = _inside(start)
    was, now = previous.filter(inside & (F.col("status") == "active")), current.dropDuplicates(keys)
    added = now.join(was.select(*keys), keys, "left_anti").select(*IDENTITY, "event_date", F.lit(1).alias("added"), F.lit(0).alias("removed"))
    removed = was.join(now.select(*keys), keys, "left_anti").select(*IDENTITY, "event_date", F.lit(0).alias("added"), F.lit(1).alias("removed"))
    by_date = added.union(removed).groupBy(*IDENTITY, "event_date").agg(F.sum("added").alias("added"), F.sum("removed").alias("removed"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    pairs = F.least("added", "removed")
    return by_date.agg(zero(F.col("added")).alias("added"), zero(F.col("removed")).alias("removed"), zero(pairs).alias("corrections"), zero(F.col("removed") - pairs).alias("retractions"))


def changed_instruments(previous: DataFrame, merged: DataFrame) -> DataFrame:
    """Identities whose set of (event_key, status) changed; their quotes need a full refetch."""
    cols = [*IDENTITY, "event_key", "status"]
    a, b = previous.select(*cols).distinct(), merged.select(*cols).distinct()
    return a.exceptAll(b).union(b.exceptAll(a)).select(*IDENTITY).distinct()


def orphans(child: DataFrame, listings: DataFrame) -> DataFrame:
    return child.join(listings.select(*IDENTITY), list(IDENTITY), "left_anti").select(*IDENTITY).distinct()


def duplicate_count(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows are too many for unique keys."""
    return rows.groupBy(*keys).count().filter("count > 1").agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicates"))


def key_differences(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys that are missing and keys that are extra."""
    a, b = expected.select(*keys).distinct(), actual.select(*keys).distinct()
    missing = a.join(b, list(keys), "left_anti").agg(F.count("*").alias("missing"))
    return missing.crossJoin(b.join(a, list(keys), "left_anti").agg(F.count("*").alias("extra")))  # one row each


def digests(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(entity_key(keys).alias("entity_key"), row_digest(rows.columns).alias("row_sha256"))


def fingerprint(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group: row count and a fingerprint that the rows' order doesn't change.

    The group's row digests are hashed in 4,096 ordered buckets first, so no task holds all digests of a large group: it
    holds a bucket's, or the buckets' hashes.
    """
    digest = row_digest([c for c in rows.columns if c not in by])
    keyed = rows.select(*by, digest.alias("d")).withColumn("bucket", F.substring("d", 1, 3))
    buckets = keyed.groupBy(*by, "bucket").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ","), 256).alias("h"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda x: x["h"]), ",")
    return buckets.groupBy(*by).agg(F.sum("n").alias("row_count"), F.sha2(joined, 256).alias("fingerprint"))


def missing_rows(expected: DataFrame, actual: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """One row: how many rows, counted with repeats, the actual table lacks. Columns in numeric are compared as numbers, also where they are text."""
    number = {c: canonical_decimal(F.col(c).try_cast("decimal(38,18)")) for c in numeric}
    expected, actual = expected.withColumns(number), actual.withColumns(number)
    kinds = [{f.name: f.dataType for f in df.schema.fields} for df in (expected, actual)]
    by = [canonical_json(df.columns).alias("row") for df in (expected, actual)]
    if kinds[0] == kinds[1] and all(isinstance(t, _EXACT) for t in kinds[0].values()):
        rows = [df.select(*sorted(kinds[0])) for df in (expected, actual)]  # their values are as equal as their texts
    else:
        rows = [df.select(text) for df, text in zip((expected, actual), by)]
    both = rows[0].withColumn("_more", F.lit(1)).union(rows[1].withColumn("_more", F.lit(-1)))
    lacking = both.groupBy(*rows[0].columns).agg(F.sum("_more").alias("_more"))
    return lacking.agg(F.coalesce(F.sum(F.greatest("_more", F.lit(0))), F.lit(0)).cast("long").alias("missing"))


def latest_per(rows: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_n = 1").drop("_n")


def disjoint_windows(windows: DataFrame) -> DataFrame:
    """Identity, start_date, end_date and at of stretches that don't overlap: each day has the window that begins first, then ends first.

    A window holds the days after the last one of all windows before it.
    """
    order = Window.partitionBy(*IDENTITY).orderBy("start_date", "end_date", "at")
    before = F.max("end_date").over(order.rowsBetween(Window.unboundedPreceding, -1))
    start = F.greatest("start_date", F.date_add(before, 1))  # greatest skips nulls
    whole = windows.filter(" AND ".join(f"{c} IS NOT NULL" for c in (*IDENTITY, "start_date", "end_date")))
    return whole.select(*IDENTITY, start.alias("start_date"), "end_date", "at").filter("start_date <= end_date")


def fetched_at(rows: DataFrame, windows: DataFrame, default: Column) -> DataFrame:
    """Adds fetched_at_utc: of the fetch windows (identity, start_date, end_date, at) that hold the row's date, the first.

    Rows and the starts of disjoint windows go through one ordered pass for each identity, so no row is multiplied by windows.
    """
    starts = disjoint_windows(windows).select(*IDENTITY, F.col("start_date").alias("trade_date"), F.struct("end_date", "at").alias("_window"))
    both = rows.withColumn("_row", F.lit(True)).unionByName(starts.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    order = Window.partitionBy(*IDENTITY).orderBy("trade_date", "_row").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_window", F.last("_window", ignorenulls=True).over(order)).filter("_row")
    inside = F.col("trade_date") <= F.col("_window.end_date")
    return met.select(*rows.columns, F.coalesce(F.when(inside, F.col("_window.at")), default).alias("fetched_at_utc"))


def mutation_counts(desired: DataFrame, current: DataFrame, keys: Sequence[str], status: str | None = None) -> DataFrame:
    """One row: inserted, updated, deleted and retracted rows, and their total. Audit columns don't count.

    A row that is retracted now and wasn't before, new ones among them, is retracted and neither updated nor inserted.
    """
    values = [c for c in desired.columns if c not in (*keys, *AUDIT)]
    a, b = desired.withColumn("_in", F.lit(True)).alias("a"), current.withColumn("_in", F.lit(True)).alias("b")
    on = F.lit(True)
    for k in keys:
        on &= F.col(f"a.{k}") == F.col(f"b.{k}")
    here, there = F.col("a._in").isNotNull(), F.col("b._in").isNotNull()
    gone = F.lit(False) if status is None else F.col(f"a.{status}").eqNullSafe("retracted") & ~F.col(f"b.{status}").eqNullSafe("retracted")
    kind = F.when(here & gone, "retracted").when(~there, "inserted").when(~here, "deleted").when(~_same(values), "updated")
    counts = a.join(b, on, "full_outer").select(kind.alias("kind")).agg(*[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in ("inserted", "updated", "deleted", "retracted")])
    return counts.withColumn("total", F.col("inserted") + F.col("updated") + F.col("deleted") + F.col("retracted"))
