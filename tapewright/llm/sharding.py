"""Sharding by a k-d tree over document metadata, in DataFrame functions only.

The tree splits every node at the weighted median (weight: bytes) of the dimension in which the node is widest, until
the leaves reach the target size. Medians are exact: each is found by histograms of a fixed number of bins, refined
until the bin that holds it is a single value, then among the ids of that value. Only one bin per node reaches the
driver. The rows are written once, as their sizes, checksums and axes; a level reads them three times where values are
few or dense (widths, values, ids) and once more for each further refinement.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialize

#: Bins of one histogram pass; so many passes narrow any 64-bit range to single values.
BINS = 4096
ROWS_PER_SLOT_BUCKET = 200_000
#: Stands for null ids and dimensions; values are held within -LEAST and LEAST, so that differences fit 64 bits.
LEAST = -(2**61)


@dataclass(frozen=True)
class Cut:
    """Rows of `node` with (dimension, id) below (value, id) go to the left child, and those at it too if `holds`. dim is the dimension's place in the axes."""

    node: int
    dim: int
    value: int
    id: int
    holds: bool


@dataclass(frozen=True)
class Span:
    """Where a node's cut lies: from lo to hi of a dimension, whose rows have so much size; goal: how much of it goes to the left."""

    dim: int
    lo: int
    hi: int
    size: int
    goal: float
    id_lo: int
    id_hi: int


def _small(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A table of one row per node; at most as many rows as there are shards, so it may be broadcast."""
    listed = ", ".join(f"({', '.join(str(v) for v in r)})" for r in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {listed} AS t({columns})"))


def _narrowed(rows: DataFrame, spans: dict[int, Span]) -> dict[int, Span]:
    """Each node's span narrowed to the single value at which the sizes, in the order of values, reach its goal.

    A pass counts BINS bins of each open span and goes on with the least and largest value of the bin that holds the goal,
    so dimensions of few values need one pass.
    """
    done = {n: s for n, s in spans.items() if s.lo == s.hi}
    while open_ := {n: s for n, s in spans.items() if n not in done}:
        # wide spans are binned by their values' halves, so that no difference leaves 64 bits
        half = {n: int(s.hi - s.lo >= 2**62) for n, s in open_.items()}
        width = {n: -(-((s.hi >> half[n]) - (s.lo >> half[n]) + 1) // BINS) for n, s in open_.items()}
        state = _small(rows.sparkSession, "node, dim, lo, hi, half, base, width, goal", [(n, s.dim, _long(s.lo), _long(s.hi), half[n], _long(s.lo >> half[n]), f"{width[n]}L", f"{s.goal!r}D") for n, s in open_.items()])
        value, last = F.get("axes", F.col("dim")), F.get("axes", F.size("axes") - 1)
        inside = rows.join(state, "node").withColumn("value", value).filter("value BETWEEN lo AND hi").withColumn("last", last)
        ends = [f(c).alias(n) for n, f, c in (("lo", F.min, "value"), ("hi", F.max, "value"), ("id_lo", F.min, "last"), ("id_hi", F.max, "last"))]
        bins = inside.groupBy("node", F.expr("(shiftright(value, half) - base) div width").alias("bin")).agg(F.sum("size").alias("size"), F.first("goal").alias("goal"), *ends)
        run = bins.withColumn("to", F.sum("size").over(Window.partitionBy("node").orderBy("bin")))  # BINS rows of a node at most
        found = run.filter(F.col("to") >= F.col("goal")).groupBy("node").agg(F.min(F.struct("bin", "to", "size", "lo", "hi", "id_lo", "id_hi")).alias("x")).select("node", "x.*").collect()
        for r in found:
            spans[r["node"]] = Span(open_[r["node"]].dim, r["lo"], r["hi"], r["size"], open_[r["node"]].goal - (r["to"] - r["size"]), r["id_lo"], r["id_hi"])
        done |= {r["node"]: spans[r["node"]] for r in found if r["lo"] == r["hi"]}
    return done


def _long(n: int) -> str:
    return f"{n}L" if n > -(2**63) else "CAST('-9223372036854775808' AS BIGINT)"


def _cuts(rows: DataFrame, spread: list[int]) -> list[Cut]:
    """The cut of every node: its widest axis, the weighted median there, and the median id among the rows with that value.

    Nulls don't count in an axis's width. The row at the median goes to the side that this leaves nearer to one half.
    """
    last = len(spread) - 1
    ends = [f(F.get("axes", F.lit(k))).alias(f"{e}{k}") for k in range(last + 1) for e, f in (("lo", F.min), ("hi", F.max))]
    known = [f(F.nullif(F.get("axes", F.lit(k)), F.lit(LEAST))).alias(f"{e}{k}") for k in range(last + 1) for e, f in (("from", F.min), ("to", F.max))]
    seen = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("size"), *ends, *known).collect()}
    wide = lambda r, k: (r[f"to{k}"] - r[f"from{k}"]) / max(1, spread[k]) if r[f"to{k}"] is not None else 0.0
    dim = {n: max(range(last + 1), key=lambda k: (r[f"hi{k}"] > r[f"lo{k}"], wide(r, k), -k)) for n, r in seen.items()}
    values = _narrowed(rows, {n: Span(dim[n], r[f"lo{dim[n]}"], r[f"hi{dim[n]}"], r["size"], r["size"] / 2, r[f"lo{last}"], r[f"hi{last}"]) for n, r in seen.items()})
    at = _small(rows.sparkSession, "node, dim, at", [(n, s.dim, _long(s.lo)) for n, s in values.items()])
    tied = rows.join(at, "node").filter(F.get("axes", F.col("dim")) == F.col("at")).select("node", "axes", "size")
    ids = _narrowed(tied, {n: Span(last, s.id_lo, s.id_hi, s.size, s.goal, s.id_lo, s.id_hi) for n, s in values.items()})
    out = []
    for n, s in ids.items():
        before = seen[n]["size"] / 2 - s.goal
        after = seen[n]["size"] - before - s.size
        out.append(Cut(n, dim[n], values[n].lo, s.lo, before <= 0 or (after > 0 and 2 * s.goal >= s.size)))
    return out


def kd_shards(docs: DataFrame, id_col: str, text_col: str, dims: dict[str, Column], n_shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard (0-based), slot (gapless within its shard).

    dims: names and integer-valued expressions over docs, the tree's axes beside the id. The depth is that of n_shards
    (a power of two) or the least at which the mean leaf holds at most target_bytes. Size is the UTF-8 bytes of the
    text plus 1; a null text counts as empty, with the checksum 0. Null ids and null dimensions sort as the smallest
    value, and nulls don't widen an axis; a null id comes back as null. Ids may be any 64-bit integers. Rows with equal ids
    have no order of their own and stay in one leaf. Rows with equal texts are shared out like others: a group of copies may
    be larger than a shard. A leaf is off the mean by less than the largest row (or group of rows of one id). An empty table
    gives no rows. Other columns are not read, so their names don't matter.
    """
    if (n_shards is None) == (target_bytes is None) or (n_shards and n_shards & (n_shards - 1)):
        raise ValueError("give n_shards, a power of two, or target_bytes")
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST))
    axes = F.array(*[F.greatest(F.lit(LEAST), F.least(F.lit(-LEAST), F.coalesce(c.cast("long"), F.lit(LEAST)))) for c in dims.values()], id_)
    keyed = docs.select(F.lit(1).alias("node"), axes.alias("axes"), F.col(id_col).isNull().alias("no_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = materialize(keyed, "kd-rows")
    ends = [f(F.nullif(F.get("axes", F.lit(k)), F.lit(LEAST))).alias(f"{e}{k}") for k in range(len(dims) + 1) for e, f in (("lo", F.min), ("hi", F.max))]
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *ends).collect()[0]
    if target_bytes:
        n_shards = 1
        while whole["bytes"] > n_shards * target_bytes and n_shards < max(1, whole["n"]):
            n_shards *= 2
    spread = [(whole[f"hi{k}"] or 0) - (whole[f"lo{k}"] or 0) for k in range(len(dims) + 1)]
    for _ in range(n_shards.bit_length() - 1 if whole["n"] else 0):
        state = _small(docs.sparkSession, "node, dim, at, id, holds", [(c.node, c.dim, _long(c.value), _long(c.id), c.holds) for c in _cuts(rows, spread)])
        own, last = F.get("axes", F.col("dim")), F.get("axes", F.lit(len(dims)))
        left = (own < F.col("at")) | ((own == F.col("at")) & ((last < F.col("id")) | (F.col("holds") & (last == F.col("id")))))
        rows = rows.join(state, "node").withColumn("node", 2 * F.col("node") + F.when(left, 0).otherwise(1)).select(*keyed.columns)
    first = 2 ** (n_shards.bit_length() - 1)
    placed = rows.select(F.get("axes", F.lit(len(dims))).alias("id"), "no_id", "size", "text_crc32", (F.col("node") - first).cast("int").alias("shard"))
    return _with_slots(placed, whole["n"]).select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "size", "text_crc32", "shard", "slot")


def _with_slots(placed: DataFrame, n_rows: int) -> DataFrame:
    """Numbers each shard's rows from 0 without gaps. Ids are hashed into small buckets, so that no task numbers a shard."""
    buckets = max(1, -(-n_rows // ROWS_PER_SLOT_BUCKET)) * 16
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("shard", "bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size"))
    return placed.withColumn("own", own).join(before, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("own") - 1)
