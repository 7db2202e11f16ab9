"""Registered queries of the sinks: each writes a lake from the star-schema tables, changes it, and reports what was written."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.normalize import IDENTITY
from .operators.ordering import enveloped_fingerprint, fingerprint_ranges, order_state
from .sources.lake import FOLDER, publish, read_dataset, read_manifest
from .sources.market_tables import QUOTES_SQL, placed_quotes, quotes, table
from .sources.scratch import scratch_path, written
from .sources.sinks import gold_files, sink_gold, sink_raw_actions, sink_raw_listings, sink_raw_quotes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_AT = datetime(2026, 9, 1, tzinfo=UTC)
_DAY = date(2026, 9, 1)


def _query(name: str, sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name], SQL[name] = f, sql
        return f

    return register


# An index per region: its suppliers' volumes by day.
_INDEX = f"""x AS (SELECT 'R' || n_regionkey AS isin, trade_date AS date, strftime(trade_date, '%Y-%m') AS month, sum(volume)::BIGINT AS volume
FROM ({QUOTES_SQL}) AS q JOIN supplier ON s_suppkey = substr(isin, 2)::BIGINT JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"""


def _index(spark: SparkSession, d: str) -> DataFrame:
    region = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # one row per nation
    joined = quotes(spark, d).join(region, F.substring("isin", 2, 9).cast("bigint") == F.col("s_suppkey"))
    return joined.groupBy(F.concat(F.lit("R"), F.col("n_regionkey")).alias("isin"), F.lit("XTST").alias("exchange"), F.lit("R").alias("code"), F.col("trade_date").alias("date")).agg(F.sum("volume").alias("volume"))


def _by_partition(spark: SparkSession, root: str, rows: DataFrame, before: DataFrame) -> DataFrame:
    """isin, month, row_count and volume as they lie in the lake, and whether the file is the one from before."""
    held = read_dataset(spark, root, rows.schema).groupBy("isin", "month").agg(F.count("*").alias("row_count"), F.sum("volume").alias("volume"))
    part = lambda k: F.regexp_extract("partition", k, 1)
    paths = read_manifest(spark, root).select(part("isin=([^/]*)").alias("isin"), part("month=([^/]*)").alias("month"), "path")
    return held.join(paths, ["isin", "month"]).join(before.select("path", F.lit(True).alias("kept")), "path", "left").select("isin", "month", "row_count", "volume", F.coalesce("kept", F.lit(False)).alias("kept"))


@_query("raw_quote_sink", f"""WITH {_INDEX}, s AS (SELECT isin, month, CASE WHEN month = '1996-03' THEN volume + 1 ELSE volume END AS volume FROM x WHERE month < '1997-01' OR (isin = 'R0' AND month < '1997-06'))
SELECT isin, month, count(*) AS row_count, sum(volume)::BIGINT AS volume, month < '1997-01' AND month <> '1996-03' AS kept FROM s GROUP BY ALL""")
def raw_quote_sink(spark: SparkSession, d: str) -> DataFrame:
    """Two merges: the second changes one month, repeats another as it is, and adds months of one index."""
    root, rows = scratch_path(spark, "raw-quotes"), _index(spark, d).withColumn("seq", F.lit(0))
    sink_raw_quotes(rows.filter("date < DATE '1997-01-01'"), root, _AT, "seq")
    before = spark.createDataFrame(read_manifest(spark, root).select("path").collect(), "path string")  # one row per month of an index
    changed = rows.filter("date_format(date, 'yyyy-MM') = '1996-03'").withColumn("volume", F.col("volume") + 1)
    again = rows.filter("date_format(date, 'yyyy-MM') = '1996-05'")
    sink_raw_quotes(changed.union(again).union(rows.filter("isin = 'R0' AND date BETWEEN DATE '1997-01-01' AND DATE '1997-05-31'")), root, _AT, "seq")
    return _by_partition(spark, root, rows.withColumn("month", F.lit("")), before)


@_query("raw_action_sink", f"""WITH {_INDEX}, e AS (SELECT * FROM x WHERE day(date) % 7 = 0 AND month BETWEEN '1996-01' AND '1996-12'), s AS (SELECT * FROM e WHERE isin IN ('R3', 'R4') OR (isin IN ('R0', 'R1') AND month < '1996-07'))
SELECT isin, month, count(*) AS row_count, sum(volume)::BIGINT AS volume, true AS kept FROM s GROUP BY ALL""")
def raw_action_sink(spark: SparkSession, d: str) -> DataFrame:
    """The second fetch has half of the months of two instruments and none of a third."""
    root, rows = scratch_path(spark, "raw-actions"), _index(spark, d).filter("day(date) % 7 = 0 AND year(date) = 1996")
    all_ = rows.select(*IDENTITY).distinct()
    sink_raw_actions(rows, all_, root, _AT, _DAY)
    before = spark.createDataFrame(read_manifest(spark, root).select("path").collect(), "path string")  # one row per month of an index
    sink_raw_actions(rows.filter("isin IN ('R0', 'R1') AND month(date) < 7"), all_.filter("isin IN ('R0', 'R1', 'R2')"), root, _AT, _DAY)
    return _by_partition(spark, root, rows.withColumn("month", F.lit("")), before)


@_query("raw_listing_sink", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'new' ELSE 'old' END AS note, s_suppkey % 3 <> 0 AS first FROM supplier")
def raw_listing_sink(spark: SparkSession, d: str) -> DataFrame:
    """Two listing snapshots: the second leaves the partitions of the first as they are."""
    root = scratch_path(spark, "raw-listings")
    raw = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("Code"), F.lit("XTST").alias("Exchange"), F.lit("Fund").alias("Type"))
    sink_raw_listings(raw.filter("s_suppkey % 3 <> 0").withColumn("note", F.lit("old")), root, _AT, _DAY)
    name = F.regexp_extract("partition", "symbol=([^/]*)", 1).alias("name")
    names = read_manifest(spark, root).select(name)  # of the first snapshot, whatever is published later
    sink_raw_listings(raw.withColumn("note", F.lit("new")), root, _AT, _DAY, skip_existing=True)
    schema = "s_suppkey bigint, Code string, note string, symbol string"
    held = read_dataset(spark, root, spark.createDataFrame([], schema).schema)
    return held.join(names.withColumn("first", F.lit(True)), F.url_encode("symbol") == F.col("name"), "left").select("s_suppkey", "note", F.coalesce("first", F.lit(False)).alias("first"))


@_query("lake_part", f"""WITH {_INDEX}, part AS (SELECT * FROM x WHERE isin IN ('R1', 'R3') AND month >= '1995-07')
SELECT isin, count(*) AS row_count, sum(volume)::BIGINT AS volume, part_rows, part_volume, folders FROM x LEFT JOIN
  (SELECT isin, count(*) AS part_rows, sum(volume)::BIGINT AS part_volume, count(DISTINCT month) AS folders FROM part GROUP BY isin) AS p USING (isin) GROUP BY ALL""")
def lake_part(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a lake by index, beside the part of two indexes from one month on: its rows, and how many folders its scan holds."""
    root, rows = scratch_path(spark, "lake-part"), _index(spark, d).withColumn("month", F.date_format("date", "yyyy-MM"))
    publish(rows, root, ["isin", "month"], _AT)
    part = read_dataset(spark, root, rows.schema, where="isin IN ('R1', 'R3') AND month >= '1995-07'")
    scanned = part.groupBy("isin").agg(F.count("*").alias("part_rows"), F.sum("volume").alias("part_volume"), F.countDistinct(F.regexp_extract("_metadata.file_path", FOLDER, 1)).alias("folders"))
    whole = read_dataset(spark, root, rows.schema).groupBy("isin").agg(F.count("*").alias("row_count"), F.sum("volume").alias("volume"))
    return whole.join(scanned, "isin", "left")


@_query("gold_sink", f"SELECT exchange, code, count(*) AS row_count, substr(isin, 2)::BIGINT % 4 = 0 AS written, CASE WHEN substr(isin, 2)::BIGINT % 4 = 0 THEN 2 ELSE 1 END AS files FROM ({QUOTES_SQL}) AS q GROUP BY exchange, code, isin")
def gold_sink(spark: SparkSession, d: str) -> DataFrame:
    """The second state changes a quarter of the instruments; the others' files are not written again."""
    root, rows = scratch_path(spark, "gold"), written(placed_quotes(spark, d).select(*IDENTITY, "trade_date", "volume"), "gold-quotes")
    sink_gold(rows, root, "v5")
    plan = sink_gold(rows.withColumn("volume", F.expr("CASE WHEN CAST(substr(isin, 2) AS BIGINT) % 4 = 0 THEN volume + 1 ELSE volume END")), root, "v5")
    files = gold_files(spark, root).groupBy("exchange", "code").agg(F.countDistinct("file_name").cast("int").alias("files"))
    return plan.select("exchange", "code", "row_count", "written").join(files, ["exchange", "code"])


_DIGEST = """sha256('tapewright:row:v1' || chr(10) || '{"code":"' || code || '","exchange":"XTST","isin":"' || isin || '","trade_date":"' || trade_date || '","volume":' || volume || '}')"""
_KEY = """'["' || isin || '","XTST","' || code || '","' || trade_date || '"]'"""
_TOMB = """sha256('tapewright:row:v1' || chr(10) || '{"code":"' || code || '","exchange":"XTST","isin":"' || isin || '","trade_date":"' || trade_date || '"}')"""


def _ranges_sql(name: str, source: str, order: str) -> str:
    """Ranges of the rows (key, d) of source; a range begins where d begins with three zeros."""
    return f"{name}g AS (SELECT *, sum(CASE WHEN d LIKE '000%' THEN 1 ELSE 0 END) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS g FROM {source}), {name} AS (SELECT g, min(key) AS range_start, max(key) AS range_end, sum(n)::BIGINT AS n, sha256(string_agg(d, '' ORDER BY {order})) AS d, min(key) AS key FROM {name}g GROUP BY g)"


_PRINT = lambda name: f"(SELECT sha256(string_agg(d, ',' ORDER BY g)) FROM {name}2)"


@_query("enveloped_fingerprint", f"""WITH q AS (SELECT * FROM ({QUOTES_SQL}) AS x), a AS (SELECT {_KEY} AS key, 1 AS n, {_DIGEST} AS d FROM q WHERE volume % 9 <> 0), r AS (SELECT {_KEY} AS key, 1 AS n, {_TOMB} AS d FROM q WHERE volume % 9 = 0),
{_ranges_sql('a1', 'a', 'key')}, {_ranges_sql('a2', '(SELECT g AS o, key, n, d FROM a1)', 'o')}, {_ranges_sql('r1', 'r', 'key')}, {_ranges_sql('r2', '(SELECT g AS o, key, n, d FROM r1)', 'o')}
SELECT (SELECT count(*) FROM a) AS row_count, (SELECT count(*) FROM r) AS retracted_count, sha256('{{"retracted":"' || {_PRINT('r')} || '","rows":"' || {_PRINT('a')} || '"}}') AS fingerprint""")
def enveloped_fingerprint_row(spark: SparkSession, d: str) -> DataFrame:
    rows = written(quotes(spark, d).select(*IDENTITY, "trade_date", "volume"), "enveloped-quotes")
    keys = [*IDENTITY, "trade_date"]
    return enveloped_fingerprint(rows.filter("volume % 9 <> 0"), rows.filter("volume % 9 = 0"), keys, keys)


@_query("changed_ranges", f"""WITH q AS (SELECT * FROM ({QUOTES_SQL}) AS x), old AS (SELECT {_KEY} AS key, 1 AS n, {_DIGEST} AS d FROM q), new AS (SELECT {_KEY} AS key, 1 AS n, {_DIGEST} AS d FROM (SELECT isin, code, trade_date, CASE WHEN isin LIKE '%3' AND month(trade_date) = 5 AND day(trade_date) = 7 THEN volume + 1 ELSE volume END AS volume FROM q)),
{_ranges_sql('old1', 'old', 'key')}, {_ranges_sql('new1', 'new', 'key')}
SELECT range_start, range_end, n AS row_count, d AS range_sha256 FROM new1 WHERE d NOT IN (SELECT d FROM old1)""")
def changed_ranges(spark: SparkSession, d: str) -> DataFrame:
    """The ranges of keys in which two states differ."""
    rows, keys = quotes(spark, d).select(*IDENTITY, "trade_date", "volume"), [*IDENTITY, "trade_date"]
    now = rows.withColumn("volume", F.expr("CASE WHEN isin LIKE '%3' AND month(trade_date) = 5 AND day(trade_date) = 7 THEN volume + 1 ELSE volume END"))
    return fingerprint_ranges(now, keys).join(fingerprint_ranges(rows, keys).select("range_sha256"), "range_sha256", "left_anti").select("range_start", "range_end", "row_count", "range_sha256")


@_query("order_state", f"WITH q AS (SELECT isin, trade_date FROM ({QUOTES_SQL}) AS x) SELECT kind, (SELECT count(*) FROM q) AS row_count, CASE kind WHEN 'swapped' THEN (SELECT count(DISTINCT isin) - 1 FROM q) ELSE 0 END AS falls, 0::BIGINT AS ties, kind <> 'swapped' AS sorted, true AS \"unique\" FROM (VALUES ('sorted'), ('swapped')) AS k(kind)")
def order_state_rows(spark: SparkSession, d: str) -> DataFrame:
    """Stored quotes in the order of their keys, and the same files read as if dates came first and instruments after them, downwards."""
    path = scratch_path(spark, "sorted-quotes")
    quotes(spark, d).select("isin", "trade_date").orderBy("isin", "trade_date").write.parquet(path)
    held = spark.read.parquet(path)
    dated = held.withColumn("down", F.concat(F.lit("S"), F.lpad((F.lit(999999999) - F.substring("isin", 2, 9).cast("bigint")).cast("string"), 9, "0")))
    kinds = ((held, ["isin", "trade_date"], "sorted"), (dated, ["down", "trade_date"], "swapped"))
    a, b = (order_state(rows, keys).select(F.lit(kind).alias("kind"), "row_count", "falls", "ties", "sorted", "unique") for rows, keys, kind in kinds)
    return a.unionByName(b)
