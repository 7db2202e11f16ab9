"""Registered queries of the reconciliation operators, on rows derived from the star-schema tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.canonical import canonical_decimal, event_key, next_business_day
from .operators.normalize import IDENTITY, normalize_listings, violations
from .operators.reconcile import (
    action_counts, changed_instruments, difference, digests, duplicate_count, fetched_at, fingerprint, key_differences,
    last_dates, latest_per, merge_lifecycle, missing_rows, mutation_counts, orphans, reconcile_actions, replace_quote_window, upserted,
)
from .operators.standardize import fold_statistics, standardize
from .sources.lake import quarantined_keys
from .sources.market_tables import QUOTES_SQL, quotes, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
KEYS = [*IDENTITY, "trade_date"]
_DAY = "(year(trade_date) * 372 + month(trade_date) * 31 + day(trade_date))"


def _query(name: str, sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name], SQL[name] = f, sql
        return f

    return register


# Two versions of the quotes: the stored one lacks some days, has others too many, and differs in some volumes.
_Q = f"q AS (SELECT isin, exchange, code, trade_date, close, volume FROM ({QUOTES_SQL}) AS x)"
_VERSIONS = f"""{_Q},
desired AS (SELECT *, CAST(2 AS INT) AS run_id FROM q WHERE {_DAY} % 17 <> 0),
current AS (SELECT isin, exchange, code, trade_date, close, CASE WHEN {_DAY} % 13 = 0 THEN volume + 1 ELSE volume END AS volume, CAST(1 AS INT) AS run_id FROM q WHERE {_DAY} % 19 <> 0)"""


def _versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    q = quotes(spark, d).select(*KEYS, "close", "volume")
    desired = q.filter(f"{_DAY} % 17 <> 0").withColumn("run_id", F.lit(2))
    current = q.filter(f"{_DAY} % 19 <> 0").withColumn("volume", F.expr(f"CASE WHEN {_DAY} % 13 = 0 THEN volume + 1 ELSE volume END")).withColumn("run_id", F.lit(1))
    return desired, current


_ON = " AND ".join(f"a.{k} = b.{k}" for k in KEYS)
_KEYS = ", ".join(KEYS)
_BOTH = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in KEYS)
_DISTINCT = "(a.close IS DISTINCT FROM b.close OR a.volume IS DISTINCT FROM b.volume)"


@_query("desired_current_diff", f"WITH {_VERSIONS} SELECT {_BOTH}, CASE WHEN b.isin IS NULL THEN 'insert' WHEN a.isin IS NULL THEN 'delete' ELSE 'update' END AS op FROM desired a FULL JOIN current b ON {_ON} WHERE a.isin IS NULL OR b.isin IS NULL OR {_DISTINCT}")
def desired_current_diff(spark: SparkSession, d: str) -> DataFrame:
    return difference(*_versions(spark, d), KEYS)


@_query("quote_delta_classify", f"WITH {_VERSIONS} SELECT coalesce(sum(CASE WHEN b.isin IS NULL THEN 1 END), 0)::BIGINT AS inserted, coalesce(sum(CASE WHEN a.isin IS NULL THEN 1 END), 0)::BIGINT AS deleted, coalesce(sum(CASE WHEN a.isin IS NOT NULL AND b.isin IS NOT NULL AND {_DISTINCT} THEN 1 END), 0)::BIGINT AS corrected FROM desired a FULL JOIN current b ON {_ON}")
def quote_delta_classify(spark: SparkSession, d: str) -> DataFrame:
    count = lambda op: F.coalesce(F.sum(F.when(F.col("op") == op, 1)), F.lit(0)).cast("long")
    return difference(*_versions(spark, d), KEYS).agg(count("insert").alias("inserted"), count("delete").alias("deleted"), count("update").alias("corrected"))


_STATUS = "CASE WHEN volume % 5 = 0 THEN 'retracted' ELSE 'active' END AS status"


@_query("mutation_counts", f"""WITH {_VERSIONS}, a AS (SELECT *, {_STATUS} FROM desired), b AS (SELECT *, CASE WHEN volume % 10 = 0 THEN 'retracted' ELSE 'active' END AS status FROM current),
k AS (SELECT CASE WHEN a.status = 'retracted' AND b.status IS DISTINCT FROM 'retracted' THEN 'r' WHEN b.isin IS NULL THEN 'i' WHEN a.isin IS NULL THEN 'd' WHEN a.status <> b.status OR {_DISTINCT} THEN 'u' END AS k FROM a FULL JOIN b ON {_ON}),
n AS (SELECT count(*) FILTER (k = 'i') AS inserted, count(*) FILTER (k = 'u') AS updated, count(*) FILTER (k = 'd') AS deleted, count(*) FILTER (k = 'r') AS retracted, count(k) AS total FROM k) SELECT * FROM n""")
def mutation_counts_row(spark: SparkSession, d: str) -> DataFrame:
    desired, current = _versions(spark, d)
    return mutation_counts(desired.withColumn("status", F.expr(_STATUS.removesuffix(" AS status"))), current.withColumn("status", F.expr("CASE WHEN volume % 10 = 0 THEN 'retracted' ELSE 'active' END")), KEYS, "status")


@_query("upsert_result", f"WITH {_VERSIONS} SELECT {', '.join('a.' + k for k in KEYS)}, a.close, a.volume, CASE WHEN b.isin IS NOT NULL AND NOT {_DISTINCT} THEN b.run_id ELSE a.run_id END AS run_id FROM desired a LEFT JOIN current b ON {_ON}")
def upsert_result(spark: SparkSession, d: str) -> DataFrame:
    return upserted(*_versions(spark, d), KEYS)


@_query("key_differences", f"WITH {_VERSIONS} SELECT (SELECT count(*) FROM (SELECT {_KEYS} FROM desired EXCEPT SELECT {_KEYS} FROM current)) AS missing, (SELECT count(*) FROM (SELECT {_KEYS} FROM current EXCEPT SELECT {_KEYS} FROM desired)) AS extra")
def key_difference_counts(spark: SparkSession, d: str) -> DataFrame:
    return key_differences(*_versions(spark, d), KEYS)


@_query("missing_rows", f"WITH {_VERSIONS}, w AS (SELECT {_KEYS}, close, volume, count(*) AS n FROM desired GROUP BY ALL), h AS (SELECT {_KEYS}, close, volume, count(*) AS n FROM current GROUP BY ALL) SELECT coalesce(sum(greatest(w.n - coalesce(h.n, 0), 0)), 0)::BIGINT AS missing FROM w LEFT JOIN h USING ({_KEYS}, close, volume)")
def missing_row_count(spark: SparkSession, d: str) -> DataFrame:
    return missing_rows(*(x.drop("run_id") for x in _versions(spark, d)))


@_query("date_bounds", f"WITH {_Q} SELECT isin, exchange, code, min(trade_date) AS first_date, max(trade_date) AS last_date, count(*) AS n FROM q GROUP BY isin, exchange, code")
def date_bounds(spark: SparkSession, d: str) -> DataFrame:
    return quotes(spark, d).groupBy(*IDENTITY).agg(F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"), F.count("*").alias("n"))


@_query("quote_window_replace", f"""WITH {_VERSIONS}, last AS (SELECT isin, exchange, code, max(trade_date) AS d FROM current GROUP BY isin, exchange, code),
fresh AS (SELECT a.* FROM desired a JOIN last l ON a.isin = l.isin AND a.exchange = l.exchange AND a.code = l.code WHERE a.trade_date >= l.d - 7)
SELECT c.* FROM current c JOIN last l ON c.isin = l.isin AND c.exchange = l.exchange AND c.code = l.code WHERE c.trade_date < l.d - 7 UNION ALL SELECT * FROM fresh""")
def quote_window_replace(spark: SparkSession, d: str) -> DataFrame:
    desired, current = _versions(spark, d)
    last = last_dates(current)
    fresh = desired.join(last, list(IDENTITY)).filter("trade_date >= date_sub(last_date, 7)").select(*desired.columns)
    return replace_quote_window(current, fresh, last)


@_query("row_digests", f"WITH {_Q} SELECT '[\"' || isin || '\",\"' || exchange || '\",\"' || code || '\",\"' || trade_date || '\"]' AS entity_key, sha256('tapewright:row:v1' || chr(10) || '{{\"code\":\"' || code || '\",\"exchange\":\"' || exchange || '\",\"isin\":\"' || isin || '\",\"trade_date\":\"' || trade_date || '\",\"volume\":' || volume || '}}') AS row_sha256 FROM q")
def row_digest_rows(spark: SparkSession, d: str) -> DataFrame:
    return digests(quotes(spark, d).select(*KEYS, "volume", F.current_timestamp().alias("fetched_at_utc")), KEYS)


def _print_sql(by: str) -> str:
    """The fingerprint of each group of `by` (a column and a comma, or nothing)."""
    digest = """sha256('tapewright:row:v1' || chr(10) || '{"code":"' || code || '","exchange":"' || exchange || '","trade_date":"' || trade_date || '","volume":' || volume || '}')"""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""WITH {_Q}, dig AS (SELECT {by}{digest} AS d FROM q),
b AS (SELECT {by}substr(d, 1, 3) AS bucket, count(*) AS n, sha256(string_agg(d, ',' ORDER BY d)) AS h FROM dig GROUP BY {by}substr(d, 1, 3))
SELECT {by}sum(n)::BIGINT AS row_count, sha256(string_agg(h, ',' ORDER BY bucket)) AS fingerprint FROM b {group}"""


@_query("gold_partition_hashes", _print_sql("isin, "))
def gold_partition_hashes(spark: SparkSession, d: str) -> DataFrame:
    return fingerprint(quotes(spark, d).select(*KEYS, "volume"), ["isin"])


@_query("dataset_fingerprint", _print_sql(""))
def dataset_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return fingerprint(quotes(spark, d).select("exchange", "code", "trade_date", "volume"), [])


@_query("latest_run_per_dataset", "SELECT o_orderpriority AS dataset, o_orderkey AS run_id, CAST(o_orderdate AS DATE) AS finished FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) AS x WHERE n = 1")
def latest_run_per_dataset(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "orders").select(F.col("o_orderpriority").alias("dataset"), F.col("o_orderkey").alias("run_id"), "o_orderdate")
    return latest_per(runs, ["dataset"], [F.col("o_orderdate").desc(), F.col("run_id").desc()]).select("dataset", "run_id", F.to_date("o_orderdate").alias("finished"))


@_query("availability", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + CASE isodow(o_orderdate) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INT AS available_on FROM orders")
def availability(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", next_business_day(F.to_date("o_orderdate")).alias("available_on"))


def _raw_listings(spark: SparkSession, d: str) -> DataFrame:
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    isin = F.when(F.col("s_suppkey") % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" s"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")))
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", isin.alias("Isin"), F.lit("xtst ").alias("Exchange"), F.col("s_name").alias("Code"), F.concat(F.lit(" "), "s_name").alias("Name"), F.lit("Common Stock").alias("Type"), F.lit("").alias("Currency"), F.col("n_name").alias("Country"))


def _listing_sql(active: str, where: str) -> str:
    return f"SELECT upper('S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0')) AS isin, 'XTST' AS exchange, trim(s_name) AS code, trim(s_name) AS name, 'Common Stock' AS instrument_type, CAST(NULL AS VARCHAR) AS currency, trim(n_name) AS country, {active} AS is_active FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 0 AND {where}"


@_query("listing_normalize", _listing_sql("true", "true"))
def listing_normalize(spark: SparkSession, d: str) -> DataFrame:
    return normalize_listings(_raw_listings(spark, d), True)


@_query("listing_lifecycle", f"""SELECT isin, exchange, code, name, instrument_type, currency, country, is_active FROM (SELECT *, row_number() OVER (PARTITION BY isin, exchange, code ORDER BY r) AS n FROM (
SELECT *, 0 AS r FROM ({_listing_sql('true', 's_suppkey % 2 = 0')}) UNION ALL SELECT *, 1 FROM ({_listing_sql('false', 's_suppkey % 3 = 0')}) UNION ALL SELECT *, 2 FROM ({_listing_sql('false', 's_suppkey % 5 <> 1')}))) AS x WHERE n = 1""")
def listing_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw_listings(spark, d)
    return merge_lifecycle(normalize_listings(raw.filter("s_suppkey % 2 = 0"), True), normalize_listings(raw.filter("s_suppkey % 3 = 0"), False), normalize_listings(raw.filter("s_suppkey % 5 <> 1"), False))


@_query("orphans", f"WITH {_Q}, l AS ({_listing_sql('true', 'true')}) SELECT DISTINCT q.isin, q.exchange, q.code FROM q WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.isin = q.isin AND l.exchange = q.exchange AND l.code = q.code)")
def orphan_listings(spark: SparkSession, d: str) -> DataFrame:
    return orphans(quotes(spark, d), listing_normalize(spark, d))


@_query("duplicates", "SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS x")
def duplicates(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_count(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("constraint_violations", "SELECT 'quantity' AS rule, count(*) FILTER (NOT l_quantity >= 10) AS n FROM lineitem UNION ALL SELECT 'flag', count(*) FILTER (NOT regexp_matches(l_returnflag, '^[AN]$')) FROM lineitem")
def constraint_violations(spark: SparkSession, d: str) -> DataFrame:
    return violations(table(spark, d, "lineitem"), {"quantity": F.col("l_quantity") >= 10, "flag": F.col("l_returnflag").rlike("^[AN]$")})


# Dividends: one event per order; the stored state holds other events than the new snapshot.
_START = "DATE '1996-01-01'"
_EVENT_SQL = """SELECT 'C' || o_custkey AS isin, 'XTST' AS exchange, 'C' AS code, CAST(o_orderdate AS DATE) AS event_date, {value} AS value, 'EUR' AS currency, sha256('{{"business_fields":{{"currency":"EUR","event_date":"' || CAST(o_orderdate AS DATE) || '","isin":"C' || o_custkey || '","value":"' || {value} || '"}},"kind":"dividend"}}') AS event_key FROM orders WHERE {where}"""
_EVENTS = f"""p AS (SELECT DISTINCT *, 'active' AS status FROM ({_EVENT_SQL.format(value='CAST(o_orderkey % 5 AS BIGINT)', where='o_orderkey % 3 <> 0')}) AS x),
c AS (SELECT DISTINCT * FROM ({_EVENT_SQL.format(value='CAST(CASE WHEN o_orderkey % 11 = 0 THEN 9 ELSE o_orderkey % 5 END AS BIGINT)', where='o_orderkey % 4 <> 0')}) AS x WHERE event_date >= {_START})"""


def _events(spark: SparkSession, d: str, value: str, where: str) -> DataFrame:
    rows = table(spark, d, "orders").filter(where).select(F.expr("concat('C', o_custkey)").alias("isin"), F.lit("XTST").alias("exchange"), F.lit("C").alias("code"), F.to_date("o_orderdate").alias("event_date"), F.expr(value).cast("long").alias("value"), F.lit("EUR").alias("currency"))
    return rows.withColumn("event_key", event_key("dividend", ["isin", "event_date", "value", "currency"])).withColumn("status", F.lit("active")).distinct()


def _event_versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, Column]:
    start = F.lit("1996-01-01").cast("date")
    now = _events(spark, d, "CASE WHEN o_orderkey % 11 = 0 THEN 9 ELSE o_orderkey % 5 END", "o_orderkey % 4 <> 0").filter(F.col("event_date") >= start)
    return _events(spark, d, "o_orderkey % 5", "o_orderkey % 3 <> 0"), now, start


_EKEY = "a.isin = b.isin AND a.exchange = b.exchange AND a.code = b.code AND a.event_key = b.event_key"
_MERGED = f"""SELECT * FROM p WHERE event_date < {_START} UNION ALL SELECT *, 'active' AS status FROM c
UNION ALL SELECT a.* REPLACE ('retracted' AS status) FROM p a WHERE event_date >= {_START} AND NOT EXISTS (SELECT 1 FROM c b WHERE {_EKEY})"""


@_query("action_reconcile", f"WITH {_EVENTS} {_MERGED}")
def action_reconcile(spark: SparkSession, d: str) -> DataFrame:
    return reconcile_actions(*_event_versions(spark, d))


@_query("action_counts", f"""WITH {_EVENTS}, x AS (SELECT isin, event_date, 1 AS added, 0 AS removed FROM c a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE {_EKEY} AND b.event_date >= {_START})
UNION ALL SELECT isin, event_date, 0, 1 FROM p a WHERE event_date >= {_START} AND NOT EXISTS (SELECT 1 FROM c b WHERE {_EKEY})), y AS (SELECT sum(added) AS s, sum(removed) AS r FROM x GROUP BY isin, event_date)
SELECT coalesce(sum(s), 0)::BIGINT AS added, coalesce(sum(r), 0)::BIGINT AS removed, coalesce(sum(least(s, r)), 0)::BIGINT AS corrections, coalesce(sum(r - least(s, r)), 0)::BIGINT AS retractions FROM y""")
def action_count_row(spark: SparkSession, d: str) -> DataFrame:
    return action_counts(*_event_versions(spark, d))


@_query("action_changed_keys", f"WITH {_EVENTS}, m AS ({_MERGED}) SELECT DISTINCT isin, exchange, code FROM ((SELECT isin, exchange, code, event_key, status FROM p EXCEPT SELECT isin, exchange, code, event_key, status FROM m) UNION ALL (SELECT isin, exchange, code, event_key, status FROM m EXCEPT SELECT isin, exchange, code, event_key, status FROM p)) AS x")
def action_changed_keys(spark: SparkSession, d: str) -> DataFrame:
    before, now, start = _event_versions(spark, d)
    return changed_instruments(before, reconcile_actions(before, now, start))


@_query("event_keys", f"SELECT DISTINCT isin, event_date, value, event_key FROM ({_EVENT_SQL.format(value='CAST(o_orderkey % 5 AS BIGINT)', where='o_orderkey % 3 <> 0')}) AS x")
def event_keys(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, "o_orderkey % 5", "o_orderkey % 3 <> 0").select("isin", "event_date", "value", "event_key")


@_query("canonical_numbers", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS VARCHAR) ELSE rtrim(CAST(CAST(x AS DECIMAL(18,2)) AS VARCHAR), '0') END AS text FROM (SELECT *, l_extendedprice AS x FROM lineitem) AS y")
def canonical_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", canonical_decimal(F.col("l_extendedprice").cast("decimal(18,2)")).alias("text"))


_FOLD = "CASE WHEN l_orderkey % 10 < 7 THEN 'train' WHEN l_orderkey % 10 < 9 THEN 'validation' ELSE 'test' END"
_FOLD_NAMES = ("l_quantity", "l_discount", "constant")


def _fold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.expr(_FOLD).alias("split"), "l_quantity", "l_discount", F.lit(4.0).alias("constant"))


@_query("fold_standardize", f"WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, {_FOLD} AS split, l_quantity, l_discount FROM lineitem), s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd FROM f WHERE split = 'train') SELECT l_orderkey, l_linenumber, l_partkey, split, round((l_quantity - mq) / sq, 6) + 0.0::DOUBLE AS l_quantity, round((l_discount - md) / sd, 6) + 0.0::DOUBLE AS l_discount, CAST(NULL AS DOUBLE) AS constant FROM f, s")
def fold_standardize(spark: SparkSession, d: str) -> DataFrame:
    done = standardize(_fold(spark, d), _FOLD_NAMES)
    return done.select(*[c for c in done.columns if c not in _FOLD_NAMES], *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in _FOLD_NAMES])


@_query("fold_statistics", f"WITH f AS (SELECT {_FOLD} AS split, l_quantity, l_discount FROM lineitem) SELECT {', '.join(f'round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std, count({c}) AS {c}_count, min({c}) = max({c}) AS {c}_zero_variance' for c in _FOLD_NAMES[:2])} FROM f WHERE split = 'train'")
def fold_statistic_row(spark: SparkSession, d: str) -> DataFrame:
    stats = fold_statistics(_fold(spark, d), _FOLD_NAMES[:2])
    return stats.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in stats.dtypes])


_LOG = "concat(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), ' WARNING quarantined quote isin=S', o_custkey, ' exchange=XTST code=C', o_custkey % 7, ' date=', date_format(o_orderdate, 'yyyy-MM-dd'))"


@_query("quarantine_parse", "SELECT DISTINCT 'S' || o_custkey AS isin, 'XTST' AS exchange, 'C' || (o_custkey % 7) AS code, CAST(o_orderdate AS DATE) AS trade_date FROM orders WHERE o_orderkey % 5 = 0 AND o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-06-30 00:00:00'")
def quarantine_parse(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "orders").select(F.expr(f"CASE WHEN o_orderkey % 5 = 0 THEN {_LOG} ELSE 'INFO all is well' END").alias("value"))
    return quarantined_keys(lines, "1996-01-01 00:00:00", "1998-06-30 00:00:00")


@_query("fetch_times", f"WITH {_Q}, w AS (SELECT isin, exchange, code, make_date(y, 1, 1) AS s, make_date(y, 9, 30) AS e, y AS at FROM (SELECT DISTINCT isin, exchange, code, year(trade_date) AS y FROM q WHERE year(trade_date) % 2 = 0) AS z) SELECT q.isin, q.exchange, q.code, q.trade_date, coalesce(w.at, 0)::INT AS fetched_at_utc FROM q LEFT JOIN w ON q.isin = w.isin AND q.exchange = w.exchange AND q.code = w.code AND q.trade_date BETWEEN w.s AND w.e")
def fetch_times(spark: SparkSession, d: str) -> DataFrame:
    q = quotes(spark, d).select(*KEYS)
    years = q.select(*IDENTITY, F.year("trade_date").alias("at")).distinct().filter("at % 2 = 0")
    return fetched_at(q, years.select(*IDENTITY, F.expr("make_date(at, 1, 1)").alias("start_date"), F.expr("make_date(at, 9, 30)").alias("end_date"), "at"), F.lit(0))


_OVERLAPS = "SELECT isin, exchange, code, s, s + n * 40 AS e, n * 100 + k AS at FROM (SELECT DISTINCT isin, exchange, code FROM q) AS z, (SELECT unnest(range(1, 30))::INT AS k) AS x, (SELECT unnest(range(0, 3))::INT AS n) AS y, LATERAL (SELECT DATE '1992-01-01' + k * 83 AS s) AS t"


@_query("fetch_times_overlapping", f"WITH {_Q}, w AS ({_OVERLAPS}), m AS (SELECT q.isin, q.trade_date, arg_min(w.at, (w.s, w.e, w.at)) AS at FROM q JOIN w ON q.isin = w.isin AND q.trade_date BETWEEN w.s AND w.e GROUP BY ALL) SELECT q.isin, q.exchange, q.code, q.trade_date, coalesce(m.at, 0)::INT AS fetched_at_utc FROM q LEFT JOIN m USING (isin, trade_date)")
def fetch_times_overlapping(spark: SparkSession, d: str) -> DataFrame:
    """Windows that overlap and lie in each other: 87 for each instrument."""
    q = quotes(spark, d).select(*KEYS)
    windows = q.select(*IDENTITY).distinct().withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(29)))).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(2))))
    start = F.expr("date_add(DATE '1992-01-01', k * 83)")
    return fetched_at(q, windows.select(*IDENTITY, start.alias("start_date"), F.date_add(start, F.col("n") * 40).alias("end_date"), (F.col("n") * 100 + F.col("k")).alias("at")), F.lit(0))
