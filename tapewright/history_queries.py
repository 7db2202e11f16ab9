"""Registered queries of the normalizers and of stored history, on rows derived from the star-schema tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .market_queries import _DAY, _EVENT_SQL, _KEYS, _Q, _VERSIONS, KEYS, _events, _listing_sql, _raw_listings, _versions
from .operators.history import (
    action_window_counts, audit_issues, available_on, bronze_dedup, compared, deactivated, fold_issues, gold_artifacts, key_integrity, listing_partitions, merge_bronze_quotes, noop_decision, payload_rows,
    positions, quarantine_matches, quote_issues, reconcile_action_windows, repaired, repeated_keys, replace_action_windows, replace_bronze_actions, round_trip_differences, sidecar_state,
    source_fingerprint, split_rows, state_counts, with_eod_time, with_instrument_types,
)
from .operators.normalize import IDENTITY, normalize_dividends, normalize_listings, normalize_quotes, normalize_splits
from .operators.reconcile import fingerprint, missing_rows
from .operators.standardize import standardize_fold
from .sources.market_tables import QUOTES_SQL, quotes, table
from .sources.scratch import tasks_for, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_PRICES = ("open", "high", "low", "close", "adjusted_close")


def _query(name: str, sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name], SQL[name] = f, sql
        return f

    return register


def _all_quotes_sql() -> str:
    return _Q.replace("SELECT isin, exchange, code, trade_date, close, volume FROM", "SELECT * FROM")


# Provider quotes as text: every fifth day lacks one of the prices.
def _raw_quotes(spark: SparkSession, d: str) -> DataFrame:
    prices = [F.expr(f"CASE WHEN day(trade_date) % 5 = {k} THEN ' ' ELSE CAST(CAST({c} AS DECIMAL(18,4)) AS STRING) END").alias(c) for k, c in enumerate(_PRICES)]
    return quotes(spark, d).select(*IDENTITY, F.col("trade_date").cast("string").alias("date"), *prices, F.col("volume").cast("string").alias("volume"))


_NORMAL_PRICES = ", ".join(f"CASE WHEN day(trade_date) % 5 <> {k} THEN CAST(CAST({c} AS DECIMAL(18,4)) AS DOUBLE) END AS {c}" for k, c in enumerate(_PRICES))


@_query("quote_normalize", f"WITH {_all_quotes_sql()} SELECT {_KEYS}, {_NORMAL_PRICES}, volume FROM q")
def quote_normalize(spark: SparkSession, d: str) -> DataFrame:
    done = normalize_quotes(_raw_quotes(spark, d))
    return done.select(*KEYS, *[F.col(c).cast("double").alias(c) for c in _PRICES], "volume")


_DIVIDEND = """'C' || o_custkey AS isin, CAST(o_orderdate AS DATE) AS event_date, CAST(o_orderdate AS DATE) + 10 AS payment_date, CASE WHEN o_orderkey % 2 = 1 THEN 'Q' END AS period, (o_orderkey % 7) || '.25' AS amount"""


@_query("dividend_normalize", f"""WITH r AS (SELECT o_orderkey, {_DIVIDEND} FROM orders)
SELECT o_orderkey, isin, 'XTST' AS exchange, 'C' AS code, event_date, payment_date, period, CAST(amount AS DOUBLE) AS value, 'active' AS status,
sha256('{{"business_fields":{{"code":"C","currency":"EUR","declaration_date":null,"event_date":"' || event_date || '","exchange":"XTST","isin":"' || isin || '","payment_date":"' || CAST(payment_date AS DATE) || '","period":' || coalesce('"' || period || '"', 'null') || ',"record_date":null,"value":"' || amount || '0000000000000000"}},"kind":"dividend"}}') AS event_key FROM r""")
def dividend_normalize(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    raw = table(spark, d, "orders").select("o_orderkey", F.expr("concat('C', o_custkey)").alias("isin"), F.lit("XTST").alias("exchange"), F.lit(" C").alias("code"), day.cast("string").alias("date"), F.date_add(day, 10).cast("string").alias("paymentDate"), F.expr("CASE WHEN o_orderkey % 2 = 1 THEN 'Q ' ELSE '' END").alias("period"), F.expr("concat(o_orderkey % 7, '.25')").alias("value"), F.lit("EUR").alias("currency"))
    trimmed = raw.withColumn("code", F.trim("code"))
    done = normalize_dividends(trimmed, carry=["o_orderkey"])
    return done.select("o_orderkey", *IDENTITY, "event_date", "payment_date", "period", F.col("value").cast("double").alias("value"), "status", "event_key")


@_query("split_normalize", """WITH r AS (SELECT o_orderkey, 'C' || o_custkey AS isin, CAST(o_orderdate AS DATE) AS event_date, (o_orderkey % 4 + 1) AS num, (o_orderkey % 2 + 1) AS den FROM orders),
f AS (SELECT *, CASE WHEN num % den = 0 THEN CAST(num // den AS VARCHAR) ELSE CAST(num // den AS VARCHAR) || '.5' END AS split_factor FROM r)
SELECT o_orderkey, isin, event_date, num || ':' || den AS split_ratio, split_factor, 'active' AS status,
sha256('{"business_fields":{"code":"C","event_date":"' || event_date || '","exchange":"XTST","isin":"' || isin || '","split_factor":"' || split_factor || '","split_ratio":"' || num || ':' || den || '"},"kind":"split"}') AS event_key FROM f""")
def split_normalize(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "orders").select("o_orderkey", F.expr("concat('C', o_custkey)").alias("isin"), F.lit("XTST").alias("exchange"), F.lit("C").alias("code"), F.to_date("o_orderdate").cast("string").alias("date"), F.expr("concat(o_orderkey % 4 + 1, ':', o_orderkey % 2 + 1)").alias("split"))
    return normalize_splits(raw, carry=["o_orderkey"]).select("o_orderkey", "isin", "event_date", "split_ratio", "split_factor", "status", "event_key")


@_query("quote_issues", f"WITH {_all_quotes_sql()} SELECT count(*) FILTER (day(trade_date) % 11 = 0) AS blank_identity, count(*) FILTER (day(trade_date) % 13 = 0) AS not_finite, count(*) FILTER (day(trade_date) % 7 = 0) AS bad_volume FROM q")
def quote_issue_counts(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw_quotes(spark, d).withColumn("code", F.expr("CASE WHEN day(to_date(date)) % 11 = 0 THEN '  ' ELSE code END"))
    raw = raw.withColumn("open", F.expr("CASE WHEN day(to_date(date)) % 13 = 0 THEN 'NaN' ELSE open END"))
    return quote_issues(raw.withColumn("volume", F.expr("CASE WHEN day(to_date(date)) % 14 = 7 THEN '-1' WHEN day(to_date(date)) % 7 = 0 THEN '1.5' ELSE volume END")))


@_query("quote_eod_times", f"WITH {_Q} SELECT {_KEYS}, trade_date || ' 00:00:00' AS timestamp_eod FROM q")
def quote_eod_times(spark: SparkSession, d: str) -> DataFrame:
    return with_eod_time(quotes(spark, d).select(*KEYS)).withColumn("timestamp_eod", F.date_format("timestamp_eod", "yyyy-MM-dd HH:mm:ss"))


@_query("available_per_table", "WITH k AS (SELECT unnest(['quotes', 'dividends', 'splits', 'listings']) AS kind) SELECT kind, o_orderkey, CAST(o_orderdate AS DATE) + CASE isodow(o_orderdate) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END::INT AS available_on FROM orders, k")
def available_per_table(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for kind, column in (("quotes", "trade_date"), ("dividends", "event_date"), ("splits", "event_date"), ("listings", "published_at_utc")):
        rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias(column))
        part = rows.select(F.lit(kind).alias("kind"), "o_orderkey", available_on(kind, rows).alias("available_on"))
        out = part if out is None else out.unionByName(part)
    return out


# Events of instruments with windows of their own: a fifth was refreshed whole, a seventh not at all.
_STARTS = "st AS (SELECT DISTINCT 'C' || o_custkey AS isin, CASE WHEN o_custkey % 5 <> 0 THEN CAST(DATE '1996-01-01' + CAST(o_custkey % 400 AS INT) AS DATE) END AS start FROM orders WHERE o_custkey % 7 <> 0)"
_WINDOWS = f"""p AS (SELECT DISTINCT *, CASE WHEN value = 0 THEN 'retracted' ELSE 'active' END AS status FROM ({_EVENT_SQL.format(value='CAST(o_orderkey % 5 AS BIGINT)', where='o_orderkey % 3 <> 0')}) AS x), {_STARTS},
c AS (SELECT DISTINCT x.* FROM ({_EVENT_SQL.format(value='CAST(CASE WHEN o_orderkey % 11 = 0 THEN 9 ELSE o_orderkey % 5 END AS BIGINT)', where='o_orderkey % 4 <> 0')}) AS x JOIN st USING (isin) WHERE start IS NULL OR event_date >= start)"""


def _window_versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    starts = table(spark, d, "orders").filter("o_custkey % 7 <> 0").select(F.expr("concat('C', o_custkey)").alias("isin"), F.lit("XTST").alias("exchange"), F.lit("C").alias("code"), F.expr("CASE WHEN o_custkey % 5 <> 0 THEN date_add(DATE '1996-01-01', CAST(o_custkey % 400 AS INT)) END").alias("start")).distinct()
    previous = _events(spark, d, "o_orderkey % 5", "o_orderkey % 3 <> 0").withColumn("status", F.expr("CASE WHEN value = 0 THEN 'retracted' ELSE 'active' END"))
    now = _events(spark, d, "CASE WHEN o_orderkey % 11 = 0 THEN 9 ELSE o_orderkey % 5 END", "o_orderkey % 4 <> 0")
    return previous, now.join(starts, list(IDENTITY)).filter("start IS NULL OR event_date >= start").drop("start"), starts


_GONE = "NOT EXISTS (SELECT 1 FROM c WHERE c.isin = p.isin AND c.event_key = p.event_key)"


@_query("action_windows", f"""WITH {_WINDOWS} SELECT isin, event_date, value, event_key, CASE WHEN st.isin IS NOT NULL AND (start IS NULL OR event_date >= start) THEN 'retracted' ELSE status END AS status FROM p LEFT JOIN st USING (isin) WHERE {_GONE}
UNION ALL SELECT isin, event_date, value, event_key, 'active' FROM c""")
def action_windows(spark: SparkSession, d: str) -> DataFrame:
    return reconcile_action_windows(*_window_versions(spark, d)).select("isin", "event_date", "value", "event_key", "status")


@_query("action_window_counts", f"""WITH {_WINDOWS}, w AS (SELECT p.* FROM p JOIN st USING (isin) WHERE status = 'active' AND (start IS NULL OR event_date >= start)),
x AS (SELECT isin, event_date, 1 AS added, 0 AS removed FROM c WHERE NOT EXISTS (SELECT 1 FROM w WHERE c.isin = w.isin AND c.event_key = w.event_key) UNION ALL SELECT isin, event_date, 0, 1 FROM w AS p WHERE {_GONE}),
y AS (SELECT sum(added) AS s, sum(removed) AS r FROM x GROUP BY isin, event_date)
SELECT coalesce(sum(s), 0)::BIGINT AS added, coalesce(sum(r), 0)::BIGINT AS removed, coalesce(sum(least(s, r)), 0)::BIGINT AS corrections, coalesce(sum(r - least(s, r)), 0)::BIGINT AS retractions FROM y""")
def action_window_count_row(spark: SparkSession, d: str) -> DataFrame:
    return action_window_counts(*_window_versions(spark, d))


@_query("action_snapshot", f"""WITH {_WINDOWS} SELECT isin, event_date, value, event_key, status FROM p LEFT JOIN st USING (isin) WHERE {_GONE} AND (st.isin IS NULL OR event_date < start OR (start IS NULL AND status = 'retracted'))
UNION ALL SELECT isin, event_date, value, event_key, 'active' FROM c""")
def action_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return replace_action_windows(*_window_versions(spark, d)).select("isin", "event_date", "value", "event_key", "status")


@_query("noop_decision", f"WITH {_VERSIONS} SELECT false AS same_rows, (SELECT count(*) FROM desired) = (SELECT count(*) FROM current) AS same_count, true AS same_serving, false AS noop UNION ALL SELECT true, true, true, true")
def noop_rows(spark: SparkSession, d: str) -> DataFrame:
    desired, current = (x.drop("run_id") for x in _versions(spark, d))
    serving = current.agg(F.count("*").alias("serving_count"))
    state = fingerprint(current, []).join(F.broadcast(serving), how="cross")  # one row each
    return noop_decision(desired, state, current).unionByName(noop_decision(current, state, current))


@_query("serving_counts", f"WITH {_WINDOWS} SELECT count(*) AS row_count, count(*) FILTER (status = 'active') AS serving_count FROM p")
def serving_counts(spark: SparkSession, d: str) -> DataFrame:
    return state_counts(_window_versions(spark, d)[0])


_HELD = f"{_Q}, k AS (SELECT DISTINCT isin, exchange, code, trade_date FROM q WHERE {_DAY} % 29 = 0), raw AS (SELECT * FROM q UNION ALL SELECT {_KEYS}, close, volume FROM q WHERE {_DAY} % 58 = 0 UNION ALL SELECT {_KEYS}, close, volume + 1 FROM q WHERE {_DAY} % 87 = 0)"


@_query("quarantine_matches", f"WITH {_HELD} SELECT {_KEYS}, count(DISTINCT (close, volume)) AS records FROM raw JOIN k USING ({_KEYS}) GROUP BY {_KEYS} UNION ALL SELECT isin, exchange, code, DATE '1900-01-01', 0 FROM (SELECT DISTINCT isin, exchange, code FROM k) AS x")
def quarantine_match_rows(spark: SparkSession, d: str) -> DataFrame:
    q = quotes(spark, d).select(*KEYS, "close", "volume")
    raw = q.union(q.filter(f"{_DAY} % 58 = 0")).union(q.filter(f"{_DAY} % 87 = 0").withColumn("volume", F.col("volume") + 1))
    held = q.filter(f"{_DAY} % 29 = 0").select(*KEYS)
    return quarantine_matches(raw, held.union(held.select(*IDENTITY, F.lit("1900-01-01").cast("date"))), KEYS)


@_query("quarantine_repair", f"WITH {_Q} SELECT * FROM q")
def quarantine_repair(spark: SparkSession, d: str) -> DataFrame:
    q = quotes(spark, d).select(*KEYS, "close", "volume")
    raw = q.union(q.filter(f"{_DAY} % 58 = 0"))
    return repaired(q.filter(f"{_DAY} % 29 <> 0"), raw, q.filter(f"{_DAY} % 29 = 0").select(*KEYS), KEYS)


_LINE_KEYS = ("l_orderkey", "l_linenumber")
_SPLIT = "CASE WHEN l_orderkey % 10 < 7 THEN 'train' WHEN l_orderkey % 10 < 9 THEN 'validation' ELSE 'test' END"


def _dealt_lines(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Lines dealt by their keys into as many partitions as their number asks for. Folds of them are grouped and joined where they lie.

    A session's fixed number of partitions, or one made smaller for short keys, gives a task more rows the larger the table is.
    """
    lines = table(spark, d, "lineitem")
    return lines.select(*columns).repartition(tasks_for(lines), *_LINE_KEYS)


@_query("fold_issues", f"WITH r AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem), f AS (SELECT l_orderkey, l_linenumber, {_SPLIT} AS split FROM r WHERE l_orderkey % 23 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, 'test' FROM r WHERE l_orderkey % 19 = 0 UNION ALL SELECT -l_orderkey - 1, l_linenumber, 'train' FROM r WHERE l_orderkey % 17 = 0), s AS (SELECT l_orderkey, l_linenumber, count(DISTINCT split) AS n, count(*) FILTER (split = 'train') AS t FROM f GROUP BY ALL) SELECT count(*) FILTER (n > 1) AS overlapping, count(*) FILTER (n IS NULL) AS outside, count(*) FILTER (r.l_orderkey IS NULL) AS unknown, count(*) FILTER (t > 0) AS training FROM s FULL JOIN r ON s.l_orderkey = r.l_orderkey AND s.l_linenumber = r.l_linenumber")
def fold_issue_row(spark: SparkSession, d: str) -> DataFrame:
    rows = _dealt_lines(spark, d, *_LINE_KEYS).distinct()
    fold = rows.filter("l_orderkey % 23 <> 0").withColumn("split", F.expr(_SPLIT)).union(rows.filter("l_orderkey % 19 = 0").withColumn("split", F.lit("test")))
    fold = fold.union(rows.filter("l_orderkey % 17 = 0").select(-F.col("l_orderkey") - 1, "l_linenumber", F.lit("train")))
    return fold_issues(rows, fold.repartition(tasks_for(table(spark, d, "lineitem")), *_LINE_KEYS), _LINE_KEYS)


@_query("fold_membership", f"SELECT l_orderkey, l_linenumber, {_SPLIT} AS split FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS r")
def fold_membership(spark: SparkSession, d: str) -> DataFrame:
    rows = _dealt_lines(spark, d, *_LINE_KEYS).distinct()
    return split_rows(rows, rows.withColumn("split", F.expr(_SPLIT)), _LINE_KEYS)


_PRINT = """sha256('tapewright:row:v1' || chr(10) || '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}')"""


@_query("source_fingerprint", f"WITH dig AS (SELECT {_PRINT} AS d FROM orders), b AS (SELECT substr(d, 1, 3) AS bucket, count(*) AS n, sha256(string_agg(d, ',' ORDER BY d)) AS h FROM dig GROUP BY substr(d, 1, 3)) SELECT sum(n)::BIGINT AS row_count, sha256(string_agg(h, ',' ORDER BY bucket)) AS fingerprint FROM b")
def source_fingerprint_row(spark: SparkSession, d: str) -> DataFrame:
    return source_fingerprint(table(spark, d, "orders"), ["o_orderkey"], ["o_custkey", "o_orderstatus"])


@_query("snapshot_positions", f"WITH {_Q}, r AS (SELECT * FROM q UNION ALL SELECT {_KEYS}, close, volume + 1 FROM q WHERE {_DAY} % 7 = 0) SELECT {_KEYS}, volume, row_number() OVER (PARTITION BY exchange, code ORDER BY trade_date, isin, volume) AS position FROM r")
def snapshot_positions(spark: SparkSession, d: str) -> DataFrame:
    q = quotes(spark, d).select(*KEYS, F.format_string("%012d", "volume").alias("volume"))
    twice = q.union(q.filter(f"{_DAY} % 7 = 0").withColumn("volume", F.format_string("%012d", F.col("volume").cast("long") + 1)))
    return positions(twice, ["exchange", "code"], ["trade_date", "isin"]).withColumn("volume", F.col("volume").cast("long"))


@_query("event_positions", f"WITH {_WINDOWS} SELECT isin, event_key, row_number() OVER (PARTITION BY isin ORDER BY event_date, event_key, status) AS position FROM p")
def event_positions(spark: SparkSession, d: str) -> DataFrame:
    return positions(_window_versions(spark, d)[0], list(IDENTITY), ["event_date", "event_key", "status"]).select("isin", "event_key", "position")


@_query("bronze_listings", """SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN 'unidentified-' || substr(sha256('{"Code":null,"Exchange":' || CASE WHEN s_suppkey % 4 = 0 THEN 'null' ELSE '"XTST"' END || ',"Type":"Fund","s_suppkey":' || s_suppkey || '}'), 1, 16) ELSE s_name END AS symbol,
CASE WHEN s_suppkey % 4 = 0 THEN 'unknown' ELSE 'XTST' END AS partition_exchange, 'fund' AS partition_type, 'static' AS timeframe FROM supplier""")
def bronze_listings(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "supplier").select("s_suppkey", F.expr("CASE WHEN s_suppkey % 9 <> 0 THEN s_name END").alias("Code"), F.expr("CASE WHEN s_suppkey % 4 <> 0 THEN 'XTST' END").alias("Exchange"), F.lit("Fund").alias("Type"))
    return listing_partitions(raw).select("s_suppkey", "symbol", "partition_exchange", "partition_type", "timeframe")


@_query("bronze_quote_merge", f"WITH {_Q}, i AS (SELECT {_KEYS}, volume + 1 AS volume FROM q WHERE {_DAY} % 5 = 0 UNION ALL SELECT {_KEYS}, volume + 2 FROM q WHERE {_DAY} % 10 = 0 UNION ALL SELECT isin, exchange, code, CAST(trade_date + 4000 AS DATE), volume FROM q WHERE {_DAY} % 3 = 0) SELECT {_KEYS}, max(volume) AS volume FROM i GROUP BY {_KEYS} UNION ALL SELECT {_KEYS}, volume FROM q WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.isin = q.isin AND i.exchange = q.exchange AND i.code = q.code AND i.trade_date = q.trade_date)")
def bronze_quote_merge(spark: SparkSession, d: str) -> DataFrame:
    stored = written(quotes(spark, d).select(*IDENTITY, F.col("trade_date").alias("date"), "volume"), "bronze-quotes").withColumn("seq", F.lit(0))
    later = lambda by, rows, seq: rows.withColumn("volume", F.col("volume") + by).withColumn("seq", F.lit(seq))
    day = _DAY.replace("trade_date", "date")
    incoming = later(2, stored.filter(f"{day} % 10 = 0"), 2).union(later(1, stored.filter(f"{day} % 5 = 0"), 1)).union(stored.filter(f"{day} % 3 = 0").withColumn("date", F.date_add("date", 4000)))
    return merge_bronze_quotes(stored, incoming, "seq", tasks_for(stored)).select(*IDENTITY, F.col("date").alias("trade_date"), "volume")


@_query("bronze_action_replace", f"WITH {_WINDOWS}, i AS (SELECT * FROM p WHERE event_date >= DATE '1996-01-01') SELECT isin, event_key FROM i UNION ALL SELECT isin, event_key FROM p WHERE isin NOT IN (SELECT isin FROM i)")
def bronze_action_replace(spark: SparkSession, d: str) -> DataFrame:
    stored = _window_versions(spark, d)[0]
    return replace_bronze_actions(stored, stored.filter("event_date >= DATE '1996-01-01'")).select("isin", "event_key")


_GOLD = """sha256('tapewright:row:v1' || chr(10) || '{"isin":"' || isin || '","trade_date":"' || trade_date || '","volume":' || volume || '}')"""


@_query("gold_artifacts", f"WITH {_Q}, dig AS (SELECT exchange, code, {_GOLD} AS d FROM q), b AS (SELECT exchange, code, substr(d, 1, 3) AS bucket, count(*) AS n, sha256(string_agg(d, ',' ORDER BY d)) AS h FROM dig GROUP BY exchange, code, substr(d, 1, 3)), g AS (SELECT exchange, code, sum(n)::BIGINT AS row_count, sha256(string_agg(h, ',' ORDER BY bucket)) AS source_hash FROM b GROUP BY exchange, code) SELECT *, code || '_GOLD_v5_' || source_hash || '.parquet' AS file FROM g")
def gold_artifact_rows(spark: SparkSession, d: str) -> DataFrame:
    return gold_artifacts(quotes(spark, d).select(*KEYS, "volume"), "v5")


_SIDECAR = """sha256('tapewright:row:v1' || chr(10) || '{"event_key":"' || event_key || '"}')"""


@_query("retraction_sidecar", f"WITH {_WINDOWS}, r AS (SELECT DISTINCT event_key FROM p WHERE status = 'retracted'), dig AS (SELECT {_SIDECAR} AS d FROM r), b AS (SELECT substr(d, 1, 3) AS bucket, count(*) AS n, sha256(string_agg(d, ',' ORDER BY d)) AS h FROM dig GROUP BY substr(d, 1, 3)) SELECT sum(n)::BIGINT AS row_count, sum(n)::BIGINT AS key_count, true AS valid, sha256(string_agg(h, ',' ORDER BY bucket)) AS fingerprint FROM b")
def retraction_sidecar(spark: SparkSession, d: str) -> DataFrame:
    return sidecar_state(_window_versions(spark, d)[0].filter("status = 'retracted'").select("event_key", "status").distinct())


@_query("payload_rows", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def payload_row_fields(spark: SparkSession, d: str) -> DataFrame:
    return payload_rows(table(spark, d, "events").select("event_id", F.col("props").alias("payload_json")), "k bigint")


@_query("instrument_types", "SELECT s_suppkey, coalesce(CASE WHEN n_nationkey % 3 <> 0 THEN lower(n_name) END, 'unknown') AS instrument_type FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def instrument_types(spark: SparkSession, d: str) -> DataFrame:
    types = table(spark, d, "nation").filter("n_nationkey % 3 <> 0").select(F.col("n_nationkey").alias("s_nationkey"), F.lower("n_name").alias("instrument_type"))
    return with_instrument_types(table(spark, d, "supplier"), types, ["s_nationkey"]).select("s_suppkey", "instrument_type")


@_query("key_integrity", "SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS key_count, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS \"unique\" FROM lineitem")
def key_integrity_row(spark: SparkSession, d: str) -> DataFrame:
    return key_integrity(table(spark, d, "lineitem"), _LINE_KEYS)


@_query("repeated_keys", "SELECT l_suppkey, l_shipdate::DATE AS l_shipdate, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_shipdate::DATE HAVING count(*) > 1")
def repeated_key_rows(spark: SparkSession, d: str) -> DataFrame:
    return repeated_keys(table(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("l_shipdate")), ["l_suppkey", "l_shipdate"])


@_query("bronze_dedup", f"WITH {_Q} SELECT DISTINCT isin, trade_date, volume, CASE WHEN k = 1 AND volume % 3 = 0 THEN 'late' END AS note FROM q, (SELECT unnest([0, 1]) AS k) AS x")
def bronze_dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    q = quotes(spark, d).select("isin", "trade_date", "volume")
    return bronze_dedup(q.union(q), q.withColumn("note", F.expr("CASE WHEN volume % 3 = 0 THEN 'late' END")))


@_query("round_trip", f"WITH {_Q} SELECT count(*) FILTER ({_DAY} % 31 = 0) AS lost, count(*) FILTER ({_DAY} % 31 = 0) AS new FROM q")
def round_trip(spark: SparkSession, d: str) -> DataFrame:
    q = quotes(spark, d).select(*KEYS, F.col("close").cast("decimal(18,4)").alias("close"), "volume", F.lit(None).cast("string").alias("note"))
    back = q.select(*KEYS, F.concat(F.col("close").cast("string"), F.lit("00")).alias("CLOSE"), F.expr(f"CASE WHEN {_DAY} % 31 = 0 THEN volume + 1 ELSE volume END").cast("string").alias("volume"))
    return round_trip_differences(q, back, KEYS)


# A nested row per line of an order, and what came back: numbers as other types and as text, some lost, changed or added.
_BACK = {5: "cut", 7: "note", 11: "extra", 13: "tags", 17: "pair"}


@_query("nested_round_trip", f"SELECT l_orderkey, l_linenumber, count(*) AS n, true AS expected, true AS actual, NOT ({' OR '.join(f'(l_orderkey + l_linenumber) % {k} = 0' for k in _BACK)}) AS same FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS l GROUP BY ALL")
def nested_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = _dealt_lines(spark, d, *_LINE_KEYS, "l_quantity", "l_partkey").groupBy(*_LINE_KEYS).agg(F.max("l_quantity").alias("q"), F.max("l_partkey").alias("part"))
    hit = {name: f"(l_orderkey + l_linenumber) % {k} = 0" for k, name in _BACK.items()}
    want = rows.selectExpr(*_LINE_KEYS, "named_struct('volume', CAST(q AS INT), 'note', CAST(NULL AS STRING), 'line', named_struct('part', part, 'tags', array(1, 2))) AS payload", "map('a', part, 'b', part + 1) AS pair")
    volume, note, extra = f"CAST(q AS INT) || CASE WHEN {hit['cut']} THEN '.7' ELSE '.0' END", f"CASE WHEN {hit['note']} THEN 'x' END", f"CASE WHEN {hit['extra']} THEN 1 END"
    tags = f"CASE WHEN {hit['tags']} THEN array(1.0D) ELSE array(1.0D, 2.0D) END"
    pair = f"CASE WHEN {hit['pair']} THEN map('a', CAST(part AS DOUBLE)) ELSE map('b', part + 1.0D, 'a', CAST(part AS DOUBLE), 'c', NULL) END"
    back = rows.selectExpr(*_LINE_KEYS, f"named_struct('note', {note}, 'volume', {volume}, 'extra', {extra}, 'line', named_struct('tags', {tags}, 'part', CAST(part AS DECIMAL(20,2)))) AS payload", f"{pair} AS pair")
    return compared(want, back, _LINE_KEYS).groupBy(*[F.col(k).cast("long").alias(k) for k in _LINE_KEYS], "expected", "actual", "same").agg(F.count("*").alias("n"))


@_query("listings_deactivated", f"SELECT isin, exchange, code, substr(isin, 2)::BIGINT % 3 <> 0 AS is_active FROM ({_listing_sql('true', 'true')}) AS l")
def listings_deactivated(spark: SparkSession, d: str) -> DataFrame:
    held = normalize_listings(_raw_listings(spark, d), True)
    return deactivated(held, held.filter("CAST(substr(isin, 2) AS BIGINT) % 3 <> 0")).select(*IDENTITY, "is_active")


@_query("missing_rows_numeric", f"WITH {_VERSIONS}, w AS (SELECT {_KEYS}, volume, count(*) AS n FROM desired GROUP BY ALL), h AS (SELECT {_KEYS}, volume, count(*) AS n FROM current GROUP BY ALL) SELECT coalesce(sum(greatest(w.n - coalesce(h.n, 0), 0)), 0)::BIGINT AS missing FROM w LEFT JOIN h USING ({_KEYS}, volume)")
def missing_rows_numeric(spark: SparkSession, d: str) -> DataFrame:
    desired, current = (x.select(*KEYS, "volume") for x in _versions(spark, d))
    return missing_rows(desired.withColumn("volume", F.concat(F.col("volume").cast("string"), F.lit(".000"))), current, ["volume"])


@_query("audit_issues", "SELECT count(*) FILTER (o_orderkey % 13 = 0) AS missing, count(*) FILTER (o_orderkey % 13 <> 0 AND o_orderkey % 7 = 0) AS fetched_late FROM orders")
def audit_issue_counts(spark: SparkSession, d: str) -> DataFrame:
    hours = F.expr("CASE WHEN o_orderkey % 7 = 0 THEN INTERVAL '1' HOUR ELSE INTERVAL '0' HOUR END")
    rows = table(spark, d, "orders").select((F.col("o_orderdate") + hours).alias("fetched_at_utc"), F.expr("CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END").alias("published_at_utc"))
    return audit_issues(rows)


@_query("fold_standardize_members", f"WITH f AS (SELECT l_orderkey, l_linenumber, {_SPLIT} AS split, max(l_quantity) AS l_quantity FROM lineitem GROUP BY l_orderkey, l_linenumber), s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS d FROM f WHERE split = 'train') SELECT l_orderkey, l_linenumber, split, round((l_quantity - m) / d, 6) + CAST(0 AS DOUBLE) AS l_quantity FROM f, s")
def fold_standardize_members(spark: SparkSession, d: str) -> DataFrame:
    rows = _dealt_lines(spark, d, *_LINE_KEYS, "l_quantity").groupBy(*_LINE_KEYS).agg(F.max("l_quantity").alias("l_quantity"))
    done = standardize_fold(rows, rows.select(*_LINE_KEYS, F.expr(_SPLIT).alias("split")), _LINE_KEYS, ["l_quantity"])
    return done.select(*_LINE_KEYS, "split", (F.round("l_quantity", 6) + F.lit(0.0)).alias("l_quantity"))


_MICRO_WINDOWS = "WINDOW w AS (PARTITION BY isin ORDER BY trade_date), w4 AS (PARTITION BY isin ORDER BY trade_date ROWS 3 PRECEDING), w5 AS (PARTITION BY isin ORDER BY trade_date ROWS 4 PRECEDING), w20 AS (PARTITION BY isin ORDER BY trade_date ROWS 19 PRECEDING)"
_MICRO_NAMES = ("log_return_1", "rolling_cum_return_4", "adjusted_close_return_mean_5obs", "adjusted_close_volatility_20obs", "adjusted_close_sma_ratio_5_20", "relative_volume_20obs")


def _micro_sql(source: str) -> str:
    """Six window features of the quotes in one plan: one exchange and one sort by instrument."""
    full = lambda n, x: f"CASE WHEN count(r) OVER w{n} = {n} THEN {x} END"
    level = lambda x: f"CASE WHEN count(p) OVER w20 = 20 THEN {x} END"
    made = ("r", full(4, "exp(sum(r) OVER w4) - 1"), full(5, "avg(r) OVER w5"), full(20, "stddev_samp(r) OVER w20"), level("avg(p) OVER w5 / avg(p) OVER w20"), level("v / avg(v) OVER w20"))
    named = ", ".join(f"round({x}, 9) + CAST(0 AS DOUBLE) AS {n}" for x, n in zip(made, _MICRO_NAMES))
    return f"""WITH frame AS (SELECT isin, trade_date, CAST(adjusted_close AS DOUBLE) AS p, CAST(volume AS DOUBLE) AS v FROM {source}),
s1 AS (SELECT *, ln(p / lag(p) OVER w) AS r FROM frame {_MICRO_WINDOWS}) SELECT isin, trade_date, {named} FROM s1 {_MICRO_WINDOWS}"""


@_query("window_micro", _micro_sql(f"({QUOTES_SQL}) AS q"))
def window_micro(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_micro_sql("{q}"), q=quotes(spark, d))
