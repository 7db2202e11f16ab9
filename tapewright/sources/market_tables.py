"""Market tables derived from the star-schema test tables, as SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import tasks_for

QUOTES = """
SELECT concat('S', lpad(CAST(l_suppkey AS STRING), 9, '0')) AS isin, 'XTST' AS exchange, s_name AS code, CAST(l_shipdate AS DATE) AS trade_date,
       min_by(price, tie) AS open, max(price) AS high, min(price) AS low, max_by(price, tie) AS close, max_by(price, tie) AS adjusted_close, CAST(sum(l_quantity) AS BIGINT) AS volume
FROM (SELECT l_suppkey, l_shipdate, l_quantity, floor(l_extendedprice / l_quantity * 10000) / 10000 AS price,
             {struct} AS tie
      FROM {lineitem}) AS priced JOIN {supplier} AS s ON l_suppkey = s_suppkey
GROUP BY l_suppkey, s_name, CAST(l_shipdate AS DATE)
"""
_SPARK = {"struct": "struct(l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity)"}
_DUCK = {"struct": "row(l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity)", "lineitem": "lineitem", "supplier": "supplier"}

QUOTES_SQL = QUOTES.format(**_DUCK).replace("AS STRING", "AS VARCHAR")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End-of-day quotes: one instrument per supplier, one row per ship date; prices are cut to 4 decimal places."""
    text = QUOTES.format(**_SPARK, lineitem="{lineitem}", supplier="{supplier}")
    return spark.sql(text, lineitem=table(spark, sf_dir, "lineitem"), supplier=table(spark, sf_dir, "supplier"))


def placed_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same quotes, each instrument's in one partition and by date. The lines are exchanged once, with the columns as they are stored.

    Grouped lines are several times as wide as stored ones and hardly fewer, and quotes grouped by day have to be exchanged again for
    anything that goes by instrument. All branches of a plan that read prices share this exchange; its tasks get some 500,000 lines each.
    """
    lines, names = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    named = lines.join(names, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
        "concat('S', lpad(CAST(l_suppkey AS STRING), 9, '0')) AS isin", "s_name AS code", "l_suppkey", "CAST(l_shipdate AS DATE) AS trade_date", "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"
    )
    dealt = named.repartition(tasks_for(lines), "isin", "code")
    priced = dealt.selectExpr("isin", "code", "trade_date", "l_suppkey", "l_quantity", "floor(l_extendedprice / l_quantity * 10000) / 10000 AS price", f"{_SPARK['struct']} AS tie")
    last = F.max_by("price", "tie")
    grouped = priced.groupBy("isin", "code", "trade_date", "l_suppkey").agg(
        F.min_by("price", "tie").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), last.alias("close"), last.alias("adjusted_close"), F.sum("l_quantity").cast("bigint").alias("volume")
    )
    return grouped.select("isin", F.lit("XTST").alias("exchange"), "code", "trade_date", "open", "high", "low", "close", "adjusted_close", "volume")
