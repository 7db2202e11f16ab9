"""Provider rows to contract rows: listings, quotes, dividends and splits."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Context, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canonical import event_key, next_business_day, parsed_decimal, trimmed

IDENTITY = ("isin", "exchange", "code")


def _column(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that the provider sent with a value."""
    found = [trimmed(F.col(n)) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _must(ok: Column, value: Column, what: str) -> Column:
    """The value; a row for which ok isn't true is an error when it is computed."""
    return F.when(ok, value).otherwise(F.raise_error(F.lit(what)).cast("string"))


def normalize_listings(raw: DataFrame, is_active: bool) -> DataFrame:
    """Rows without an ISIN are left out; a row without exchange or code is an error."""
    rows = raw.select(
        F.upper(_column(raw, "ISIN", "Isin")).alias("isin"), F.upper(_column(raw, "Exchange")).alias("exchange"), _column(raw, "Code").alias("code"),
        *[_column(raw, n).alias(a) for n, a in (("Name", "name"), ("Type", "instrument_type"), ("Currency", "currency"), ("Country", "country"))],
    ).filter("isin IS NOT NULL")
    for c in ("exchange", "code"):
        rows = rows.withColumn(c, _must(F.col(c).isNotNull(), F.col(c), f"a listing has no {c}"))
    return rows.withColumn("is_active", F.lit(is_active))


def normalize_quotes(raw: DataFrame) -> DataFrame:
    """raw: isin, exchange, code and the provider's fields. Numbers must be finite, volumes whole and not negative.

    Negative and inconsistent prices are kept as they are; empty fields are null.
    """
    out = [F.col(c) for c in IDENTITY] + [F.to_date(_column(raw, "date")).alias("trade_date")]
    for name, sources in (("open", ("open",)), ("high", ("high",)), ("low", ("low",)), ("close", ("close",)), ("adjusted_close", ("adjusted_close", "adjustedClose")), ("volume", ("volume",))):
        text = _column(raw, *sources)
        value = parsed_decimal(text)
        ok = text.isNull() | value.isNotNull()
        if name == "volume":
            ok &= F.coalesce((value >= 0) & (value == F.floor(value)), F.lit(True))
        kind = "bigint" if name == "volume" else "decimal(38,18)"
        out.append(_must(ok, value.cast("string"), f"a quote's {name} is not valid").cast("decimal(38,18)").cast(kind).alias(name))
    return raw.select(*out)


def _keyed(kind: str, raw: DataFrame, fields: Sequence[Column | str], carry: Sequence[str]) -> DataFrame:
    rows = raw.select(*fields, *carry)
    own = [c for c in rows.columns if c not in carry]
    return rows.withColumn("event_key", event_key(kind, own)).withColumn("status", F.lit("active"))


def normalize_dividends(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Dividends with their event key, which depends on all business fields; carried columns don't count."""
    dates = (("date", "event_date"), ("declarationDate", "declaration_date"), ("recordDate", "record_date"), ("paymentDate", "payment_date"))
    value = parsed_decimal(_column(raw, "value"))
    rows = (*IDENTITY, *[F.to_date(_column(raw, n)).alias(a) for n, a in dates], _must(value.isNotNull(), value.cast("string"), "a dividend has no valid value").cast("decimal(38,18)").alias("value"), _column(raw, "currency").alias("currency"), _column(raw, "period").alias("period"))
    return _keyed("dividend", raw, rows, carry)


def split_factor(ratios: pd.Series) -> pd.Series:
    """num:den as a decimal of 28 digits; null without a colon. Spark's own decimal division keeps too few digits."""
    context = Context(prec=28)

    def factor(ratio: str | None) -> str | None:
        if not ratio or ":" not in ratio:
            return None
        num, den = (Decimal(x.strip()) for x in ratio.split(":", 1))
        if den == 0 or num / den <= 0:
            raise ValueError(f"a split of {ratio} has no positive factor")
        return format(context.divide(num, den), "f")

    return ratios.map(factor, na_action="ignore").astype(object).where(ratios.notna(), None)


def normalize_splits(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Splits with their factor and event key; carried columns don't count in the key."""
    given = _column(raw, "split_factor", "splitFactor")
    made = F.pandas_udf(split_factor, "string")(_column(raw, "split"))
    factor = F.coalesce(given, made)
    ok = factor.isNull() | (parsed_decimal(factor) > 0)
    rows = (*IDENTITY, F.to_date(_column(raw, "date")).alias("event_date"), _column(raw, "split").alias("split_ratio"), _must(ok, factor, "a split's factor is not positive").alias("split_factor"))
    return _keyed("split", raw, rows, carry)


def with_availability(rows: DataFrame, date_col: str) -> DataFrame:
    """available_at: midnight UTC of the business day after the row's date."""
    return rows.withColumn("available_at_utc", F.to_timestamp(next_business_day(F.to_date(date_col))))


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: how many rows break it. A rule that is null for a row counts as kept."""
    counts = rows.agg(*[F.coalesce(F.sum(F.when(~c, 1).otherwise(0)), F.lit(0)).alias(n) for n, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n")
