"""Canonical text, typed parsing, business dates and content hashes, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns that say when a row was fetched or published; they never change what a row means.
AUDIT = ("fetched_at_utc", "published_at_utc", "run_id")
#: The control characters whose escapes have letters.
_LETTERED = [f"{c:02X}" for c in range(32) if c % 16 > 9 and chr(c) not in "\n\f\r"]
DIGEST_SPACE = "tapewright:row:v1"


def trimmed(c: Column) -> Column:
    """Without blanks at the ends; nothing left is null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def parsed_decimal(c: Column) -> Column:
    """A finite decimal, or null for anything else (booleans and NaN among it)."""
    return c.cast("string").try_cast("decimal(38,18)")


def canonical_decimal(c: Column) -> Column:
    """Plain digits without trailing zeros, exponent or negative zero."""
    text = c.cast("decimal(38,18)").cast("string")
    text = F.when(c == 0, F.lit("0")).otherwise(text)
    short = F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
    return F.when(short.isin("-0", ""), F.lit("0")).otherwise(short)


def next_business_day(d: Column) -> Column:
    """The next weekday: Friday and Saturday lead to Monday."""
    return F.date_add(d, F.when(F.weekday(d) == 4, 3).when(F.weekday(d) == 5, 2).otherwise(1))


def overlap_start(last: Column, days: int = 7) -> Column:
    """The first date that a delta fetches again."""
    return F.date_sub(last, days)


def canonical_json(columns: Sequence[str]) -> Column:
    """Compact JSON of the columns in alphabetical order, nulls kept, control characters with lower-case digits."""
    text = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    lower = text
    for code in _LETTERED:
        lower = F.regexp_replace(lower, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")  # after an even number of backslashes
    return F.when(text.rlike(r"\\u00[01][A-F]"), lower).otherwise(text)


def entity_key(columns: Sequence[str]) -> Column:
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def row_digest(columns: Sequence[str]) -> Column:
    """A digest of what a row means: its columns without the audit columns, under this digest's own name space."""
    meaning = [c for c in columns if c not in AUDIT]
    return F.sha2(F.concat(F.lit(f"{DIGEST_SPACE}\n"), canonical_json(meaning)), 256)


def event_key(kind: str, columns: Sequence[str]) -> Column:
    """A content key: equal events have equal keys."""
    fields = F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(columns)])
    return F.sha2(F.to_json(F.struct(fields.alias("business_fields"), F.lit(kind).alias("kind")), {"ignoreNullFields": "false"}), 256)
