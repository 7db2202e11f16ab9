"""Equality of nested values against plain Python, and round trips that lose something."""

import itertools
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewright.functions.equality import NUMERIC_FIELDS, _numbers, number_key, same_value
from tapewright.operators.history import compared, round_trip_differences


def plain_number(text):
    try:
        return Decimal(text) if Decimal(text).is_finite() else None
    except InvalidOperation:
        return None


def test_number_keys(spark):
    texts = ["0", "-0.00", "1", "1.0", "+1", "01.10", "1.1", "1e3", "1000", "1.0E+3", "-2.50", "-2.5", ".5", "5.", "0.5", "1e-30", "0.000000000000000000000000000001", "123456789012345678901234567890123456789012", "1e400", "10e399", "x", "", ".", "1e", "--1", "1 2", " 7 ", "7", "NaN", "0e5", "1_0"]
    keys = {r.t: r.k for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", number_key(F.col("t")).alias("k")).collect()}
    numbers = {t: plain_number(t) if "_" not in t else None for t in texts}
    for a, b in itertools.product(texts, texts):
        if numbers[a] is None:
            assert keys[a] is None, a
        elif numbers[b] is not None:
            assert (keys[a] == keys[b]) == (numbers[a] == numbers[b]), (a, b)


def same(a, b, field=None):
    """The definition, on Python values."""
    if isinstance(a, bool) or isinstance(b, bool):
        return isinstance(a, bool) and isinstance(b, bool) and a == b
    numeric = (int, float, Decimal)
    mixed = field in NUMERIC_FIELDS and ((isinstance(a, numeric) and isinstance(b, str)) or (isinstance(a, str) and isinstance(b, numeric)))
    if mixed or (isinstance(a, numeric) and isinstance(b, numeric)):
        x, y = plain_number(str(a)), plain_number(str(b))
        return x is not None and x == y
    if isinstance(a, dict) and isinstance(b, dict):
        return all(same(a.get(k), b.get(k), k) for k in {**a, **b})
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))
    return type(a) is type(b) and a == b


def plain(value):
    if isinstance(value, T.Row):
        return {k: plain(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, list) else value


SIDES = {
    "int": [2, None, 0, -3], "double": [2.0, 2.7, None, float("nan")], "decimal(20,3)": [Decimal("2.000"), Decimal("2.700"), None], "string": ["2", "x", "2.70", None, ""], "boolean": [True, False, None],
    "struct<volume: int, note: string>": [(2, None), (2, "x"), (None, None), None], "struct<volume: string, extra: double>": [("2", None), ("2.0", 1.5), ("y", None), (None, None)],
    "struct<in: struct<a: int, b: array<double>>>": [((1, [1.0, None]),), ((1, []),), ((None, None),), (None,)], "struct<in: struct<b: array<int>, a: double>>": [(([1, None], 1.0),), (([], 1.0),), (([1], 2.0),), (None,)],
    "map<string,int>": [{"volume": 2}, {"volume": 2, "k": 3}, {}, {"volume": None}, None], "map<string,string>": [{"volume": "2.0"}, {"k": "3"}, {}, None],
    "array<struct<x: int>>": [[(1,), (None,)], [(1,)], [None], []], "array<map<string,double>>": [[{"x": 1.0}, {}], [{"x": 1.0, "y": 2.0}], [None], []],
}


@pytest.mark.parametrize("left", SIDES)
def test_nested_equality(spark, left):
    """Every value of one type with every value of all types."""
    frames = {k: spark.createDataFrame([(n, v) for n, v in enumerate(vs)], f"{k[0]}n int, v {k}") for k, vs in SIDES.items()}
    a = frames[left]
    for right, b in frames.items():
        b = b.toDF("bn", "w")
        both = a.crossJoin(b).select("v", "w", *[same_value(F.col("v"), a.schema["v"].dataType, F.col("w"), b.schema["w"].dataType, f).alias(n) for n, f in (("s", None), ("f", "volume"))])
        for r in both.collect():
            x, y = plain(r.v), plain(r.w)
            assert (r.s, r.f) == (same(x, y), same(x, y, "volume")), (left, right, x, y)


def test_round_trips_that_lose_something(spark):
    want = spark.createDataFrame([("a", 2, None, (1, "k")), ("b", 3, "n", (2, None)), (None, 4, None, None)], "key string, volume int, note string, more struct<x: int, y: string>")
    given = lambda rows, schema: spark.createDataFrame(rows, schema)
    wide = "KEY string, Volume double, note string, more struct<x: string, y: string, z: int>"
    ok = [("a", 2.0, None, (None, "k", None)), ("b", 3.0, "n", (None, None, None)), (None, 4.0, None, None)]
    counts = lambda rows, schema=wide: tuple(round_trip_differences(want, given(rows, schema), ["key"]).first())
    assert counts(ok) == (2, 2)  # x is lost: text in a field that isn't numeric, or none
    wide = wide.replace("x: string", "x: decimal(5,2)")
    ok = [("a", 2.0, None, (Decimal(1), "k", None)), ("b", 3.0, "n", (Decimal(2), None, None)), (None, 4.0, None, None)]
    assert counts(ok, wide) == (0, 0)
    assert counts([("a", 2.7, *ok[0][2:]), *ok[1:]], wide) == (1, 1)  # 2 against 2.7
    assert counts([("a", 2.0, "x", ok[0][3]), *ok[1:]], wide) == (1, 1)  # null against text
    assert counts([(*ok[0][:3], (Decimal(1), "k", 9)), *ok[1:]], wide) == (1, 1)  # a field too many
    assert counts([(*r, "more") for r in ok], wide + ", other string") == (3, 3)  # a column too many
    assert counts(ok[1:], wide) == (1, 0) and counts([*ok, ("c", 1.0, None, None)], wide) == (0, 1)
    assert counts([*ok, ok[0]], wide) == (0, 1)
    assert [r.same for r in compared(want, want, ["key"]).collect()] == [True] * 3
    assert compared(want.limit(0), want.limit(0), ["key"]).collect() == []


def test_short_plain_numbers_equal_as_long_ones_do(spark):
    """The short way and number_key agree on texts that only nearly are numbers; length tells which texts need no regular expression."""
    texts = ["", "-", ".", "5.", ".5", "-.5", "-0", "0", "00.500", "0.5", "1-2", "1.2.3", "--1", "+5", " 5", "5", "5e0", "123456789012345678", "1234567890123456789", "123456789012345678.0", ".00000000000000001", "1e-17", None]
    pairs = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    x, y = number_key(F.col("a")), number_key(F.col("b"))
    rows = pairs.select("a", "b", F.coalesce(_numbers(F.col("a"), F.col("b")), F.lit(False)).alias("got"), F.coalesce(x == y, F.lit(False)).alias("want")).collect()
    assert [r for r in rows if r.got != r.want] == []
    assert sum(r.want for r in rows) > len(texts)
    assert "length" in str(_numbers(F.col("a"), F.col("b")))
