"""Whether two values mean the same, whatever their types: nested, and with numbers compared exactly, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The provider's fields whose text counts as a number when the other side is one.
NUMERIC_FIELDS = (
    "adjusted_close", "adjustedClose", "close", "denominator", "factor", "high", "low", "numerator", "open", "split",
    "splitFactor", "splitRatio", "split_ratio", "unadjustedValue", "value", "volume",
)

_NUMBER = r"^\s*([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,9}))?\s*$"


def number_key(text: Column) -> Column:
    """Equal for two texts that are the same finite number, exactly and of any size; null for other text.

    The number is its sign, its digits without zeros at the ends, and the power of ten of the last one.
    """
    part = lambda k: F.regexp_extract(text, _NUMBER, k)
    digits = F.concat(part(2), part(3))
    short = F.regexp_replace(digits, "0+$", "")
    power = F.coalesce(F.nullif(part(4), F.lit("")).try_cast("int"), F.lit(0)) - F.length(part(3)) + F.length(digits) - F.length(short)
    key = F.concat(F.when(part(1) == "-", "-").otherwise(""), F.regexp_replace(short, "^0+", ""), F.lit("e"), power.cast("string"))
    return F.when(text.rlike(_NUMBER) & (digits != ""), F.when(short == "", F.lit("0")).otherwise(key))


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.VarcharType, T.CharType))


def _member(value: Column, kind: T.DataType, name: str) -> tuple[Column, T.DataType]:
    """A struct's field or a map's value of that name; null where it lacks it."""
    if isinstance(kind, T.MapType):
        return F.try_element_at(value, F.lit(name)), kind.valueType
    return (value[name], kind[name].dataType) if name in kind.names else (F.lit(None), T.NullType())


def same_value(a: Column, a_type: T.DataType, b: Column, b_type: T.DataType, field: str | Column | None = None, numeric_fields: Sequence[str] = NUMERIC_FIELDS) -> Column:
    """True or false, never null: whether a and b mean the same.

    Nulls equal nulls alone. Numbers of any types are equal if their decimal values are; NaN equals nothing. Booleans
    equal booleans alone. A number equals text that says the same number, in the fields of numeric_fields. Structs and maps
    with text keys equal each other if all their members do; a member that one side lacks is null. Arrays are equal if they
    are of one length and their elements are equal in turn. Other values are equal if they are of one type and equal.
    """
    both, none = a.isNotNull() & b.isNotNull(), a.isNull() & b.isNull()
    keyed = lambda t: isinstance(t, T.StructType) or (isinstance(t, T.MapType) and _is_text(t.keyType))
    deeper = lambda x, xt, y, yt, name: same_value(x, xt, y, yt, name, numeric_fields)
    if isinstance(a_type, T.NullType) or isinstance(b_type, T.NullType):
        return none
    if _is_number(a_type) and _is_number(b_type):
        whole = isinstance(a_type, T.IntegralType) and isinstance(b_type, T.IntegralType)
        same = a == b if whole else _numbers(a, b)
    elif (_is_number(a_type) and _is_text(b_type)) or (_is_text(a_type) and _is_number(b_type)):
        listed = field.isin(*numeric_fields) if isinstance(field, Column) else F.lit(field in numeric_fields)
        same = listed & _numbers(a, b)
    elif isinstance(a_type, T.MapType) and isinstance(b_type, T.MapType) and a_type.keyType == b_type.keyType:
        value = lambda m, k: F.try_element_at(m, k)
        named = (lambda k: k) if _is_text(a_type.keyType) else (lambda k: None)
        same = F.forall(F.array_union(F.map_keys(a), F.map_keys(b)), lambda k: deeper(value(a, k), a_type.valueType, value(b, k), b_type.valueType, named(k)))
    elif keyed(a_type) and keyed(b_type):
        names = list(dict.fromkeys(n for t in (a_type, b_type) if isinstance(t, T.StructType) for n in t.names))
        same = F.lit(True)
        for n in names:
            same &= deeper(*_member(a, a_type, n), *_member(b, b_type, n), n)
        for m, t in ((a, a_type), (b, b_type)):
            if isinstance(t, T.MapType):  # what the struct doesn't name must be null
                same &= _null_beside(m, names)
    elif isinstance(a_type, T.ArrayType) and isinstance(b_type, T.ArrayType):
        each = F.zip_with(a, b, lambda x, y: deeper(x, a_type.elementType, y, b_type.elementType, None))
        same = (F.size(a) == F.size(b)) & F.forall(each, lambda x: x)
    elif (_is_text(a_type) and _is_text(b_type)) or a_type == b_type:
        same = a == b
    else:
        return none
    return none | F.coalesce(both & same, F.lit(False))


def _null_beside(pairs: Column, names: Sequence[str]) -> Column:
    return F.forall(F.map_keys(pairs), lambda k: k.isin(*names) | F.try_element_at(pairs, k).isNull())


def _numbers(a: Column, b: Column) -> Column:
    """Whether both are the same number. Short plain ones, nearly all there are, are exact as decimals; others go by number_key."""
    s, t = a.cast("string"), b.cast("string")
    plain = lambda x: (F.length(x) <= 18) & (F.translate(x, "0123456789.-", "") == "")
    same = F.coalesce(s.try_cast("decimal(38,18)") == t.try_cast("decimal(38,18)"), F.lit(False))
    x, y = number_key(s), number_key(t)
    exact = F.when(x.isNotNull() & y.isNotNull(), x == y).otherwise((s == t) & s.endswith("Infinity"))
    return F.when(plain(s) & plain(t), same).otherwise(exact)
