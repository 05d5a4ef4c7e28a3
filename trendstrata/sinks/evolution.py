"""How the columns of a stored table and of new rows become one schema.

Two types meet in the least one that holds both: the wider of two integers, a
double for an integer and a fraction, text for anything else; structs, arrays
and maps meet field by field.  Fields that have only ever been NULL have no
type and are not stored until a value comes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstrata.functions.text import quoted

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
# Decimal digits that hold every value of an integer type.
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_MOST_DIGITS = 38


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[kind], 0) if kind in _DIGITS else None


def _common_number(a: T.DataType, b: T.DataType) -> T.DataType:
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    exact = _decimal(a), _decimal(b)
    if None not in exact:
        scale = max(d.scale for d in exact)
        digits = max(d.precision - d.scale for d in exact) + scale
        if digits <= _MOST_DIGITS:
            return T.DecimalType(digits, scale)
    return T.DoubleType()


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _common_number(a, b)
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Fields of both in the order of ``a``; names that differ by letter case alone are one field."""
    other = {f.name.lower(): f for f in b.fields}
    mine = {f.name.lower() for f in a.fields}
    both = [
        T.StructField(f.name, common_type(f.dataType, other[f.name.lower()].dataType) if f.name.lower() in other else f.dataType)
        for f in a.fields
    ]
    return T.StructType([*both, *[T.StructField(f.name, f.dataType) for f in b.fields if f.name.lower() not in mine]])


def known_type(kind: T.DataType) -> T.DataType | None:
    """``kind`` without what has only ever been NULL, or None if that is all of it."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.StructType):
        fields = [(f.name, known_type(f.dataType)) for f in kind.fields]
        kept = [T.StructField(name, known) for name, known in fields if known is not None]
        return T.StructType(kept) if kept else None
    if isinstance(kind, T.ArrayType):
        element = known_type(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.MapType):
        value = known_type(kind.valueType)
        return None if value is None else T.MapType(kind.keyType, value)
    return kind


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for whether values may be NULL."""
    return a.simpleString() == b.simpleString()


def fitted(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` as the wider type; nested values that become text are JSON."""
    if same_type(have, want):
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        known = {f.name.lower(): f for f in have.fields}
        fields = [
            fitted(column.getField(known[f.name.lower()].name), known[f.name.lower()].dataType, f.dataType)
            if f.name.lower() in known
            else F.lit(None).cast(f.dataType)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(fields, want.fields, strict=True)]))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: fitted(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        keys = F.transform(F.map_keys(column), lambda k: fitted(k, have.keyType, want.keyType))
        return F.map_from_arrays(keys, F.transform(F.map_values(column), lambda v: fitted(v, have.valueType, want.valueType)))
    if isinstance(have, _NESTED) and isinstance(want, T.StringType):
        return F.to_json(column)
    return column.cast(want)


def fitted_rows(df: DataFrame, want: T.StructType) -> DataFrame:
    """``df`` in the shape of ``want``; columns it lacks are NULL, others it has are left out."""
    known = {f.name.lower(): f for f in df.schema.fields}
    columns = [
        fitted(F.col(quoted(known[f.name.lower()].name)), known[f.name.lower()].dataType, f.dataType)
        if f.name.lower() in known
        else F.lit(None).cast(f.dataType)
        for f in want.fields
    ]
    return df.select(*[c.alias(f.name) for c, f in zip(columns, want.fields, strict=True)])
