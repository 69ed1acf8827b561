"""A lattice of column types for JSON members: what a field is after all the batches that had it.

``null < bigint < decimal < double < string``; structs are joined by member and arrays by element; kinds that have
nothing else in common (a struct and a number, a boolean and a number) are text.  ``widen`` is commutative up to the order
of members, associative and idempotent, so a batch that is folded in twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import types as T

LONG_DIGITS, MOST_DIGITS = 19, 38


def known(t: T.DataType) -> T.DataType:
    """An inferred type as one of the lattice: members of mixed kinds are text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, known(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(known(t.elementType))
    if isinstance(t, T.IntegralType):
        return T.LongType()
    if isinstance(t, T.FloatType):
        return T.DoubleType()
    if isinstance(t, (T.NullType, T.DecimalType, T.DoubleType, T.BooleanType)):
        return t
    return T.StringType()


def _digits(t: T.DataType) -> tuple[int, int]:
    """Digits before and after the point that the type must hold."""
    return (LONG_DIGITS, 0) if isinstance(t, T.LongType) else (t.precision - t.scale, t.scale)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type of the lattice that holds the values of both; members keep ``a``'s order, new ones come after."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        left, right = ({f.name: f.dataType for f in s.fields} for s in (a, b))
        joined = {n: widen(t, right[n]) if n in right else t for n, t in left.items()}
        return T.StructType([T.StructField(n, t) for n, t in (joined | {n: t for n, t in right.items() if n not in left}).items()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    numbers = (T.LongType, T.DecimalType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType):
            return T.DoubleType()
        whole, scale = (max(x, y) for x, y in zip(_digits(a), _digits(b)))
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.DoubleType()
    return T.StringType()


def readable(t: T.DataType) -> T.DataType:
    """The type to parse with: members that were only ever null, and objects without a member, are text until more is known."""
    if isinstance(t, T.StructType) and t.fields:
        return T.StructType([T.StructField(f.name, readable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(readable(t.elementType))
    return T.StringType() if isinstance(t, (T.NullType, T.StructType)) else t
