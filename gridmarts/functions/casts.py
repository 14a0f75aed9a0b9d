"""Lenient casts: unreadable values become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient_int(df: DataFrame, name: str) -> Column:
    """Integer from a text or number column.

    Text rounds half away from zero ('12.5' -> 13), floating numbers half to even
    (2.5 -> 2). Plain digits take the first, cheaper branch.
    """
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.trim(col)
        rounded = F.round(text.try_cast("double")).try_cast("int")
        return F.coalesce(text.try_cast("int"), rounded)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.bround(col).try_cast("int")
    return col.try_cast("int")


def to_double(col: Column) -> Column:
    return col.try_cast("double")


def to_real(col: Column) -> Column:
    return col.try_cast("float")


def to_bool(col: Column) -> Column:
    return col.try_cast("boolean")
