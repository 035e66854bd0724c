"""Numeric casts with the rounding the published models use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def half_even_int(df: DataFrame, column: str) -> Column:
    """Integer cast that rounds halves to even (a plain Spark cast truncates)."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return col.cast("int")
    return F.rint(col.cast("double")).cast("int")
