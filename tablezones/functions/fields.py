"""Schema-aware field access.

Presence is decided from ``df.schema`` at plan time, never by catching an
analysis error: a missing column or nested field becomes a typed NULL literal
(or ``false`` for a presence flag), which Catalyst constant-folds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StringType, StructType


def column(name: str) -> Column:
    """Reference a top-level column by its exact name (dots and spaces allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def lookup_type(df: DataFrame, name: str) -> DataType | None:
    """Type of a top-level column, or None when absent (case-sensitive, like ``in df.columns``)."""
    for field in df.schema.fields:
        if field.name == name:
            return field.dataType
    return None


def field_or_null(df: DataFrame, name: str, field: str, null_type: DataType | str = StringType()) -> Column:
    """``name.field`` if the struct has that field (or value of key ``field`` for a
    map), else a NULL of ``null_type``."""
    dtype = lookup_type(df, name)
    if isinstance(dtype, StructType) and field in dtype.fieldNames():
        return column(name).getField(field)
    if isinstance(dtype, MapType):
        return F.try_element_at(column(name), F.lit(field))
    return F.lit(None).cast(null_type)


def has_key(df: DataFrame, name: str, key: str) -> Column:
    """True when nested ``key`` holds a non-NULL value; false when the row's value
    is NULL or the key is absent from the schema."""
    dtype = lookup_type(df, name)
    if isinstance(dtype, StructType):
        if key not in dtype.fieldNames():
            return F.lit(False)
        return column(name).getField(key).isNotNull()
    if isinstance(dtype, MapType):
        return F.try_element_at(column(name), F.lit(key)).isNotNull()
    return F.lit(False)


def array_item(arr: Column, index: int) -> Column:
    """Element at 0-based ``index``, NULL when out of range or the array is NULL.

    ``F.get`` keeps the non-ANSI ``getItem`` semantics under ANSI mode, where
    ``getItem`` on a short array raises INVALID_ARRAY_INDEX."""
    return F.get(arr, index)
