"""Delimited string building with ``concat_ws`` semantics: NULL inputs and NULL
array elements are skipped; a NULL or empty array gives '' (never NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_strings(sep: str, *values: Column) -> Column:
    """Scalars joined by ``sep``, skipping NULLs; '' when all are NULL."""
    return F.concat_ws(sep, *values)


def join_array(arr: Column, sep: str = "|") -> Column:
    """Array elements joined by ``sep``; '' for a NULL or empty array."""
    return F.concat_ws(sep, arr)
