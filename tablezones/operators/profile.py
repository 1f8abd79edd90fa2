"""Counting, previews and column profiles, each as one DataFrame (one pass)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablezones.functions.fields import column, lookup_type
from tablezones.functions.json import is_complex


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """One row with the global row count (partial counts per task, then one merge)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def map_sum(df: DataFrame, value: Column, alias: str = "total") -> DataFrame:
    """Sum of a per-row expression, e.g. ``col * 2``, over all rows."""
    return df.agg(F.sum(value).alias(alias))


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """First ``n`` rows by a total order (TakeOrderedAndProject: per-task top-n,
    then a merge of n rows per task), so repeated runs agree."""
    return df.orderBy(*order_by).limit(n)


def profile_columns(df: DataFrame, columns: Iterable[str] | None = None, with_types: bool = False) -> DataFrame:
    """One row per column: name, whether it is complex, row count, NULL count
    (and the type's DDL text with ``with_types``).

    All counts come from a single aggregation pass; the result is unpivoted
    from the one aggregate row. Types come from the schema, not the data."""
    names = list(df.columns if columns is None else columns)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(column(c).isNull()).alias(f"n_nulls_{i}") for i, c in enumerate(names)]
    stats = df.agg(*aggs)
    rows = []
    for i, c in enumerate(names):
        fields = [
            F.lit(c).alias("column_name"),
            F.lit(is_complex(lookup_type(df, c))).alias("is_complex"),
            F.col("n_rows").alias("n_rows"),
            F.col(f"n_nulls_{i}").alias("n_nulls"),
        ]
        if with_types:
            fields.append(F.lit(lookup_type(df, c).simpleString()).alias("data_type"))
        rows.append(F.struct(*fields))
    return stats.select(F.inline(F.array(*rows)))
