"""Deterministic row keys.

The key is a pure function of each row, so it is computed in place as a
column: no join, no shuffle, and duplicate or NULL names cannot fan rows out.
``join_attach_key`` covers the other case, a key table that comes from
elsewhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablezones import fixed_values as fv
from tablezones.errors import MissingColumnError
from tablezones.functions.fields import column, field_or_null, lookup_type
from tablezones.functions.strings import join_strings
from tablezones.functions.uuid5 import KEY_NAMESPACE, uuid5_digest, uuid5_from_digest, uuid5_python_udf, uuid5_udf
from tablezones.session import scratch_path

_UDFS = {"udf": uuid5_udf, "python": uuid5_python_udf}
_NAME, _DIGEST = "__uuid5_name", "__uuid5_digest"


def key_name(
    df: DataFrame,
    name: str = fv.KEY_SOURCE_COLUMN,
    parts: Sequence[str] = fv.KEY_SOURCE_FIELDS,
    sep: str = fv.KEY_SEPARATOR,
    strict: bool = False,
) -> Column:
    """Text that identifies a row: struct parts joined by ``sep`` (NULL parts
    skipped), a plain column as is, or NULL when the column is missing."""
    dtype = lookup_type(df, name)
    if dtype is None:
        if strict:
            raise MissingColumnError(f"key source column {name!r} not found")
        return F.lit(None).cast("string")
    if isinstance(dtype, StructType):
        return join_strings(sep, *[field_or_null(df, name, p) for p in parts])
    return column(name).cast("string")


def with_uuid5_key(
    df: DataFrame,
    source: Column,
    out: str = fv.KEY_COLUMN,
    namespace: str = KEY_NAMESPACE,
    method: str = "native",
) -> DataFrame:
    """Append (or replace) ``out`` = UUIDv5 of ``source``; NULL for empty names.

    ``method='native'`` (default) stays in whole-stage codegen: name and
    digest are computed in one projection and formatted in the next, which
    Catalyst keeps apart (it does not inline a non-cheap expression used
    several times), so each row is hashed once. ``'udf'`` (Arrow-batched) and
    ``'python'`` (row at a time) run the same function in a Python worker."""
    if method in _UDFS:
        return df.withColumn(out, _UDFS[method](source, namespace))
    if method != "native":
        raise ValueError(f"unknown key method {method!r}")
    hashed = df.withColumn(_NAME, source).withColumn(_DIGEST, uuid5_digest(F.col(_NAME), namespace))
    return hashed.withColumn(out, uuid5_from_digest(F.col(_DIGEST), F.col(_NAME))).drop(_NAME, _DIGEST)


def join_attach_key(
    df: DataFrame,
    keys: DataFrame,
    on: str,
    key_columns: Sequence[str],
    stage: bool = True,
    stage_path: str | None = None,
) -> DataFrame:
    """Left-join ``key_columns`` from ``keys`` on the same-named column ``on``.

    The key side is first reduced to one row per ``on`` value (partial
    aggregation map-side), so a duplicated name cannot multiply left rows. Of
    conflicting rows the least one by ``key_columns`` wins, whatever their
    order. NULL names never match and keep a NULL key.

    With ``stage`` (default) the reduced key table is written once under the
    shared checkpoint folder and read back. That cuts its lineage and leaves
    both join inputs as plain shuffles, the shape AQE needs to split a hot
    left key (say a third of all rows) across many tasks; a de-duplicating
    aggregate directly under the join would block that split. A small staged
    table is broadcast instead, by its measured size. The staged table is left
    in place (the returned frame reads it); the checkpoint folder's retention
    policy decides when it goes."""
    least = F.min(F.struct(*[column(c) for c in key_columns])).alias("least")
    right = keys.where(column(on).isNotNull()).groupBy(column(on)).agg(least)
    right = right.select(column(on), *[F.col("least").getField(c).alias(c) for c in key_columns])
    if stage:
        spark = df.sparkSession
        path = stage_path or scratch_path(spark, "attach-keys")
        right.write.mode("overwrite").parquet(path)
        right = spark.read.schema(right.schema).parquet(path)  # known schema: no footer job
    return df.join(right, on=on, how="left")
