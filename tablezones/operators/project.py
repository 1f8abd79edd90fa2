"""Projection operators. Each is one ``select`` (one Project node), so a chain
of them collapses into a single projection fused with the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame

from tablezones.errors import MissingColumnError, RenameCollisionError
from tablezones.functions.fields import column


def select_present(df: DataFrame, wanted: Iterable[str], strict: bool = False) -> DataFrame:
    """Columns of ``wanted`` that exist, in ``wanted`` order; absent ones are
    skipped (or raise in strict mode). Prunes the scan to those columns."""
    wanted = list(wanted)
    present = set(df.columns)
    missing = [c for c in wanted if c not in present]
    if strict and missing:
        raise MissingColumnError(f"columns not found: {missing}")
    return df.select(*[column(c) for c in wanted if c in present])


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection. A replaced column keeps
    its position; new ones are appended in mapping order."""
    return df.withColumns(dict(exprs))


def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Rename by mapping, all names at once (a swap works). A missing source
    column is a no-op (or an error in strict mode). Raises before any job runs
    when two result names would differ only by case, which Parquet and most
    databases reject."""
    missing = [old for old in mapping if old not in df.columns]
    if strict and missing:
        raise MissingColumnError(f"columns to rename not found: {missing}")
    applied = {old: new for old, new in mapping.items() if old in df.columns}
    result = [applied.get(c, c) for c in df.columns]
    seen: dict[str, str] = {}
    for name in result:
        key = name.lower()
        if key in seen:
            raise RenameCollisionError(f"rename gives duplicate column {name!r} (clashes with {seen[key]!r})")
        seen[key] = name
    if not applied:
        return df
    # One select applies all renames at once; withColumnsRenamed applies them
    # in turn, so a swap such as {a: b, b: a} would leave two columns named a.
    return df.select(*[column(c).alias(applied.get(c, c)) for c in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast columns in place. Under ANSI mode an invalid value raises; with
    ``safe`` it becomes NULL instead (``try_cast``)."""
    return df.withColumns(
        {c: (column(c).try_cast(t) if safe else column(c).cast(t)) for c, t in types.items() if c in df.columns}
    )
