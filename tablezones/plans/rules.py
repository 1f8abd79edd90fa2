"""Feed transform rules as data, and the one function that applies them.

A feed is flattened by: keeping an allow-list of columns, joining some arrays
into delimited strings in place, deriving new columns from nested values
(``Item``, ``Flag``, ``Field``, ``Variants``, in order), attaching a UUIDv5
key, JSON-encoding whatever is still nested, and renaming. Every rule whose
source column is absent is skipped; a missing nested key gives a typed NULL.
All derived columns are computed in one projection over the selected input,
and the whole chain collapses into one Project next to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, NullType, StringType, StructType

from tablezones import fixed_values as fv
from tablezones.errors import ColumnTypeError
from tablezones.functions.fields import array_item, column, field_or_null, has_key, lookup_type
from tablezones.functions.strings import join_array
from tablezones.operators.flatten import flatten_complex, variant_columns
from tablezones.operators.keys import key_name, with_uuid5_key
from tablezones.operators.project import rename_columns, select_present


def _array_item(df: DataFrame, name: str, index: int) -> Column:
    """Element ``index`` of array column ``name``.

    A field that is NULL in every inferred record comes back as a string
    column; it yields NULL here, and a non-NULL value in it fails the job with
    a clear message instead of being guessed at. Other types fail at once."""
    dtype = lookup_type(df, name)
    if isinstance(dtype, ArrayType):
        return array_item(column(name), index)
    if isinstance(dtype, (StringType, NullType)):
        message = F.lit(f"column {name!r} holds a non-array value")
        return F.when(column(name).isNull(), F.lit(None)).otherwise(F.raise_error(message))
    raise ColumnTypeError(f"column {name!r} must be an array, found {dtype.simpleString()}")


def _joinable(df: DataFrame, name: str) -> Column:
    """``name`` as something ``concat_ws`` accepts: a string, or an array whose
    elements are cast to string."""
    dtype = lookup_type(df, name)
    if isinstance(dtype, StringType):
        return column(name)
    if isinstance(dtype, ArrayType):
        if isinstance(dtype.elementType, StringType):
            return column(name)
        if not isinstance(dtype.elementType, (StructType, ArrayType, MapType)):
            return column(name).cast("array<string>")
    raise ColumnTypeError(f"column {name!r} of type {dtype.simpleString()} cannot be joined into a string")


@dataclass(frozen=True)
class Item:
    """``out`` = element ``index`` of array ``source`` (NULL when out of range),
    optionally ``try_cast`` (dirty text becomes NULL, as a non-ANSI cast did)."""

    out: str
    source: str
    index: int
    cast: str | None = None

    def columns(self, df: DataFrame) -> dict[str, Column]:
        value = _array_item(df, self.source, self.index)
        if self.cast:
            return {self.out: value.try_cast(self.cast)}
        return {self.out: value if isinstance(lookup_type(df, self.source), ArrayType) else value.cast("string")}


@dataclass(frozen=True)
class Flag:
    """``out`` = whether nested ``key`` of struct or map ``source`` is non-NULL."""

    out: str
    source: str
    key: str

    def columns(self, df: DataFrame) -> dict[str, Column]:
        return {self.out: has_key(df, self.source, self.key)}


@dataclass(frozen=True)
class Field:
    """``out`` = nested ``key`` of struct or map ``source``, or a typed NULL."""

    out: str
    source: str
    key: str
    null_type: str = "string"

    def columns(self, df: DataFrame) -> dict[str, Column]:
        return {self.out: field_or_null(df, self.source, self.key, self.null_type)}


@dataclass(frozen=True)
class Variants:
    """``<prefix><key>`` per allowed key of keyed struct or map ``source``."""

    source: str
    keys: tuple[str, ...]
    prefix: str

    def columns(self, df: DataFrame) -> dict[str, Column]:
        return variant_columns(df, self.source, self.keys, self.prefix)


@dataclass(frozen=True)
class FeedRules:
    """How one feed is flattened; see the module docstring for the order of steps."""

    allow_list: tuple[str, ...]
    joined: tuple[str, ...] = ()
    join_separator: str = "|"
    derived: tuple[Item | Flag | Field | Variants, ...] = ()
    renames: dict = field(default_factory=dict)
    key_source: str = fv.KEY_SOURCE_COLUMN
    key_parts: tuple[str, ...] = fv.KEY_SOURCE_FIELDS
    key_separator: str = fv.KEY_SEPARATOR
    key_column: str = fv.KEY_COLUMN
    key_namespace: str = fv.KEY_NAMESPACE
    key_method: str = "native"
    attach_key: bool = True
    keep: tuple[str, ...] = ()

    def keeping(self, columns: Sequence[str]) -> FeedRules:
        """Same rules, also carrying ``columns`` (placed first) through the transform."""
        return replace(self, keep=tuple(columns))


def derive_columns(df: DataFrame, rules: FeedRules) -> DataFrame:
    """Joined arrays in place, then every derived rule's columns appended in
    rule order; one projection, all reading the input values."""
    exprs = {c: join_array(_joinable(df, c), rules.join_separator) for c in rules.joined if c in df.columns}
    for rule in rules.derived:
        if rule.source in df.columns:
            exprs.update(rule.columns(df))
    return df.withColumns(exprs)


def transform_feed(df: DataFrame, rules: FeedRules) -> DataFrame:
    """Feed records -> flat rows: JSON text for nested values, renamed, keyed."""
    selected = select_present(df, [*rules.keep, *[c for c in rules.allow_list if c not in rules.keep]])
    out = derive_columns(selected, rules)
    if rules.attach_key:
        name = key_name(selected, rules.key_source, rules.key_parts, rules.key_separator)
        out = with_uuid5_key(out, name, rules.key_column, rules.key_namespace, rules.key_method)
    return out.transform(flatten_complex).transform(rename_columns, rules.renames)
