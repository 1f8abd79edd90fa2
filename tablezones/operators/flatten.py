"""Schema-driven flattening of nested columns into relational-sink-safe types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from tablezones.functions.fields import column, lookup_type
from tablezones.functions.json import is_complex, json_text


def complex_columns(df: DataFrame) -> list[str]:
    """Top-level columns of struct, array, map or variant type."""
    return [f.name for f in df.schema.fields if is_complex(f.dataType)]


def flatten_complex(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Encode every top-level complex column (or only ``columns``) as JSON text
    in place, in one projection; deeper levels live inside the JSON."""
    only = None if columns is None else set(columns)
    exprs = []
    for field in df.schema.fields:
        c = column(field.name)
        if is_complex(field.dataType) and (only is None or field.name in only):
            c = json_text(c, field.dataType)
        exprs.append(c.alias(field.name))
    return df.select(*exprs)


def variant_columns(df: DataFrame, name: str, keys: Iterable[str], prefix: str) -> dict[str, Column]:
    """``{<prefix><key>: value}`` for each allowed key of a keyed struct or map
    (empty for other types). A struct gives only the keys it has; a map's keys
    are not in the schema, so it gives every allowed key (NULL where absent).
    Complex values are JSON-encoded."""
    dtype = lookup_type(df, name)
    if isinstance(dtype, StructType):
        fields = {f.name: f.dataType for f in dtype.fields}
        return {f"{prefix}{k}": json_text(column(name).getField(k), fields[k]) for k in keys if k in fields}
    if isinstance(dtype, MapType):
        return {
            f"{prefix}{k}": json_text(F.try_element_at(column(name), F.lit(k)), dtype.valueType) for k in keys
        }
    return {}


def extract_variants(
    df: DataFrame,
    name: str,
    keys: Iterable[str],
    prefix: str | None = None,
    encode_whole: bool = True,
) -> DataFrame:
    """One column ``<prefix><key>`` per allowed key of a keyed struct or map
    (see :func:`variant_columns`); the whole column is then JSON-encoded in
    place unless ``encode_whole`` is false. All of it is one projection over
    the input, so derived columns read the original value."""
    if not isinstance(lookup_type(df, name), (StructType, MapType)):
        return df
    out = variant_columns(df, name, keys, f"{name}_" if prefix is None else prefix)
    if encode_whole:
        out[name] = F.to_json(column(name))
    return df.withColumns(out)
