"""JSON text for complex values.

``to_json`` semantics kept as-is: NULL struct fields are dropped, NULL array
elements and NULL map values are kept, NULL input gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

COMPLEX_TYPES = (StructType, ArrayType, MapType, VariantType)


def is_complex(dtype: DataType) -> bool:
    """Struct, array, map or variant: types a relational sink cannot hold directly."""
    return isinstance(dtype, COMPLEX_TYPES)


def json_text(value: Column, dtype: DataType) -> Column:
    """JSON text of a complex value; scalar values are returned unchanged."""
    return F.to_json(value) if is_complex(dtype) else value
