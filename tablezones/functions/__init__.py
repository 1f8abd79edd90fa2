"""Column -> Column building blocks. All are JVM-side Spark expressions except
the UUID UDFs, which exist to compare against the native key expression."""

from tablezones.functions.fields import array_item, column, field_or_null, has_key, lookup_type
from tablezones.functions.json import is_complex, json_text
from tablezones.functions.strings import join_array, join_strings
from tablezones.functions.uuid5 import (
    KEY_NAMESPACE,
    uuid5,
    uuid5_digest,
    uuid5_from_digest,
    uuid5_python_udf,
    uuid5_udf,
)

__all__ = [
    "KEY_NAMESPACE",
    "array_item",
    "column",
    "field_or_null",
    "has_key",
    "is_complex",
    "join_array",
    "join_strings",
    "json_text",
    "lookup_type",
    "uuid5",
    "uuid5_digest",
    "uuid5_from_digest",
    "uuid5_python_udf",
    "uuid5_udf",
]
