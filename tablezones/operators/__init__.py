"""DataFrame -> DataFrame operators, meant to be chained with ``DataFrame.transform``."""

from tablezones.operators.flatten import complex_columns, extract_variants, flatten_complex
from tablezones.operators.keys import join_attach_key, key_name, with_uuid5_key
from tablezones.operators.profile import map_sum, preview, profile_columns, row_count
from tablezones.operators.project import cast_columns, rename_columns, select_present, with_columns
from tablezones.operators.sketches import describe_sketches, merge_sketches, sketch_columns

__all__ = [
    "cast_columns",
    "complex_columns",
    "describe_sketches",
    "extract_variants",
    "flatten_complex",
    "join_attach_key",
    "key_name",
    "map_sum",
    "merge_sketches",
    "preview",
    "profile_columns",
    "rename_columns",
    "row_count",
    "select_present",
    "sketch_columns",
    "with_columns",
    "with_uuid5_key",
]
