from tablezones.plans.changes import apply_changes, changed_rows, record_changes, zone_changes
from tablezones.plans.countries import (
    COUNTRIES,
    FEED_SCHEMA,
    CountryRules,
    derive_columns,
    key_only,
    transform_countries,
)
from tablezones.plans.rules import FeedRules, Field, Flag, Item, Variants, transform_feed
from tablezones.plans.pipelines import (
    Zones,
    run_end_to_end,
    save,
    serving_frame,
    structure,
    structured,
    transform,
    transformed,
)

__all__ = [
    "COUNTRIES",
    "FeedRules",
    "Field",
    "Flag",
    "Item",
    "Variants",
    "transform_feed",
    "FEED_SCHEMA",
    "CountryRules",
    "Zones",
    "apply_changes",
    "changed_rows",
    "derive_columns",
    "key_only",
    "record_changes",
    "run_end_to_end",
    "save",
    "serving_frame",
    "structure",
    "structured",
    "transform",
    "transform_countries",
    "transformed",
    "zone_changes",
]
