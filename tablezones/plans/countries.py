"""The countries rule set: nested country records -> one flat, keyed row each.

Everything here is data built from ``fixed_values``; the work is done by
:func:`tablezones.plans.rules.transform_feed`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablezones import fixed_values as fv
from tablezones.operators.keys import key_name, with_uuid5_key
from tablezones.plans.rules import Field, FeedRules, Flag, Item, Variants, derive_columns, transform_feed

CountryRules = FeedRules

COUNTRIES = FeedRules(
    allow_list=fv.ALLOW_LIST,
    joined=fv.PIPE_JOINED,
    join_separator=fv.JOIN_SEPARATOR,
    derived=(
        Item(*fv.LAT, cast="double"),
        Item(*fv.LNG, cast="double"),
        Flag(*fv.ENGLISH_FLAG),
        Variants("translations", fv.TRANSLATION_CODES, fv.TRANSLATION_PREFIX),
        Field(*fv.GOOGLE_MAPS),
        Item(*fv.FIRST_TIMEZONE),
        Field(*fv.SVG_FLAG),
    ),
    renames=dict(fv.RENAMES),
)

# Declared types for the countries feed. They type the open key sets (language
# and translation codes) as maps, so the trusted table gets the same columns
# whatever codes a run's data holds. Fields that the data has beyond these are
# kept with inferred types. Fields absent from the data read as NULL (and vanish
# from JSON text); map JSON follows the source's key order.
FEED_SCHEMA = (
    "name struct<common:string,official:string,nativeName:map<string,struct<common:string,official:string>>>, "
    "ccn3 string, cca3 string, latlng array<double>, independent boolean, status string, "
    "translations map<string,struct<common:string,official:string>>, capital array<string>, "
    "altSpellings array<string>, languages map<string,string>, region string, area double, "
    "maps struct<googleMaps:string,openStreetMaps:string>, timezones array<string>, continents array<string>, "
    "flags struct<alt:string,png:string,svg:string>, startOfWeek string"
)


def transform_countries(df: DataFrame, rules: FeedRules = COUNTRIES) -> DataFrame:
    """Country records -> flat trusted rows keyed by a UUIDv5 of
    ``name.common - name.official``."""
    return transform_feed(df, rules)


def key_only(df: DataFrame, rules: FeedRules = COUNTRIES) -> DataFrame:
    """Just the key name and its UUID, e.g. to feed ``join_attach_key``."""
    name = key_name(df, rules.key_source, rules.key_parts, rules.key_separator)
    return df.select(name.alias("name1")).transform(
        with_uuid5_key, F.col("name1"), rules.key_column, rules.key_namespace, rules.key_method
    )


__all__ = ["COUNTRIES", "FEED_SCHEMA", "CountryRules", "derive_columns", "key_only", "transform_countries"]
