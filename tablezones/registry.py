"""Named queries over the given test tables, one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input. Sources and sinks really write to and read from a fresh directory
under the session's shared checkpoint folder. Column names match the SQL
oracles in :mod:`tablezones.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablezones import testbed
from tablezones.errors import MissingInputError
from tablezones.functions import array_item, column, field_or_null, has_key, join_array, join_strings, json_text
from tablezones.operators import (
    cast_columns,
    describe_sketches,
    extract_variants,
    flatten_complex,
    join_attach_key,
    key_name,
    map_sum,
    merge_sketches,
    preview,
    profile_columns,
    rename_columns,
    row_count,
    select_present,
    sketch_columns,
    with_columns,
    with_uuid5_key,
)
from tablezones.operators.sketches import FREQUENT_ERROR, RANK_ERROR, distinct_error
from tablezones.plans import COUNTRIES, Zones, key_only, record_changes, run_end_to_end, serving_frame, structure, transform
from tablezones.fixed_values import TRANSLATION_CODES, TRANSLATION_PREFIX
from tablezones.session import scratch_path
from tablezones.sinks import land_json_documents, land_json_lines, prepare_for_jdbc, write_parquet
from tablezones.sources import CORRUPT_COLUMN, read_json_documents, read_json_lines, read_parquet
from tablezones.sources.json_ranges import RECORD_COLUMNS, read_json_ranges
from tablezones.streaming import run_incremental_transform

Query = Callable[[SparkSession, str], DataFrame]

TEST_RULES = COUNTRIES.keeping(["id"])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return testbed.table(spark, sf_dir, name)


def _landed_feed(spark: SparkSession, sf_dir: str, label: str) -> tuple[Zones, StructType]:
    """Land the nested test bed as JSON array documents in a fresh raw zone."""
    zones = Zones.under(scratch_path(spark, label))
    return zones, land_json_documents(testbed.entities_feed(spark, sf_dir), zones.raw).schema


# --- sources ---------------------------------------------------------------

def src_parquet_scan(spark, sf_dir):
    return _table(spark, sf_dir, "customer")


def src_json_lines(spark, sf_dir):
    path = scratch_path(spark, "src_json_lines")
    landed = land_json_lines(_table(spark, sf_dir, "events"), path)
    return read_json_lines(spark, path, schema=landed.schema).drop(CORRUPT_COLUMN)


def src_json_multiline(spark, sf_dir):
    zones, _ = _landed_feed(spark, sf_dir, "src_json_multiline")
    # Schema inferred, as a feed of unknown shape is read; nested columns shown as JSON text.
    return flatten_complex(read_json_documents(spark, zones.raw))


def src_json_ranges(spark, sf_dir):
    zones, landed = _landed_feed(spark, sf_dir, "src_json_ranges")
    return flatten_complex(read_json_ranges(spark, zones.raw, landed).drop(CORRUPT_COLUMN, *RECORD_COLUMNS))


def src_missing_path(spark, sf_dir):
    supplier = _table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "src_missing_path")
    write_parquet(supplier, path)
    refused = 0
    for read in (read_parquet, read_json_documents, read_json_lines):
        try:
            write_parquet(read(spark, f"{path}_missing"), path)
        except MissingInputError:
            refused += 1
    assert refused == 3  # every reader stops before anything is replaced
    return read_parquet(spark, path, schema=supplier.schema)


# --- sinks -----------------------------------------------------------------

def snk_parquet_overwrite(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    path = scratch_path(spark, "snk_parquet_overwrite")
    write_parquet(_table(spark, sf_dir, "nation"), path)
    write_parquet(orders, path)  # replaces what was there
    return read_parquet(spark, path, schema=orders.schema)


def snk_jdbc_overwrite(spark, sf_dir):
    # The frame handed to the JDBC writer; no database is started here.
    return prepare_for_jdbc(testbed.entities(spark, sf_dir))


def gate_nonempty(spark, sf_dir):
    nation = _table(spark, sf_dir, "nation")
    path = scratch_path(spark, "gate_nonempty")
    write_parquet(nation, path, require_rows=True)
    refused = write_parquet(nation.where(F.col("n_nationkey").isNull()), path, require_rows=True)
    assert not refused.written  # an empty result keeps the table
    return read_parquet(spark, path)


# --- projections and predicates --------------------------------------------

def prj_select_present(spark, sf_dir):
    return select_present(_table(spark, sf_dir, "part"), ["p_partkey", "p_name", "p_color", "p_size"])


def prj_with_columns(spark, sf_dir):
    return with_columns(_table(spark, sf_dir, "lineitem"), {"twice": F.col("l_linenumber") * 2, "l_returnflag": F.upper("l_returnflag")})


def prj_rename_map(spark, sf_dir):
    return rename_columns(_table(spark, sf_dir, "region"), {"r_regionkey": "ma_khu_vuc", "r_name": "Khu_vuc"})


def prj_struct_field(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select("id", F.col("name.common").alias("name_common"), F.col("name.official").alias("name_official"))


def prj_array_item(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select(
        "id",
        array_item(F.col("capital"), 0).alias("capital_1"),
        array_item(F.col("timezones"), 0).alias("timezone_1"),
    )


def prj_cast_double(spark, sf_dir):
    return cast_columns(_table(spark, sf_dir, "orders"), {"o_custkey": "double", "o_orderkey": "double"})


def prj_field_or_null(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select(
        "id",
        field_or_null(ent, "maps", "googleMaps").alias("Google_Maps"),
        field_or_null(ent, "flags", "svg").alias("svg_flags"),
    )


def pred_is_not_null(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select("id", has_key(ent, "languages", "eng").alias("su_dung_tieng_anh"))


# --- scalar functions ------------------------------------------------------

def str_concat_ws(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select("id", join_strings(" - ", F.col("name.common"), F.col("name.official")).alias("name1"))


def str_array_join(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select(
        "id", join_array(F.col("altSpellings")).alias("altSpellings"), join_array(F.col("capital")).alias("capital")
    )


def _json(df: DataFrame, name: str):
    return json_text(column(name), df.schema[name].dataType)


def json_encode_struct(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select("id", _json(ent, "languages").alias("languages"))


def json_encode_array(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select("id", _json(ent, "altSpellings").alias("alt"), _json(ent, "latlng").alias("latlng"))


def json_encode_map(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return ent.select("id", _json(ent, "attrs").alias("attrs"))


def flatten_complex_q(spark, sf_dir):
    return flatten_complex(testbed.entities(spark, sf_dir))


def json_extract_variants(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir).select("id", "translations")
    out = extract_variants(ent, "translations", TRANSLATION_CODES, prefix=TRANSLATION_PREFIX)
    return out.select("id", "translation_fra", "translation_deu", "translations")


# --- keys and join ---------------------------------------------------------

def key_uuid5_native(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return with_uuid5_key(ent, key_name(ent), "country_id").select("id", "country_id")


def key_uuid5_udf(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    return with_uuid5_key(ent, key_name(ent), "country_id", method="udf").select("id", "country_id")


def join_attach_key_q(spark, sf_dir):
    ent = testbed.entities(spark, sf_dir)
    named = ent.select("id", key_name(ent).alias("name1"))
    return join_attach_key(named, key_only(ent), "name1", ["country_id"]).select("id", "country_id")


# --- aggregates, preview, profile ------------------------------------------

def agg_count(spark, sf_dir):
    return row_count(_table(spark, sf_dir, "lineitem"))


def agg_map_sum(spark, sf_dir):
    return map_sum(_table(spark, sf_dir, "lineitem"), F.col("l_linenumber").cast("bigint") * 2)


def lim_preview(spark, sf_dir):
    return preview(_table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


def profile_columns_q(spark, sf_dir):
    return profile_columns(testbed.entities(spark, sf_dir))


def profile_sketches(spark, sf_dir):
    """Sketches of two parts of lineitem, merged, and whether they are within bounds of the exact figures."""
    names, quantiles = ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"], (0.25, 0.5, 0.75)
    lineitem = _table(spark, sf_dir, "lineitem").select(*names, "l_linestatus")
    shipped = F.col("l_linestatus").eqNullSafe("F")
    parts = [sketch_columns(lineitem.where(side), names) for side in (shipped, ~shipped)]
    drawn = {r["column_name"]: r for r in describe_sketches(merge_sketches(*parts), quantiles).collect()}  # a row a column
    # Quantiles and counts hold with high probability; three times their bounds hold always, in effect.
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for name in names:
        d, c = drawn[name], F.col(name)
        n, ok = F.count(c), F.lit(True)
        aggs += [n.alias(f"n_{name}"), F.countDistinct(c).alias(f"distinct_{name}")]
        for q, value in zip(quantiles, d["quantiles"] or []):
            ok = ok & (F.count_if(c < value) <= (q + 3 * RANK_ERROR) * n) & (F.count_if(c <= value) >= (q - 3 * RANK_ERROR) * n)
        aggs.append(ok.alias(f"ranks_{name}"))
        ok = F.lit(True)
        for item, times in d["top"]:
            ok = ok & (F.abs(F.count_if(c.cast("string") == item) - times) <= 3 * FREQUENT_ERROR * n)
        aggs.append(ok.alias(f"top_{name}"))
    exact = lineitem.agg(*aggs)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("n_rows"),
            F.lit(drawn[name]["n_rows"] - drawn[name]["n_nulls"]).cast("long").alias("n_values"),
            F.col(f"distinct_{name}").alias("n_distinct"),
            (F.abs(F.col(f"distinct_{name}") - drawn[name]["n_distinct"]) <= 4 * distinct_error() * F.col(f"distinct_{name}")).alias("distinct_ok"),
            F.col(f"ranks_{name}").alias("ranks_ok"),
            F.col(f"top_{name}").alias("top_ok"),
        )
        for name in names
    ]
    return exact.select(F.inline(F.array(*rows)))


# --- pipelines -------------------------------------------------------------

def pipe_structure(spark, sf_dir):
    zones, landed = _landed_feed(spark, sf_dir, "pipe_structure")
    report = structure(spark, zones.raw, zones.foundation, landed_schema=landed)
    return flatten_complex(read_parquet(spark, zones.foundation, schema=report.schema))


def _through_trusted(spark, sf_dir, label):
    """The trusted zone after landing, structure and transform, and its schema."""
    zones, landed = _landed_feed(spark, sf_dir, label)
    first = structure(spark, zones.raw, zones.foundation, landed_schema=landed)
    return zones.trusted, transform(spark, zones.foundation, zones.trusted, TEST_RULES, first.schema).schema


def pipe_transform(spark, sf_dir):
    trusted, schema = _through_trusted(spark, sf_dir, "pipe_transform")
    return read_parquet(spark, trusted, schema=schema)


def pipe_save(spark, sf_dir):
    # The save stage up to the JDBC writer; no database is started here.
    trusted, schema = _through_trusted(spark, sf_dir, "pipe_save")
    return serving_frame(spark, trusted, schema)


def pipe_end_to_end(spark, sf_dir):
    zones, landed = _landed_feed(spark, sf_dir, "pipe_end_to_end")
    reports = run_end_to_end(spark, zones, rules=TEST_RULES, landed_schema=landed)
    return read_parquet(spark, zones.trusted, schema=reports["transform"].schema)


def pipe_transform_stream(spark, sf_dir):
    """Land the feed in two parts and run the stream after each, into one table."""
    zones = Zones.under(scratch_path(spark, "pipe_transform_stream"))
    checkpoint = scratch_path(spark, "pipe_transform_stream-checkpoint")
    feed = testbed.entities_feed(spark, sf_dir)
    for half in (0, 1):
        land_json_documents(feed.where(F.col("id") % 2 == half), zones.raw, mode="append")
        run_incremental_transform(spark, zones.raw, zones.trusted, feed.schema, checkpoint, rules=TEST_RULES)
    return read_parquet(spark, zones.trusted)


def pipe_changes(spark, sf_dir):
    """Two versions of the orders zone and the recorded history of what changed between them."""
    orders = _table(spark, sf_dir, "orders")
    root = scratch_path(spark, "pipe_changes")
    # Before: no pending orders yet, and all others open. After: without those of low priority.
    before = orders.where("o_orderstatus <> 'P'").withColumn("o_orderstatus", F.lit("O"))
    after = orders.where("o_orderpriority <> '5-LOW'")
    versions = []
    for number, version in enumerate((before, after)):
        report = write_parquet(version, f"{root}/orders-{number}")
        versions.append(read_parquet(spark, report.target, schema=report.schema))
    recorded = record_changes(*versions, ["o_orderkey"], f"{root}/history", version=1)
    return read_parquet(spark, f"{root}/history", schema=f"{recorded.schema.toDDL()}, version int")


QUERIES: dict[str, Query] = {
    "src_parquet_scan": src_parquet_scan,
    "src_json_lines": src_json_lines,
    "src_json_multiline": src_json_multiline,
    "src_json_ranges": src_json_ranges,
    "src_missing_path": src_missing_path,
    "snk_parquet_overwrite": snk_parquet_overwrite,
    "snk_jdbc_overwrite": snk_jdbc_overwrite,
    "gate_nonempty": gate_nonempty,
    "prj_select_present": prj_select_present,
    "prj_with_columns": prj_with_columns,
    "prj_rename_map": prj_rename_map,
    "prj_struct_field": prj_struct_field,
    "prj_array_item": prj_array_item,
    "prj_cast_double": prj_cast_double,
    "prj_field_or_null": prj_field_or_null,
    "pred_is_not_null": pred_is_not_null,
    "str_concat_ws": str_concat_ws,
    "str_array_join": str_array_join,
    "json_encode_struct": json_encode_struct,
    "json_encode_array": json_encode_array,
    "json_encode_map": json_encode_map,
    "flatten_complex": flatten_complex_q,
    "json_extract_variants": json_extract_variants,
    "key_uuid5_native": key_uuid5_native,
    "key_uuid5_udf": key_uuid5_udf,
    "join_attach_key": join_attach_key_q,
    "agg_count": agg_count,
    "agg_map_sum": agg_map_sum,
    "lim_preview": lim_preview,
    "profile_columns": profile_columns_q,
    "profile_sketches": profile_sketches,
    "pipe_structure": pipe_structure,
    "pipe_transform": pipe_transform,
    "pipe_save": pipe_save,
    "pipe_end_to_end": pipe_end_to_end,
    "pipe_transform_stream": pipe_transform_stream,
    "pipe_changes": pipe_changes,
}
