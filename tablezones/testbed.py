"""``entities``: a nested, feed-shaped table derived from the flat test tables.

One row per customer with the feed's column names, so every nested-data
operator runs on data whose size grows with the given tables. Structs,
arrays, a map, NULLs and empty arrays all occur.

Plan: customer x nation x region (the two dimensions are tiny; Catalyst
broadcasts them by their measured size) left-joined with one row per
customer of its distinct order priorities (aggregated map-side first, so a
customer holding a third of all orders costs one partial row per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablezones.sources.parquet import read_parquet

# Fixed values of the test bed (documented in SURVEY 7.2).
MAPS_PREFIX = "https://m/"
FLAGS_PREFIX = "https://f/"


# Schemas of the given test tables (types as stored), so reads skip the
# footer-inference job; tables not listed are read with inference.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables."""
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", schema=TABLE_SCHEMAS.get(name))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested, feed-shaped row per customer (see the module docstring)."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    priorities = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))
    )
    base = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .join(priorities, customer.c_custkey == priorities.o_custkey, "left")
    )
    nk = F.col("n_nationkey")
    every_fifth = nk % 5 == 0
    return base.select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_name").alias("common"), F.col("c_mktsegment").alias("official")).alias("name"),
        F.lpad(nk.cast("string"), 3, "0").alias("ccn3"),
        F.when(every_fifth, F.array().cast("array<double>"))
        .otherwise(F.array(nk.cast("double"), F.col("n_regionkey").cast("double")))
        .alias("latlng"),
        (F.col("c_acctbal") > 0).alias("independent"),
        F.when(every_fifth, F.array().cast("array<string>")).otherwise(F.array(F.col("n_name"))).alias("capital"),
        F.when(nk % 7 != 3, F.col("priorities")).alias("altSpellings"),
        F.struct(
            F.when(nk % 2 == 0, F.col("n_name")).alias("eng"),
            F.col("r_name").alias("fra"),
        ).alias("languages"),
        F.struct(
            F.struct(F.col("n_name").alias("common"), F.col("r_name").alias("official")).alias("deu"),
            F.struct(F.col("r_name").alias("common"), F.col("n_name").alias("official")).alias("fra"),
        ).alias("translations"),
        F.struct(F.concat(F.lit(MAPS_PREFIX), F.col("c_custkey").cast("string")).alias("googleMaps")).alias("maps"),
        F.struct(F.concat(F.lit(FLAGS_PREFIX), nk.cast("string"), F.lit(".png")).alias("png")).alias("flags"),
        F.array(F.lit("UTC"), F.col("c_mktsegment")).alias("timezones"),
        F.array(F.col("r_name")).alias("continents"),
        F.col("r_name").alias("region"),
        F.create_map(F.lit("seg"), F.col("c_mktsegment"), F.lit("reg"), F.col("r_name")).alias("attrs"),
    )


def entities_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entities`` without the map column, i.e. what a JSON feed can carry
    back unchanged under inference (a JSON object infers as a struct)."""
    return entities(spark, sf_dir).drop("attrs")
