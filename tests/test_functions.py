import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from tablezones.functions import (
    KEY_NAMESPACE,
    array_item,
    field_or_null,
    has_key,
    join_array,
    join_strings,
    json_text,
    uuid5,
    uuid5_python_udf,
    uuid5_udf,
)

NS = uuid.UUID(KEY_NAMESPACE)
NAMES = [
    "Vietnam - Socialist Republic of Vietnam",
    "Việt Nam - Cộng hòa Xã hội chủ nghĩa Việt Nam",
    "日本 - 日本国",
    "Ελλάδα",
    "emoji 🚀 name",
    " ",
    "a",
    "",
    None,
]


def expected(name):
    return str(uuid.uuid5(NS, name)) if name else None


def test_uuid5_native_and_udfs_match_python(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    rows = df.select(
        "n", uuid5(F.col("n")).alias("a"), uuid5_udf(F.col("n")).alias("b"), uuid5_python_udf(F.col("n")).alias("c")
    ).collect()
    for r in rows:
        assert r.a == expected(r.n)
        assert r.b == r.a and r.c == r.a


def test_golden_key(spark):
    df = spark.createDataFrame([("Vietnam - Socialist Republic of Vietnam",)], "n string")
    assert df.select(uuid5(F.col("n"))).first()[0] == "e6f518c2-2892-5035-b246-3b88cd7318e6"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=60))
def test_uuid5_property(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(uuid5(F.col("n"))).collect()]
    assert got == [expected(n) for n in names]


def test_uuid5_stays_in_codegen(spark):
    df = spark.range(3).select(uuid5(F.col("id").cast("string")).alias("k"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_join_array_semantics(spark):
    df = spark.createDataFrame([(None,), ([],), (["a", None, "b"],), ([None],)], "a array<string>")
    assert [r[0] for r in df.select(join_array(F.col("a"))).collect()] == ["", "", "a|b", ""]


def test_join_strings_skips_nulls(spark):
    df = spark.createDataFrame([("x", "y"), (None, "y"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(join_strings(" - ", F.col("a"), F.col("b"))).collect()] == ["x - y", "y", ""]


def test_json_text_null_rules(spark):
    schema = "s struct<a:string,b:string>, arr array<string>, m map<string,string>, x int"
    df = spark.createDataFrame([({"a": "1", "b": None}, ["p", None], {"k": None}, 5), (None, None, None, None)], schema)
    types = {f.name: f.dataType for f in df.schema.fields}
    rows = df.select(*[json_text(F.col(c), types[c]).alias(c) for c in df.columns]).collect()
    assert rows[0].s == '{"a":"1"}'
    assert rows[0].arr == '["p",null]'
    assert rows[0].m == '{"k":null}'
    assert rows[0].x == 5  # scalars pass through
    assert rows[1].s is None and rows[1].arr is None and rows[1].m is None


def test_array_item_out_of_range_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", None, "True")
    df = spark.createDataFrame([([1.0, 2.0],), ([],), (None,)], "a array<double>")
    rows = df.select(array_item(F.col("a"), 0).alias("x"), array_item(F.col("a"), 1).alias("y")).collect()
    assert [(r.x, r.y) for r in rows] == [(1.0, 2.0), (None, None), (None, None)]


def test_field_or_null_and_has_key(spark):
    schema = StructType(
        [
            StructField("s", StructType([StructField("eng", StringType()), StructField("fra", StringType())])),
            StructField("m", MapType(StringType(), StringType())),
            StructField("t", ArrayType(StringType())),
        ]
    )
    df = spark.createDataFrame(
        [({"eng": "E", "fra": "F"}, {"eng": "E"}, ["x"]), ({"eng": None, "fra": "F"}, {"x": "1"}, None), (None, None, None)],
        schema,
    )
    out = df.select(
        field_or_null(df, "s", "eng").alias("s_eng"),
        field_or_null(df, "s", "svg").alias("s_svg"),
        field_or_null(df, "m", "eng").alias("m_eng"),
        field_or_null(df, "missing", "eng").alias("gone"),
        has_key(df, "s", "eng").alias("hs"),
        has_key(df, "s", "zzz").alias("hs_absent"),
        has_key(df, "m", "eng").alias("hm"),
        has_key(df, "missing", "eng").alias("hgone"),
    )
    assert dict(out.dtypes)["s_svg"] == "string" and dict(out.dtypes)["gone"] == "string"
    rows = out.collect()
    assert [r.s_eng for r in rows] == ["E", None, None]
    assert all(r.s_svg is None and r.gone is None for r in rows)
    assert [r.m_eng for r in rows] == ["E", None, None]
    assert [r.hs for r in rows] == [True, False, False]
    assert [r.hs_absent for r in rows] == [False, False, False]
    assert [r.hm for r in rows] == [True, False, False]
    assert [r.hgone for r in rows] == [False, False, False]
