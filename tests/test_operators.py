import pytest
from pyspark.sql import functions as F

from tablezones.errors import MissingColumnError, RenameCollisionError
from tablezones.operators import (
    complex_columns,
    extract_variants,
    flatten_complex,
    join_attach_key,
    map_sum,
    preview,
    profile_columns,
    rename_columns,
    row_count,
    select_present,
    with_columns,
)

NESTED = (
    "id long, s struct<a:string,b:int>, arr array<int>, m map<string,string>, "
    "tr struct<deu:struct<common:string>,eng:struct<common:string>>, txt string"
)


@pytest.fixture()
def nested(spark):
    rows = [
        (1, {"a": "x", "b": 1}, [1, None], {"k": "v"}, {"deu": {"common": "D"}, "eng": {"common": "E"}}, "Việt"),
        (2, None, None, None, None, None),
        (3, {"a": None, "b": None}, [], {}, {"deu": None, "eng": {"common": None}}, ""),
    ]
    return spark.createDataFrame(rows, NESTED)


def test_select_present(spark, nested):
    out = select_present(nested, ["txt", "nope", "id"])
    assert out.columns == ["txt", "id"]
    with pytest.raises(MissingColumnError):
        select_present(nested, ["nope"], strict=True)


def test_with_columns_replaces_in_place(spark, nested):
    out = with_columns(nested, {"txt": F.upper("txt"), "extra": F.lit(1)})
    assert out.columns == nested.columns + ["extra"]
    assert out.filter("id = 1").first().txt == "VIỆT"


def test_rename(spark, nested):
    out = rename_columns(nested, {"txt": "Text", "missing": "x"})
    assert out.columns[-1] == "Text"
    with pytest.raises(MissingColumnError):
        rename_columns(nested, {"missing": "x"}, strict=True)
    with pytest.raises(RenameCollisionError):
        rename_columns(nested, {"txt": "ID"})


def test_flatten_complex_leaves_no_complex_type(spark, nested):
    withvar = nested.withColumn("v", F.parse_json(F.lit('{"z":1}')))
    out = flatten_complex(withvar)
    assert complex_columns(out) == []
    assert out.columns == withvar.columns
    assert out.count() == nested.count()
    r = {row.id: row for row in out.collect()}
    assert r[1].s == '{"a":"x","b":1}' and r[1].arr == "[1,null]" and r[1].m == '{"k":"v"}' and r[1].v == '{"z":1}'
    assert r[2].s is None and r[2].arr is None
    assert r[3].s == "{}" and r[3].arr == "[]" and r[3].m == "{}"


def test_flatten_selected_columns_only(spark, nested):
    out = flatten_complex(nested, ["arr"])
    assert complex_columns(out) == ["s", "m", "tr"]


def test_extract_variants_struct_only_present_keys(spark, nested):
    out = extract_variants(nested, "tr", ["eng", "fra", "deu"], prefix="translation_")
    assert out.columns == nested.columns + ["translation_eng", "translation_deu"]
    r = {row.id: row for row in out.collect()}
    assert r[1].translation_eng == '{"common":"E"}' and r[1].translation_deu == '{"common":"D"}'
    assert r[1].tr == '{"deu":{"common":"D"},"eng":{"common":"E"}}'
    assert r[3].translation_deu is None and r[3].translation_eng == "{}"


def test_extract_variants_map_emits_all_keys(spark):
    df = spark.createDataFrame([({"eng": "E"},), (None,)], "m map<string,string>")
    out = extract_variants(df, "m", ["eng", "fra"], prefix="m_")
    assert out.columns == ["m", "m_eng", "m_fra"]
    rows = out.collect()
    assert (rows[0].m_eng, rows[0].m_fra, rows[0].m) == ("E", None, '{"eng":"E"}')
    assert (rows[1].m_eng, rows[1].m) == (None, None)


def test_join_attach_key_no_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, name1 string")
    keys = spark.createDataFrame([("a", "K1"), ("a", "K1"), ("b", "K2"), (None, "KN")], "name1 string, key string")
    out = join_attach_key(left, keys, "name1", ["key"])
    got = sorted((r.id, r.key) for r in out.collect())
    assert got == [(1, "K1"), (2, "K2"), (3, None), (4, "K1")]


def test_counts_and_preview(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("v", F.col("id") % 10)
    assert row_count(df).first().n_rows == 1000
    assert map_sum(df, F.col("v") * 2).first().total == 9000
    assert [r.id for r in preview(df, [F.col("id").desc()], 3).collect()] == [999, 998, 997]


def test_profile_columns(spark, nested):
    rows = {r.column_name: r for r in profile_columns(nested).collect()}
    assert set(rows) == set(nested.columns)
    assert rows["s"].is_complex and not rows["txt"].is_complex
    assert rows["s"].n_rows == 3 and rows["s"].n_nulls == 1 and rows["id"].n_nulls == 0


def test_profile_is_one_aggregation(spark, nested):
    plan = profile_columns(nested)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # partial + final, one pass


def test_extract_variants_default_prefix_and_existing_column(spark):
    df = spark.createDataFrame([({"eng": "E"}, "old")], "class struct<eng:string>, class_eng string")
    out = extract_variants(df, "class", ["eng"])
    assert out.columns == ["class", "class_eng"]  # replaced in place, not duplicated
    r = out.first()
    assert (r["class"], r["class_eng"]) == ('{"eng":"E"}', "E")


def test_join_attach_key_hot_key_is_split_not_dropped(spark):
    """One key holds a third of the rows: AQE splits its partition; every row survives once."""
    from pyspark.sql import functions as F

    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    saved = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        n = 30_000
        left = spark.range(n, numPartitions=8).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("name1")
        )
        keys = left.select("name1").withColumn("key", F.concat(F.lit("k-"), F.col("name1")))
        out = join_attach_key(left, keys, "name1", ["key"]).select("id", "key")
        rows = out.collect()
        assert len(rows) == n and len({r.id for r in rows}) == n
        assert sum(r.key == "k-hot" for r in rows) == n // 3
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan or "isSkewJoin=true" in plan, plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_profile_with_types(spark, nested):
    rows = {r.column_name: r for r in profile_columns(nested, ["s", "txt"], with_types=True).collect()}
    assert rows["s"].data_type == "struct<a:string,b:int>" and rows["txt"].data_type == "string"


def test_cast_columns_safe(spark):
    from tablezones.operators import cast_columns

    df = spark.createDataFrame([("1.5",), ("x",)], "v string")
    assert [r.v for r in cast_columns(df, {"v": "double"}, safe=True).collect()] == [1.5, None]


def test_dirty_latlng_text_gives_null_not_failure(spark):
    from tablezones.plans import transform_countries

    df = spark.createDataFrame([(["16.0", "north"],)], "latlng array<string>")
    r = transform_countries(df).first()
    assert (r.lat, r.lng, r.latlng) == (16.0, None, '["16.0","north"]')


def test_rename_swap_is_simultaneous(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    out = rename_columns(df, {"a": "b", "b": "a"})
    assert out.dtypes == [("b", "int"), ("a", "string")]
    assert tuple(out.first()) == (1, "x")


def test_join_attach_key_picks_the_same_key_in_any_order(spark):
    rows = [("a", f"k{i}", i) for i in range(8)] + [(None, "n", 0), ("b", "x", 1)]
    left = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "name string")
    results = []
    for order in (rows, rows[::-1]):
        keys = spark.createDataFrame(order, "name string, k string, v int").repartition(3)
        results.append(sorted(map(tuple, join_attach_key(left, keys, "name", ["k", "v"]).collect()), key=str))
    assert results[0] == results[1] == sorted([("a", "k0", 0), ("b", "x", 1), (None, None, None), ("c", None, None)], key=str)
