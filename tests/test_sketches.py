"""Mergeable column sketches against exact figures, within the stated bounds."""

import pytest
from pyspark.sql import functions as F

from tablezones.operators import describe_sketches, merge_sketches, sketch_columns
from tablezones.operators.sketches import FREQUENT_ERROR, RANK_ERROR, distinct_error

N = 60_000


@pytest.fixture(scope="module")
def table(spark):
    # One value holds a third of all rows, the others fall off slowly; NULLs and NaNs occur.
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.pow(F.rand(5), 3) * 20_000).cast("int") + 100)
    df = spark.range(N, numPartitions=6).select("id", hot.alias("a.b"), F.rand(3).alias("x"))
    return df.withColumn("x", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, F.lit(float("nan"))).otherwise(F.col("x"))).cache()


def described(sketches, **kw):
    return {r.column_name: r for r in describe_sketches(sketches, **kw).collect()}


def check(table, got):
    values = [r[0] for r in table.select("`a.b`").collect()]
    exact = {v: values.count(v) for v in set(values)}
    d = got["a.b"]
    assert (d.n_rows, d.n_nulls) == (N, 0)
    assert abs(d.n_distinct - len(exact)) <= 4 * distinct_error() * len(exact)
    for q, v in zip((0.25, 0.5, 0.75), d.quantiles):
        assert sum(x < v for x in values) <= (q + 3 * RANK_ERROR) * N and sum(x <= v for x in values) >= (q - 3 * RANK_ERROR) * N
    given = {r["item"]: r["count"] for r in d.top}
    assert {str(v) for v, k in exact.items() if k > FREQUENT_ERROR * N} <= set(given)
    assert all(abs(exact[int(v)] - k) <= FREQUENT_ERROR * N for v, k in given.items())
    assert got["x"].n_nulls == N // 10
    assert abs(got["x"].quantiles[1] - 0.5) < 0.03  # NaNs have no rank


def test_one_pass_is_within_bounds(table):
    sketches = sketch_columns(table)
    check(table, described(sketches, top=500))
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan


@pytest.mark.parametrize("parts", [2, 7])
def test_merged_parts_are_within_the_same_bounds(spark, table, parts, tmp_path):
    for i in range(parts):
        sketch_columns(table.where(F.col("id") % parts == i)).write.mode("append").parquet(str(tmp_path))
    kept = spark.read.parquet(str(tmp_path))
    check(table, described(merge_sketches(kept), top=500))
    frames = [sketch_columns(table.where(F.col("id") % parts == i)) for i in reversed(range(parts))]
    check(table, described(merge_sketches(*frames), top=500))


def test_empty_null_and_nested_columns(spark):
    df = spark.sql("SELECT cast(null AS double) AS n, array(1, 2) AS l, named_struct('f', 'v') AS s, true AS b, date'2020-01-01' AS d, cast(2.5 AS decimal(5, 1)) AS p")
    for rows in (0, 1):
        part = sketch_columns(df.limit(rows))
        for sketches in (part, merge_sketches(part, sketch_columns(df.limit(0)))):
            got = described(sketches)
            assert set(got) == set(df.columns)
            assert all(r.n_rows == rows for r in got.values())
            assert got["n"].n_distinct == 0 and got["n"].quantiles is None and got["n"].top == []
            assert got["l"].n_distinct == rows and got["l"].quantiles is None
            assert got["p"].quantiles == ([2.5] * 3 if rows else None)
    assert [tuple(x) for x in got["l"].top] == [("[1,2]", 1)] and got["s"].top[0]["item"] == '{"f":"v"}'
