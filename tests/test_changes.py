"""Differences between two versions of a zone, and their history."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablezones.errors import MissingColumnError
from tablezones.plans import apply_changes, changed_rows, record_changes, zone_changes
from tablezones.sources import read_parquet

COLUMNS = "k int, a string, b string"


def changes(old, new, keys=("k",)):
    return {r[0]: tuple(r[1:]) for r in zone_changes(old, new, list(keys)).collect()}


def test_kinds_null_keys_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "x", "y"), (2, "x", "y"), (3, "x", None), (None, "n", "n"), (5, "p", "q"), (5, "r", "s"), (6, "t", "t")], COLUMNS)
    new = spark.createDataFrame([(1, "x", "y"), (3, None, "x"), (4, "x", "y"), (None, "n", "m"), (5, "r", "s"), (5, "p", "q"), (6, "t", "t"), (6, "t", "t")], COLUMNS)
    assert changes(old, new) == {2: ("deleted", 1, 0), 3: ("changed", 1, 1), 4: ("inserted", 0, 1), None: ("changed", 1, 1), 6: ("changed", 1, 2)}


def test_a_value_that_moves_between_columns_and_rows_counts(spark):
    old = spark.createDataFrame([(1, "x", None), (2, "a", "b"), (2, "c", "d")], COLUMNS)
    new = spark.createDataFrame([(1, None, "x"), (2, "a", "d"), (2, "c", "b")], COLUMNS)
    assert set(changes(old, new)) == {1, 2}


def test_added_dropped_and_retyped_columns(spark):
    old = spark.createDataFrame([(1, "x", "7"), (2, "x", "8")], "k int, gone string, b string")
    same = spark.createDataFrame([(7, 1, None), (9, 2, None)], "b int, k int, fresh string")
    assert changes(old.withColumn("gone", F.lit(None).cast("string")), same) == {2: ("changed", 1, 1)}
    assert set(changes(old, same)) == {1, 2}
    with pytest.raises(MissingColumnError):
        zone_changes(old, same.drop("k"), ["k"])
    with pytest.raises(MissingColumnError):
        zone_changes(old, same.withColumn("k", F.col("k").cast("string")), ["k"])


def test_nested_columns_and_clashing_names(spark):
    rows = "SELECT 1 AS k0, {} AS m, named_struct('f', array(1, {})) AS is_new, 1 AS d0, 'v' AS `n.old`"
    old = spark.sql(rows.format("map('a', 1, 'b', 2)", 2))
    assert changes(old, spark.sql(rows.format("map('b', 2, 'a', 1)", 2)), ["k0"]) == {}
    assert changes(old, spark.sql(rows.format("map('a', 1, 'b', 3)", 2)), ["k0"]) == {1: ("changed", 1, 1)}
    assert changes(old, spark.sql(rows.format("map('a', 1, 'b', 2)", 3)), ["k0"]) == {1: ("changed", 1, 1)}
    assert zone_changes(old, old, ["k0", "n.old"]).columns == ["k0", "n.old", "change", "n_old", "n_new"]


def test_empty_versions(spark):
    some = spark.createDataFrame([(1, "x", "y")], COLUMNS)
    assert changes(some, some.limit(0)) == {1: ("deleted", 1, 0)}
    assert changes(some.limit(0), some) == {1: ("inserted", 0, 1)}
    assert changes(some.limit(0), some.limit(0)) == {}


ROWS = st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "", "x"]), st.sampled_from([None, "x", "y"])), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS)
def test_old_version_and_changes_give_the_new_one(spark, before, after):
    old, new = spark.createDataFrame(before, COLUMNS), spark.createDataFrame(after, COLUMNS)
    found = zone_changes(old, new, ["k"])
    bags = [{k: Counter(r for r in rows if r[0] == k) for k in {r[0] for r in rows}} for rows in (before, after)]
    assert {r.k for r in found.collect()} == {k for k in {*bags[0], *bags[1]} if bags[0].get(k) != bags[1].get(k)}
    rebuilt = apply_changes(old, found, changed_rows(new, found, ["k"]), ["k"])
    assert Counter(map(tuple, rebuilt.collect())) == Counter(after)


def test_history_keeps_versions_and_reruns_replace_their_own(spark, tmp_path):
    history = str(tmp_path / "history")
    versions = [spark.createDataFrame(rows, COLUMNS) for rows in ([(1, "a", "a"), (2, "b", "b")], [(1, "a", "a"), (2, "b", "c")], [(2, "b", "c"), (3, "n", "n")])]
    first = record_changes(versions[0], versions[1], ["k"], history, 1)
    assert {k: first.metrics[k] for k in ("rows", "inserted", "changed", "deleted")} == {"rows": 1, "inserted": 0, "changed": 1, "deleted": 0}
    for _ in range(2):  # a rerun adds nothing
        record_changes(versions[1], versions[2], ["k"], history, 2)
    record_changes(versions[2], versions[2], ["k"], history, 3)  # nothing changed
    got = {(r.version, r.k, r.change) for r in read_parquet(spark, history).collect()}
    assert got == {(1, 2, "changed"), (2, 1, "deleted"), (2, 3, "inserted")}


def test_only_keys_and_digests_are_shuffled(spark):
    old = spark.range(100).selectExpr("id AS k", "repeat('x', 100) AS payload")
    plan = zone_changes(old, old, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    (line,) = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert "payload" not in line
