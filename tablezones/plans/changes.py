"""What changed between two versions of a zone, by row digests, and a history of it.

Rows are matched by key columns; a NULL key is a key like any other. Each
version is reduced to keys and digests, and both are summed up in one
aggregation: one shuffle of (key, counts, digest sums), combined in each task
first, so a key that holds a third of all rows is no hot spot and no payload
column is ever shuffled. Rows of a repeated key are compared as a bag, in any
order.

A digest is two 64-bit hashes of all columns but the keys, matched by name. A
column that only one version has counts as NULL in the other. A column whose
type differs is compared by its text. Nested columns are compared by their JSON
text; the order of a map's entries counts only inside other nested values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType

from tablezones.errors import MissingColumnError
from tablezones.functions.fields import column, lookup_type
from tablezones.functions.json import is_complex, json_text
from tablezones.sinks.parquet import write_parquet
from tablezones.sinks.report import WriteReport

#: What happened to a key.
INSERTED, CHANGED, DELETED = CHANGES = ("inserted", "changed", "deleted")
_SEEDS = (17, 29)


def _comparable(df: DataFrame, name: str, as_text: bool) -> list[Column]:
    """A column's value for hashing, and whether it is NULL (a hash passes NULLs over)."""
    dtype = lookup_type(df, name)
    if dtype is None:
        return [F.lit(None).cast("string"), F.lit(True)]
    value = column(name)
    absent = value.isNull()
    if isinstance(dtype, MapType) and _ordered(dtype.keyType) and _ordered(dtype.valueType):
        value = F.to_json(F.array_sort(F.map_entries(value)))
    elif is_complex(dtype):
        value = json_text(value, dtype)
    elif as_text:
        value = value.cast("string")
    return [value, absent]


def _ordered(dtype: DataType) -> bool:
    """Whether values of the type can be sorted."""
    return "map<" not in dtype.simpleString() and "variant" not in dtype.simpleString()


def row_digests(df: DataFrame, names: Sequence[str], as_text: Sequence[str] = ()) -> list[Column]:
    """Two independent 64-bit hashes of the columns ``names``, in that order."""
    values = [c for n in names for c in _comparable(df, n, n in as_text)]
    return [F.xxhash64(F.lit(seed), *values) for seed in _SEEDS]


def zone_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each key whose rows differ: ``keys``, ``change`` (inserted, changed or deleted), ``n_old``, ``n_new``.

    Empty versions are versions like others. A key column that one version lacks, or has with another type, is an error."""
    for k in keys:
        if lookup_type(old, k) is None or lookup_type(old, k) != lookup_type(new, k):
            raise MissingColumnError(f"key column {k!r} is missing or differs in type between the versions")
    names = sorted({*old.columns, *new.columns} - set(keys))
    retyped = [n for n in names if None not in (lookup_type(old, n), lookup_type(new, n)) and lookup_type(old, n) != lookup_type(new, n)]
    # Positions instead of names inside, so no column can clash with a key.
    key_at = [f"k{i}" for i in range(len(keys))]

    def reduced(df: DataFrame, is_new: bool) -> DataFrame:
        digests = [d.alias(f"d{i}") for i, d in enumerate(row_digests(df, names, retyped))]
        return df.select(*[column(k).alias(a) for k, a in zip(keys, key_at)], *digests, F.lit(is_new).alias("is_new"))

    # Exact sums, so equal bags of rows agree whatever their order and split.
    total = lambda d, side: F.coalesce(F.sum(F.when(side, F.col(d).cast("decimal(20,0)"))), F.lit(0))
    is_new = F.col("is_new")
    both = reduced(old, False).unionAll(reduced(new, True)).groupBy(*key_at).agg(
        F.count_if(~is_new).alias("n_old"),
        F.count_if(is_new).alias("n_new"),
        *[(total(f"d{i}", ~is_new) == total(f"d{i}", is_new)).alias(f"same{i}") for i in range(len(_SEEDS))],
    )
    differs = (F.col("n_old") != F.col("n_new")) | ~F.col("same0") | ~F.col("same1")
    change = F.when(F.col("n_old") == 0, INSERTED).when(F.col("n_new") == 0, DELETED).otherwise(CHANGED)
    kept = [F.col(a).alias(k) for k, a in zip(keys, key_at)]
    return both.where(differs).select(*kept, change.alias("change"), "n_old", "n_new")


def _matching(df: DataFrame, changes: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``df`` semi- or anti-joined with the keys of ``changes``, NULL keys included."""
    at = [f"__change_key_{i}" for i in range(len(keys))]
    touched = changes.select(*[column(k).alias(a) for k, a in zip(keys, at)])
    same = [column(k).eqNullSafe(F.col(a)) for k, a in zip(keys, at)]
    return df.join(touched, on=same, how=how)


def changed_rows(new: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the ``new`` version whose keys were inserted or changed."""
    return _matching(new, changes.where(F.col("change") != DELETED), keys, "left_semi")


def apply_changes(old: DataFrame, changes: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new version, from the ``old`` one, its ``changes`` and the ``changed_rows``.

    Columns follow ``rows``; one that the old version lacks is NULL in its rows."""
    untouched = _matching(old, changes, keys, "left_anti")
    shaped = [(column(f.name) if lookup_type(old, f.name) is not None else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return untouched.select(*shaped).unionAll(rows)


def record_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], history: str, version: int) -> WriteReport:
    """Write the changes of ``version`` to ``<history>/version=<version>``; reports rows and the count of each kind.

    A rerun of a version replaces that version alone, when it is complete; a
    failing one leaves it. ``read_parquet(spark, history)`` gives all versions
    with a ``version`` column. A version without changes is an empty folder of
    the same columns."""
    kinds = [F.count_if(F.col("change") == kind).alias(kind) for kind in CHANGES]
    target = f"{history.rstrip('/')}/version={version:d}"
    return write_parquet(zone_changes(old, new, keys), target, extra_metrics=kinds)
