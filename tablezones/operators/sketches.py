"""Column distributions as mergeable sketches: distinct counts, quantiles and frequent values.

``sketch_columns`` takes one pass and one partial aggregation; its result has one
small row a column, whatever the size of the table. Kept beside each zone (a
day, a feed), such rows merge into those of all zones without a new pass:
``merge_sketches``. ``describe_sketches`` turns them into numbers.

Bounds of error, for all sizes of input and any split or order of merging:

- ``n_distinct``: standard error ``distinct_error()`` of the count.
- ``quantiles``: the rank of a value given for rank q is within ``RANK_ERROR`` of q
  (99 % confidence).
- ``top``: with ``TRACKED`` values, every value of more than ``FREQUENT_ERROR`` of the
  non-NULL rows is found, and no count is further off than that share of them.

NULLs are counted and belong to no distribution; neither do NaNs to quantiles.
Quantiles are for numeric columns; other columns have none. Nested columns are
sketched by their JSON text. A column without values has 0 distinct ones, no
quantiles and no frequent values.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, NumericType

from tablezones.functions.fields import column, lookup_type
from tablezones.functions.json import json_text

#: Logarithm of the registers of a distinct-count sketch.
LG_REGISTERS = 12
#: Size parameter of a quantile sketch, and the rank error that goes with it.
QUANTILE_K, RANK_ERROR = 800, 0.0035
#: Values that a frequency sketch tracks, and the share of the rows below which it may miss one.
TRACKED, FREQUENT_ERROR = 1000, 0.0035


def distinct_error(lg_registers: int = LG_REGISTERS) -> float:
    """Relative standard error of the distinct count."""
    return 1.04 / math.sqrt(1 << lg_registers)


def _countable(df: DataFrame, name: str, dtype: DataType) -> Column:
    """A column in a type that sketches tell values apart by."""
    if isinstance(dtype, IntegralType):
        return column(name).cast("long")
    return json_text(column(name), dtype).cast("string")


def _measurable(name: str, dtype: DataType) -> Column:
    if not isinstance(dtype, NumericType):
        return F.lit(None).cast("double")
    value = column(name).cast("double")
    return F.when(~F.isnan(value), value) if isinstance(dtype, (DoubleType, FloatType)) else value


def _frequent(value: str, tracked: int) -> Column:
    return F.expr(f"approx_top_k_accumulate({value}, {tracked:d})")


def sketch_columns(df: DataFrame, columns: Iterable[str] | None = None, lg_registers: int = LG_REGISTERS, tracked: int = TRACKED) -> DataFrame:
    """One row per column: column_name, n_rows, n_nulls and the sketches ``distinct``, ``ranks`` and ``frequent``."""
    names = list(df.columns if columns is None else columns)
    # By position, so that no name can clash or need quoting.
    inputs, aggs = [], [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(names):
        dtype = lookup_type(df, name)
        countable = _countable(df, name, dtype)
        inputs += [countable.alias(f"c{i}"), countable.cast("string").alias(f"t{i}"), _measurable(name, dtype).alias(f"m{i}")]
        aggs += [
            F.count_if(F.col(f"c{i}").isNull()).alias(f"nulls{i}"),
            F.hll_sketch_agg(f"c{i}", lg_registers).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(f"m{i}", QUANTILE_K).alias(f"ranks{i}"),
            _frequent(f"t{i}", tracked).alias(f"frequent{i}"),
        ]
    stats = df.select(*inputs).agg(*aggs)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("n_rows"),
            *[F.col(f"{part}{i}").alias(out) for part, out in (("nulls", "n_nulls"), ("distinct", "distinct"), ("ranks", "ranks"), ("frequent", "frequent"))],
        )
        for i, name in enumerate(names)
    ]
    return stats.select(F.inline(F.array(*rows)))


def merge_sketches(first: DataFrame, *others: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """The sketches of all the tables' rows together, from those of each table."""
    return reduce(DataFrame.unionByName, others, first).groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("ranks", QUANTILE_K).alias("ranks"),
        F.expr(f"approx_top_k_combine(frequent, {tracked:d})").alias("frequent"),
    )


def describe_sketches(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), top: int = 10) -> DataFrame:
    """column_name, n_rows, n_nulls, n_distinct, quantiles (array, NULL without numbers) and top (array of item and count)."""
    ranks = F.array(*[F.lit(float(q)) for q in quantiles])
    measured = F.when(F.kll_sketch_get_n_double("ranks") > 0, F.kll_sketch_get_quantile_double("ranks", ranks))
    return sketches.select(
        "column_name",
        "n_rows",
        "n_nulls",
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        measured.alias("quantiles"),
        F.filter(F.expr(f"approx_top_k_estimate(frequent, {top:d})"), lambda x: x["item"].isNotNull()).alias("top"),
    )
