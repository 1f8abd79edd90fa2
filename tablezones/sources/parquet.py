"""Parquet source: vectorised scan with filter pushdown and (nested) column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablezones.sources._paths import resolving


def read_parquet(spark: SparkSession, path, options: dict | None = None, schema: StructType | str | None = None) -> DataFrame:
    """Read Parquet; a missing path raises :class:`MissingInputError`. A known
    ``schema`` skips the footer-reading job that schema inference runs."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return resolving(path, lambda: reader.parquet(path))
