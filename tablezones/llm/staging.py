"""Staged tables and files under the cluster's shared folder.

A staged table is written once and read back: it cuts the lineage, survives the
loss of any executor and gives the planner a known size. The folder is the one
named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablezones.session import scratch_path

#: A side is broadcast only when its counted rows stay under this; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


#: Bytes after which a batch goes to the Python steps of a staged table, on both sides of the pipe; rows are never cut.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs run inside hand batches of ``most`` bytes to Python; a smaller setting of the session stays.

    Spark reads the setting when a job starts, so it goes back to what it was."""
    before = spark.conf.get(_BATCH_SETTING)
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmg]?)i?b?", before.strip().lower()).groups()
    own = int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]
    if 0 < own <= most:
        yield
        return
    spark.conf.set(_BATCH_SETTING, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in a fresh shared folder and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> DataFrame:
    """A staged narrow key table, marked for broadcast when its row count is proven small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def shared_file_folder(spark: SparkSession, label: str) -> str:
    """A fresh shared folder as a plain path that every task can open.

    Flat files are memory-mapped, so the shared folder has to be mounted on the
    executors (``file:`` or no scheme)."""
    path = re.sub(r"^file:/*", "/", scratch_path(spark, label))
    if re.match(r"[a-z0-9]+:/", path):
        raise ValueError(f"{path}: flat files need a shared folder that executors mount")
    return path


def commit_file(tmp: str, final: str) -> None:
    """Publish a finished file in one step; a repeated task attempt writes the same bytes."""
    os.replace(tmp, final)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
