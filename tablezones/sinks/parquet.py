"""Parquet sink: a folder is replaced as a whole, its rows counted in the same pass."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tablezones.sinks.guards import refuse_self_overwrite, replace_folder
from tablezones.sinks.report import WriteReport


def observed(df: DataFrame, name: str, extra: Sequence[Column] = ()) -> tuple[DataFrame, Observation]:
    """Attach a row count (plus ``extra`` aggregates) that is computed by the
    next action on the returned frame, without a separate job."""
    # Unique per call: two observations of one name in a plan are an error.
    obs = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra), obs


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    require_rows: bool = False,
    extra_metrics: Sequence[Column] = (),
    options: dict | None = None,
    inputs: Sequence[str] = (),
    accept=None,
) -> WriteReport:
    """Write ``df`` as Parquet in one pass.

    Overwrite writes a fresh sibling folder and swaps it in when complete (see
    ``guards``), so a failing job leaves the old data. ``require_rows`` keeps
    the old target when the write turns out to have no rows; ``accept`` may
    inspect the observed metrics and raise to keep it. ``inputs`` are root
    paths that must not be taken away by the swap."""
    frame, obs = observed(df, "parquet_write", extra_metrics)
    writer = frame.write.options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode != "overwrite":
        writer.mode(mode).parquet(path)
        return WriteReport(path, True, dict(obs.get), df.schema)
    refuse_self_overwrite(df.sparkSession, path, inputs)

    def write(folder: str) -> bool:
        writer.parquet(folder)
        if accept is not None:
            accept(dict(obs.get))
        return not require_rows or int(obs.get["rows"]) > 0

    written = replace_folder(df.sparkSession, path, write)
    return WriteReport(path, written, dict(obs.get), df.schema)
