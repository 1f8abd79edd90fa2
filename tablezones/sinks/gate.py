"""Non-empty gate: an empty result must not replace a good target."""

from __future__ import annotations

from pyspark.sql import DataFrame


def has_rows(df: DataFrame) -> bool:
    """True when ``df`` has at least one row. Stops at the first row found, so a
    scan-and-project plan reads one split, not the whole input."""
    return not df.isEmpty()
