"""The result of a write: target, whether anything was written, observed metrics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class WriteReport:
    """What one write did. ``metrics`` come from an ``Observation`` collected
    during the write itself, so reporting costs no extra pass."""

    target: str
    written: bool
    metrics: dict = field(default_factory=dict)
    schema: StructType | None = None  # of the written rows, so that the next stage need not infer it

    @property
    def rows(self) -> int:
        return int(self.metrics.get("rows", 0))
