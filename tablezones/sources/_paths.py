"""Path checks done by Spark (against ``fs.defaultFS``), never ``os.path``."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import AnalysisException

from tablezones.errors import MissingInputError

T = TypeVar("T")


def error_condition(exc: Exception) -> str:
    """Spark's error condition name of ``exc`` (e.g. PATH_NOT_FOUND), or ''."""
    for getter in ("getCondition", "getErrorClass"):
        fn = getattr(exc, getter, None)
        if fn is not None:
            try:
                value = fn()
            except Exception:  # noqa: BLE001 - older servers may lack the method
                value = None
            if value:
                return value
    return ""


def resolving(path, action: Callable[[], T]) -> T:
    """Run a read; a missing path becomes :class:`MissingInputError`."""
    try:
        return action()
    except AnalysisException as exc:
        if error_condition(exc) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(exc):
            raise MissingInputError(f"input path does not exist: {path}") from exc
        raise
