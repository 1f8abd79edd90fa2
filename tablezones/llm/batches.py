"""Text columns of Arrow batches as flat byte arrays, in pieces of bounded size."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once. One longer text makes a piece of its own. The byte arithmetic on a piece takes up to 60
#: times its bytes in each worker.
PIECE_BYTES = 512 << 10


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of ``batch`` with the UTF-8 bytes of ``column`` and its row offsets.

    A null text counts as empty. No text is ever cut."""
    drop_unused()
    i = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        rows = batch.slice(at, to - at)
        texts = pc.fill_null(rows.column(i).cast(pa.large_string()), "")  # of this slice only
        own = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(rows) + 1]
        data = texts.buffers()[2]
        text = np.frombuffer(data, np.uint8)[own[0] : own[-1]] if data is not None else np.zeros(0, np.uint8)
        yield rows.set_column(i, column, texts), text, own - own[0]
        at = to
    give_back()


def give_back() -> None:
    """Hand memory that earlier batches took and freed to the system: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)


def worker_state() -> dict:
    """What a Python worker keeps from task to task (caches only: results never depend on it)."""
    import types

    return sys.modules.setdefault("_tablezones_llm_worker", types.ModuleType("_tablezones_llm_worker")).__dict__


def _task() -> int | None:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.taskAttemptId() if context else None


def worker_cache(name: str) -> dict:
    """A large part of ``worker_state`` by its name: it stays while this worker's tasks ask for it."""
    caches = worker_state().setdefault("caches", {})
    kept = caches.setdefault(name, {"cache": {}})
    kept["task"] = _task()
    return kept["cache"]


def drop_unused() -> None:
    """Drop the caches that the running task has not asked for: an earlier operator's only take room from this one's."""
    caches, task = worker_state().get("caches", {}), _task()
    for name in [k for k, kept in caches.items() if kept["task"] != task]:
        del caches[name]
