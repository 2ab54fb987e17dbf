"""Helpers shared by the operators: the shared work folder, tables kept there, and slices of Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from bankmetrics.sinks.work import kept, removed, work_folder  # noqa: F401

#: Bytes of text that a task holds at once, besides one whole text.
SLICE_BYTES = 2 << 20


def forget(spark: SparkSession, folder: str, name: str) -> None:
    """Removes a table of the work folder that no later step reads."""
    removed(spark, f"{folder}/{name}")


def held_by_worker(key: tuple, make):
    """make(), or what an earlier task of this Python worker made for the same key.

    A worker holds one such thing at a time: what another operator left in it goes first.
    """
    held = sys.modules.setdefault("_bankmetrics_worker", types.ModuleType("_bankmetrics_worker")).__dict__
    if held.get("key") != key:
        held["thing"] = None
        give_back()
        held["thing"], held["key"] = make(), key
    return held["thing"]


def give_back() -> None:
    """Returns freed memory of this Python worker to the system: it stays for tasks of other operators."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def give_back_at_once() -> None:
    """From now on this Python worker returns arrays of over a MB to the system when they are freed, not later."""
    import ctypes

    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt:
        mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    pa.set_memory_pool(pa.system_memory_pool())


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each has at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // most
        starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)
        del batch
        give_back()


def flat_binary(payload: bytes | memoryview, bounds: np.ndarray) -> pa.Array:
    """Binary values payload[bounds[i]:bounds[i + 1]], without a copy per value."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(payload)]
    ).cast(pa.binary())
