"""Duplicate keys of large tables: a screen of hashes first, then an exact count of the few keys that passed it.

``checks.duplicate_keys`` shuffles each different key of each task whole. Here a task sends four bytes for each different
key, its place in one of 65536 ranges of a 48-bit hash, sorted; a range's places that come twice name the keys that may
repeat. Only rows of these go into the exact count. Keys that share a hash by chance pass the screen and are left out by
the count, so the result is the same.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.operators.checks import duplicate_keys
from bankmetrics.sinks.work import kept, work_folder

# The functions below travel to the executors by value, so a cluster needs no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hashes are 48 bits: 16 name the range, the others the place in it.
PLACES = 1 << 32
#: Hashes that a task holds before it sends them.
HELD = 1 << 22


def key_mark(*keys: str) -> Column:
    """The 48-bit hash of a key."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 16)


def _sent(marks: np.ndarray) -> pa.RecordBatch:
    """One row for each range and for whether its places came once or more: part, again, places."""
    different, counts = np.unique(marks, return_counts=True)
    parts, again = different // PLACES, counts > 1
    rows = []
    for which in (False, True):
        own, part = (different[again == which] % PLACES).astype("<u4"), parts[again == which]
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(starts, [*starts[1:], len(part)]):
            rows.append((int(part[a]), which, own[a:b].tobytes()))
    columns = list(zip(*rows)) or [[]] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary())], ["part", "again", "places"]
    )


def repeated_marks(df: DataFrame, *keys: str) -> DataFrame:
    """``mark`` of every key that occurs more than once, and of few others."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= HELD:
                yield _sent(np.concatenate(held))
                held, size = [], 0
        if size:
            yield _sent(np.concatenate(held))

    def met(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        places = {False: [np.zeros(0, "<u4")], True: [np.zeros(0, "<u4")]}
        for again, sent in zip(table.column("again").to_pylist(), table.column("places").to_pylist()):
            places[again].append(np.frombuffer(sent, "<u4"))
        different, counts = np.unique(np.concatenate(places[False]), return_counts=True)
        # A place that a task sent as repeated is one, and so is one that came once here and there.
        found = np.union1d(different[counts > 1], np.concatenate(places[True]))
        return pa.table({"mark": pa.array(found.astype(np.int64) + part * PLACES)})

    sent = df.select(key_mark(*keys).alias("mark")).mapInArrow(send, "part int, again boolean, places binary")
    return sent.groupBy("part").applyInArrow(met, "mark long")


def screened_duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of ``checks.duplicate_keys``: key combinations that occur more than once, with their count.

    A key of a third of all rows is one place for each task. The marks are kept in the shared folder, so that their size
    is known when they meet the keys: Spark broadcasts them while they are under its threshold. The table is read twice.
    NULL is a value like others, as in a group.
    """
    spark = df.sparkSession
    marks = kept(repeated_marks(df, *keys), work_folder(spark, "keys"), "repeated")
    few = df.select(*keys, key_mark(*keys).alias("_mark")).join(marks, F.col("_mark") == marks["mark"], "left_semi")
    return duplicate_keys(few, *keys)
