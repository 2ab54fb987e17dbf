"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of their key. A Feistel network over pairs (left, right) of two radixes, whose
product is the number of rows or a little more, permutes the numbers; a number that lands beyond the last row is permuted
again until it lands on one (cycle walking), so the rows are permuted among themselves. The place p of a row gives its
shard, p modulo the number of shards, and its slot in it, p divided by that number: shards differ by one row at most, and
slots have no gap. Number and place follow from each other by arithmetic alone, without a look at any table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.llm.common import kept, work_folder

ROUNDS = 8

#: Rows of a file of a shard: a task of write() sorts and writes this many.
FILE_ROWS = 1 << 17

#: monotonically_increasing_id() has the partition above this bit and the row's number in it below.
ROW_BITS = 33


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Permutation:
    """A permutation of 0 to rows - 1 that depends on ``rows`` and ``seed`` alone."""

    def __init__(self, rows: int, seed: int = 0):
        self.rows = rows
        self.high = math.isqrt(max(rows - 1, 0)) + 1
        self.low = max(-(-rows // self.high), 1)
        digests = (hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(ROUNDS))
        self.keys = [np.uint64(int.from_bytes(d[:8], "little")) for d in digests]

    def _round(self, i: int, side: np.ndarray, radix: int) -> np.ndarray:
        return _mixed(side + self.keys[i]) % np.uint64(radix)

    def _once(self, number: np.ndarray) -> np.ndarray:
        high, low = np.uint64(self.high), np.uint64(self.low)
        left, right = number // low, number % low
        for i in range(0, ROUNDS, 2):
            left = (left + self._round(i, right, self.high)) % high
            right = (right + self._round(i + 1, left, self.low)) % low
        return left * low + right

    def _once_back(self, number: np.ndarray) -> np.ndarray:
        high, low = np.uint64(self.high), np.uint64(self.low)
        left, right = number // low, number % low
        for i in range(ROUNDS - 2, -1, -2):
            right = (right + low - self._round(i + 1, left, self.low)) % low
            left = (left + high - self._round(i, right, self.high)) % high
        return left * low + right

    def _walk(self, number: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(number, np.uint64))
        beyond = np.flatnonzero(out >= self.rows)
        while len(beyond):
            out[beyond] = step(out[beyond])
            beyond = beyond[out[beyond] >= self.rows]
        return out.astype(np.int64)

    def place(self, number: np.ndarray) -> np.ndarray:
        """Where the row of each number goes."""
        return self._walk(number, self._once)

    def number(self, place: np.ndarray) -> np.ndarray:
        """The number of the row at each place."""
        return self._walk(place, self._once_back)


def numbers_at(rows: int, shards: int, shard: int, slots: np.ndarray, seed: int = 0) -> np.ndarray:
    """Row numbers at ``slots`` of a shard, as a loader asks for them."""
    return Permutation(rows, seed).number(np.asarray(slots, np.int64) * shards + shard)


def place_of(number: Column, rows: int, seed: int = 0) -> Column:
    """The place of each row number, as a column."""

    def places(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        permutation = Permutation(rows, seed)
        for part in parts:
            yield pa.array(permutation.place(part.to_numpy(zero_copy_only=False)))

    return F.arrow_udf(places, "long")(number)


def _hashed(docs: DataFrame) -> Column:
    """A hash of all columns of a row; maps, which have no hash, go in as JSON."""
    return F.xxhash64(*(F.to_json(f"`{c}`") if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes))


def _numbered(docs: DataFrame, shards: int, seed: int, key: str) -> tuple[DataFrame, int]:
    """The rows of assigned(), and how many there are."""
    if shards < 1:
        raise ValueError(f"{shards} shards")
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "sharding")
    names = [c for c in docs.columns if c not in ("row_number", "shard", "slot")]
    rows = kept(
        docs.select(
            *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)),
            F.col(f"`{key}`").alias("key"),
            _hashed(docs).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        folder,
        "rows",
    )
    # The row's id parts rows that are equal, so that many copies don't fall to one task.
    order = ["key", "hash", "row"]
    ordered = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = kept(ordered.select("row", F.monotonically_increasing_id().alias("at")), folder, "ordered")
    part = F.shiftright("at", ROW_BITS)
    starts, total = [], 0
    for r in sorted(ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        starts.append((r["part"], total))
        total += r["n"]
    before = F.broadcast(spark.createDataFrame(starts, "part long, before long"))
    number = F.col("before") + F.col("at").bitwiseAND((1 << ROW_BITS) - 1)
    numbers = ordered.withColumn("part", part).join(before, "part").select("row", number.alias("number"))
    placed = rows.join(numbers.withColumn("place", place_of(F.col("number"), total, seed)), "row")
    found = placed.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(names)),
        F.col("number").alias("row_number"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {int(shards)}").alias("slot"),
    )
    return found, total


def assigned(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """Adds row_number, shard and slot to docs; other columns stay, columns of these names are replaced.

    Rows are numbered by ``key``, null first, and rows of one key by a hash of all their columns, so neither files nor
    partitions matter. Rows equal in all columns are exchangeable and each keeps a place of its own. Texts may be null,
    empty or long: they are moved, not looked into. An empty table gives an empty result. The rows are kept once in the
    shared folder; what is sorted over the cluster is the key, the hash and the place in that copy. One number for each
    partition of that sort comes to the driver and is broadcast.
    """
    return _numbered(docs, shards, seed, key)[0]


def write(docs: DataFrame, folder: str, shards: int, seed: int = 0, key: str = "doc_id", file_rows: int = FILE_ROWS) -> None:
    """Writes docs as Parquet: a folder ``shard=N`` for each shard, whose files hold ``file_rows`` slots each, in order.

    The rows move twice, to meet their number and to their file. Each file is one task's, however large a shard is. An
    empty table gives a folder without shards.
    """
    placed, total = _numbered(docs, shards, seed, key)
    files = max(-(-total // (shards * file_rows)), 1)
    target = (F.col("shard") * files + F.expr(f"slot div {int(file_rows)}")).cast("int")
    dealt = placed.repartitionById(shards * files, target).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that write() wrote, with row_number, shard and slot."""
    return spark.read.parquet(folder)
