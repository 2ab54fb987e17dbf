"""Packs documents into windows by minimum bin slack, planned on the counts of piece lengths.

A document longer than a window is cut every ``window`` ids; its last piece and shorter documents stay whole. Which
pieces share a window depends on lengths alone, and there are at most ``window`` of them. So the plan is made on the
counts by length: the longest remaining length opens a window, a bitset subset-sum over the remaining lengths finds the
multiset that leaves the least slack, and that pattern is used as often as the counts allow. Pieces get their place by
their rank among the pieces of their length, which is a sum of counts by partition and a running number in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bankmetrics.llm.common import flat_binary, kept, slices, work_folder
from bankmetrics.llm.encoding import WORDS, worker_encoder


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, words: int = WORDS) -> DataFrame:
    """Pieces of at most ``window`` ids: doc_id, start, length, doc_tokens, ids (little-endian u32), part, rank.

    part and rank, the number of the task and the piece's number among those of its length in it, serve assign(). Null or empty text: one piece with the end id. Rows are taken one by one, so repeated rows and null doc_ids stay.
    Other columns are not read. A worker remembers the ids of ``words`` different words.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ranks = worker_encoder(tokenizer, words), Ranks(window)
        for batch in slices(batches, "text"):
            ids, starts = encoder.encode(batch.column("text"), end_id)
            sizes = np.diff(starts)
            pieces = -(-sizes // window)
            row = np.repeat(np.arange(len(sizes)), pieces)
            at = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            bounds = np.append(starts[row] + at, starts[-1])
            length = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(at),
                    pa.array(length),
                    pa.array(sizes[row]),
                    flat_binary(ids.astype("<u4", copy=False), bounds * 4),
                    *ranks.of(length),
                ],
                ["doc_id", "start", "length", "doc_tokens", "ids", "part", "rank"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, rank long"
    return rows.mapInArrow(cut, kind)


class Ranks:
    """Numbers the pieces of each length within a task."""

    def __init__(self, window: int):
        self.seen = np.zeros(window + 1, np.int64)
        self.part = TaskContext.get().partitionId()

    def of(self, length: np.ndarray) -> list[pa.Array]:
        """The task's number, and each piece's number among those of its length so far."""
        order = np.argsort(length, kind="stable")
        own = length[order]
        rank = np.empty(len(own), np.int64)
        rank[order] = self.seen[own] + np.arange(len(own)) - np.searchsorted(own, own)
        self.seen += np.bincount(length, minlength=len(self.seen))
        return [pa.array(np.full(len(own), self.part, np.int32)), pa.array(rank)]


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, each at most as often as counted, whose sum is closest to ``room`` from below.

    Bit s of ``reach`` says that sum s can be made. A count goes in as powers of two of its length, the longest first,
    and the search ends once ``room`` is reached. The sums reached before each step lead back to the counts taken.
    """
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:
            take = min(part, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + take
            total -= length * take
    return taken


def plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, pieces of it per window, first window, offset in the window).

    At most one row for each length of each pattern. Each use of a pattern leaves less of some length than it takes.
    """
    left, used, rows, first = {k: n for k, n in counts.items() if n}, {}, [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = fill({k: n for k, n in left.items() if n}, window - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[k] // n for k, n in pattern.items())
        offset = 0
        for k, n in sorted(pattern.items(), reverse=True):
            a = used.get(k, 0)
            rows.append((k, a, a + n * times, n, first, offset))
            used[k] = a + n * times
            offset += n * k
            left[k] -= n * times
            if not left[k]:
                del left[k]
        first += times
    return rows


def assign(pieces: DataFrame, window: int = 2048, ranked: bool = False) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` from 1 to ``window``; other columns stay as they are.

    Offsets of a sequence run without a gap from 0. Pieces of equal length are exchangeable. An empty table stays empty.
    The plan that is broadcast has a bound by the window alone (a few rows per length), whatever the number of pieces.
    First ranks of a task are one row with an array; these rows meet the pieces by the task's number, broadcast while
    their table is under the session's threshold, else in a shuffle in which every task's pieces stay together.
    ``ranked`` says that part and rank are there, as token_pieces() gives them; they then go.
    """
    spark, folder = pieces.sparkSession, work_folder(pieces.sparkSession, "packing")
    names = [c for c in pieces.columns if not ranked or c not in ("part", "rank")]
    types = dict(pieces.dtypes)
    plain = pieces.select(
        *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)),
        F.col("length").cast("long").alias("_length"),
        *((F.col("part").alias("_part"), F.col("rank").alias("_rank")) if ranked else ()),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(window)
        for batch in batches:
            found = ranks.of(batch.column("_length").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "_part", "_rank"])

    if not ranked:
        kind = f"{', '.join(f'c{i} {types[c]}' for i, c in enumerate(names))}, _length long, _part int, _rank long"
        plain = plain.mapInArrow(number, kind)
    table = kept(plain, folder, "pieces")
    counts = table.groupBy("_length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = kept(counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))), folder, "counts")
    total = {r["_length"]: r["_n"] for r in bases.groupBy("_length").agg(F.sum("_n").alias("_n")).collect()}
    rows = spark.createDataFrame(
        plan(total, window), "_size long, _from long, _to long, _each long, _first long, _offset long"
    )
    # One row for each task, with the bases of the lengths it has (at most ``window``).
    own = F.sort_array(F.collect_list(F.struct(F.col("_length").cast("int").alias("_length"), "_base")))
    starts = bases.groupBy("_part").agg(own.alias("_own"))
    starts = kept(starts.select("_part", F.col("_own._length").alias("_lengths"), F.col("_own._base").alias("_bases")), folder, "starts")
    slot = F.array_position(F.col("_lengths"), F.col("_length").cast("int")).cast("int")
    rank = F.col("_rank") + F.element_at(F.col("_bases"), slot)
    place = F.col("_at") - F.col("_from")
    near = (F.col("_length") == F.col("_size")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    at = table.join(starts, "_part").withColumn("_at", rank).drop("_lengths", "_bases")
    return at.join(F.broadcast(rows), near).select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(names)),
        (F.col("_first") + F.floor(place / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + place % F.col("_each") * F.col("_length")).alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, words: int = WORDS) -> DataFrame:
    """token_pieces() of the documents with their sequence_id and offset, ids included."""
    return assign(token_pieces(docs, tokenizer, end_id, window, words), window, ranked=True)
