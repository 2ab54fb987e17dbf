"""Token ids in binary files of patched frame-of-reference (PFOR) blocks.

File: segments, each followed by one newline byte. Segment (little-endian):

    head       magic "PFR1", shard u32, segment u32, documents u32, ids u64, blocks u32, exceptions u32, words u32,
               crc32 u32 of what follows the head
    documents  doc_id i64, null flag u8, number of ids in this segment u32, whether the document goes on u8; a column each
    blocks     byte offset of the block's packed words u32, minimum u32, width u8, number of exceptions u16, a column each
    exceptions position in the block u16, value over the minimum u32, a column each
    words      u32 words of packed values

A block has BLOCK ids (the last of a segment is filled up with its minimum). The width of a block is that of its
PERCENTILE smallest value over the minimum; larger values are exceptions and packed as their low bits. The block index
gives each block's start, so one block is read without the others.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bankmetrics.llm.common import SLICE_BYTES, slices
from bankmetrics.llm.encoding import worker_encoder

HEAD = "<4sIIIQIIII"
MAGIC = b"PFR1"
BLOCK = 256
PERCENTILE = 0.95
#: Ids of a segment at most, but for those of the last slice of texts.
SEGMENT_IDS = 1 << 20


def widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(rest: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values as rows of BLOCK * width / 32 words; only the low ``width`` bits are kept."""
    out = np.zeros((len(rest), BLOCK * width // 32 + 1), np.uint64)
    low = (rest & np.uint64((1 << width) - 1)).T
    for i in range(BLOCK):
        word, shift = divmod(i * width, 32)
        moved = low[i] << np.uint64(shift)
        out[:, word] |= moved & np.uint64(0xFFFFFFFF)
        if shift + width > 32:
            out[:, word + 1] |= moved >> np.uint64(32)
    return out[:, :-1].astype(np.uint32)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The reverse of pack."""
    wide = np.zeros((words.shape[1] + 1, len(words)), np.uint64)
    wide[:-1] = words.T
    out = np.empty((BLOCK, len(words)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 32)
        out[i] = (wide[word] | wide[word + 1] << np.uint64(32)) >> np.uint64(shift)
    return (out & np.uint64((1 << width) - 1)).T


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, int, int, int]:
    """Block index, exceptions and words as bytes; numbers of blocks, exceptions and words."""
    n = -(-len(ids) // BLOCK)
    full = np.empty(n * BLOCK, np.uint64)
    full[: len(ids)] = ids
    if n:
        full[len(ids) :] = full[(n - 1) * BLOCK : len(ids)].min()
    full = full.reshape(n, BLOCK)
    least = full.min(axis=1)
    rest = full - least[:, None]
    at = int(np.ceil(percentile * BLOCK)) - 1
    width = widths(np.partition(rest, at, axis=1)[:, at] if n else np.zeros(0))
    over = rest >> width.astype(np.uint64)[:, None] != 0
    block, place = np.nonzero(over)
    sizes = BLOCK * width // 32
    starts = np.cumsum(sizes) - sizes
    words = np.empty(int(sizes.sum()), np.uint32)
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            words[starts[rows][:, None] + np.arange(BLOCK * w // 32)] = pack(rest[rows], w)
    body = b"".join(
        x.tobytes()
        for x in (
            (starts * 4).astype("<u4"),
            least.astype("<u4"),
            width.astype(np.uint8),
            over.sum(axis=1).astype("<u2"),
            place.astype("<u2"),
            rest[block, place].astype("<u4"),
            words.astype("<u4", copy=False),
        )
    )
    return body, n, len(block), len(words)


class Segment:
    """Reads one segment from ``buffer`` at ``at``."""

    def __init__(self, buffer, at: int = 0, check: bool = True):
        magic, self.shard, self.number, docs, self.n_ids, blocks, exceptions, words, crc = struct.unpack_from(HEAD, buffer, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        self.columns, place = [], at + struct.calcsize(HEAD)
        kinds = [("<i8", docs), ("u1", docs), ("<u4", docs), ("u1", docs), ("<u4", blocks), ("<u4", blocks), ("u1", blocks), ("<u2", blocks), ("<u2", exceptions), ("<u4", exceptions), ("<u4", words)]
        for kind, n in kinds:
            self.columns.append(np.frombuffer(buffer, kind, n, place))
            place += n * np.dtype(kind).itemsize
        self.end = place
        if check and zlib.crc32(memoryview(buffer)[at + struct.calcsize(HEAD) : place]) != crc:
            raise ValueError(f"segment at byte {at} is damaged")
        self.doc_id, self.no_id, self.sizes, self.goes_on = self.columns[:4]

    def block(self, k: int) -> np.ndarray:
        """The ids of block k alone, found through the block index."""
        starts, least, width, count, place, value, words = self.columns[4:]
        w = int(width[k])
        a = int(starts[k]) // 4
        rest = unpack(words[a : a + BLOCK * w // 32][None, :], w)[0] if w else np.zeros(BLOCK, np.uint64)
        first = int(count[:k].sum())
        rest[place[first : first + count[k]]] = value[first : first + count[k]]
        return (rest + least[k]).astype(np.uint32)[: self.n_ids - k * BLOCK]

    def ids(self) -> np.ndarray:
        starts, least, width, count, place, value, words = self.columns[4:]
        rest = np.zeros((len(least), BLOCK), np.uint64)
        for w in np.unique(width).tolist():
            if w:
                rows = np.flatnonzero(width == w)
                rest[rows] = unpack(words[starts[rows].astype(np.int64)[:, None] // 4 + np.arange(BLOCK * w // 32)], w)
        rest[np.repeat(np.arange(len(least)), count), place] = value
        return (rest + least[:, None]).astype(np.uint32).reshape(-1)[: self.n_ids]


def segment(shard: int, number: int, docs: list[tuple], ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """docs: (doc_id or None, number of ids, goes on)."""
    body, blocks, exceptions, words = encode_blocks(ids, percentile)
    doc = np.array([d[0] or 0 for d in docs], "<i8").tobytes()
    doc += np.array([d[0] is None for d in docs], "u1").tobytes() + np.array([d[1] for d in docs], "<u4").tobytes()
    doc += np.array([d[2] for d in docs], "u1").tobytes()
    crc = zlib.crc32(body, zlib.crc32(doc))
    return struct.pack(HEAD, MAGIC, shard, number, len(docs), len(ids), blocks, exceptions, words, crc) + doc + body


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    percentile: float = PERCENTILE,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encodes doc_id and text of every document and writes the ids, in ascending doc_id order, to files in ``folder``.

    Null or empty text: only the end id. A null doc_id sorts first and stays null; rows of one doc_id sort by their
    text's hash, equal rows in any order. Other columns are not read. An empty table gives files without segments.
    Shards are ranges of doc_id, one file each, so nothing passes through one task; Spark's writer commits the files.
    A segment ends after segment_ids ids, within a long document too.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number = worker_encoder(tokenizer), TaskContext.get().partitionId(), 0
        waiting, held = [], []
        have = 0

        def flush(number: int) -> pa.RecordBatch:
            raw = segment(shard, number, waiting, np.concatenate(held or [np.zeros(0, np.uint32)]), percentile)
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["value"])

        for batch in slices(batches, "text", 2 * SLICE_BYTES):
            ids, starts = encoder.encode(batch.column("text"), end_id)
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                a, b = int(starts[i]), int(starts[i + 1])
                while b - a > segment_ids - have:
                    cut = a + segment_ids - have
                    waiting.append((doc, cut - a, True))
                    held.append(ids[a:cut])
                    yield flush(number)
                    number, waiting, held, have, a = number + 1, [], [], 0, cut
                waiting.append((doc, b - a, False))
                held.append(ids[a:b])
                have += b - a
        if waiting:
            yield flush(number)

    key = [F.col("doc_id").asc_nulls_first(), F.col("mark").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.withColumn("mark", F.xxhash64("text")).repartitionByRange(*key).sortWithinPartitions(*key)
    lines = dealt.select("doc_id", "text").mapInArrow(files, "value binary")
    lines.select(F.col("value").cast("string").alias("value")).write.text(folder)


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """The files of ``write`` as rows (content); a file must fit one row."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files: doc_id, shard, place in it, start (ids of all documents before), ids (binary, u32).

    ``start`` adds up the ids of the files before, which the heads of the segments tell, and those before in the file.
    The heads cost a read of the files of their own; who keeps the rows of ``read_local`` anyway saves it by
    ``with_start`` on the table kept. No files, or files without segments, give no rows.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                raw, at, shard, total = raw.as_buffer(), 0, None, 0
                while at < len(raw):
                    part = Segment(raw, at, check=False)
                    at, shard, total = part.end + 1, part.shard, total + part.n_ids
                if shard is not None:
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "n": [total]})

    return with_start(read_local(spark, folder), contents(spark, folder).mapInArrow(heads, "shard long, n long"))


def read_local(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files by one read: doc_id, shard, place in it, local (ids before in it), n_tokens, ids."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                raw, at, start, place = raw.as_buffer(), 0, 0, 0
                head: list[np.ndarray] = []
                while at < len(raw):
                    part = Segment(raw, at)
                    at, ids = part.end + 1, part.ids()
                    ends = np.cumsum(part.sizes, dtype=np.int64)
                    whole = np.flatnonzero(part.goes_on == 0)
                    values = [ids[e - s : e] for e, s in zip(ends.tolist(), part.sizes.tolist())]
                    if head:
                        values[0] = np.concatenate([*head, values[0]])
                    head = [values[-1]] if part.goes_on.size and part.goes_on[-1] else []
                    values = [values[i] for i in whole]
                    sizes = np.array([len(v) for v in values], np.int64)
                    if len(values):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part.doc_id[whole], pa.int64(), mask=part.no_id[whole] == 1),
                                pa.array(np.full(len(whole), part.shard), pa.int64()),
                                pa.array(np.arange(place, place + len(whole)), pa.int64()),
                                pa.array(start + np.cumsum(sizes) - sizes),
                                pa.array(sizes),
                                pa.array([v.tobytes() for v in values], pa.binary()),
                            ],
                            ["doc_id", "shard", "place", "local", "n_tokens", "ids"],
                        )
                    start, place = start + int(sizes.sum()), place + len(whole)

    kind = "doc_id long, shard long, place long, local long, n_tokens long, ids binary"
    return contents(spark, folder).mapInArrow(documents, kind)


def with_start(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """rows with start, the ids of the shards before, by ``totals`` (shard, n), and those of ``local``, which goes.

    The sums, one number for each file and so one for each shuffle partition of the writer at most, are broadcast.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    start = (F.col("before") + F.col("local")).alias("start")
    others = [c for c in rows.columns if c not in ("doc_id", "shard", "place", "local")]
    return rows.join(F.broadcast(offsets), "shard").select("doc_id", "shard", "place", start, *others)
