"""Document fingerprints from prefix polynomial hashes.

For a text of code points c and a base B, the prefix array S[i] = sum(c[j] * B**j for j < i) modulo a prime tells the
hash of any span, (S[b] - S[a]) / B**a, in constant time. Two primes make it 62 bits. Spans are equal if their hashes
are, the longest common extension of two places is found by binary search, and the hash of a text joined of two spans
follows from theirs.

A fingerprint is the number of code points, the hash of the whole text, and the least span hash in each of SLOTS classes
over all spans of SPAN code points. The share of equal slots estimates the share of common spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bankmetrics.llm.common import kept, slices, work_folder

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
SPAN = 12
SLOTS = 64
#: A slot without a span.
EMPTY = 0xFFFF


def points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ x >> np.uint64(33)


class Powers:
    """Powers of the bases and of their inverses, up to the largest exponent asked for."""

    def __init__(self):
        self.tables = [[np.ones(1, np.uint64) for _ in PRIMES] for _ in range(2)]

    def upto(self, n: int) -> list[list[np.ndarray]]:
        for kind, tables in enumerate(self.tables):
            for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
                step = pow(base, -1, prime) if kind else base
                table = tables[k]
                while len(table) <= n:
                    table = np.concatenate([table, table * np.uint64(pow(step, len(table), prime)) % np.uint64(prime)])
                tables[k] = table
        return self.tables


class PrefixHashes:
    """Prefix arrays of texts that lie one after the other in ``signs``."""

    def __init__(self, signs: np.ndarray, powers: Powers):
        self.size, self.tables = len(signs), powers.upto(len(signs))
        wide = signs.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for prime, power in zip(PRIMES, self.tables[0]):
            terms = wide * power[: len(wide)] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(prime)]))

    def spans(self, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """The hash of each span for each prime."""
        out = []
        for prime, total, inverse in zip(PRIMES, self.sums, self.tables[1]):
            p = np.uint64(prime)
            out.append((total[end] + p - total[begin]) % p * inverse[begin] % p)
        return out

    def windows(self, span: int) -> np.ndarray:
        """One word for the span of ``span`` signs at each place."""
        n = max(self.size - span + 1, 0)
        out = np.zeros(n, np.uint64)
        for prime, total, inverse in zip(PRIMES, self.sums, self.tables[1]):
            p = np.uint64(prime)
            out = out << np.uint64(31) ^ (total[span : span + n] + p - total[:n]) % p * inverse[:n] % p
        return mixed(out)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the spans of ``length`` signs at a and b are equal."""
        left, right = self.spans(a, a + length), self.spans(b, b + length)
        return (left[0] == right[0]) & (left[1] == right[1])

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The longest common extension of places a and b, up to ``most`` signs, by binary search."""
        low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def joined(left: list[np.ndarray], size: np.ndarray, right: list[np.ndarray], powers: Powers) -> list[np.ndarray]:
    """Hashes of texts made of two spans, the first of ``size`` signs."""
    tables = powers.upto(int(size.max(initial=0)))[0]
    return [
        (a + b * power[size] % np.uint64(prime)) % np.uint64(prime)
        for a, b, power, prime in zip(left, right, tables, PRIMES)
    ]


def least_by_slot(owner: np.ndarray, words: np.ndarray, out: np.ndarray) -> None:
    """Puts the least 16 bits of each owner's words of each slot into out (owners by SLOTS)."""
    slot = words % np.uint64(SLOTS)
    value = ((words >> np.uint64(8)) % np.uint64(EMPTY)).astype(np.uint16)
    np.minimum.at(out.reshape(-1), owner * SLOTS + slot.astype(np.int64), value)


def likeness(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Share of equal slots among those that either has; 1 for equal texts, 0 where neither has a slot otherwise."""
    have = (a != EMPTY) | (b != EMPTY)
    share = ((a == b) & have).sum(axis=1) / np.maximum(have.sum(axis=1), 1)
    return np.where(same, 1.0, share)


def packed(sizes: np.ndarray, hashes: list[np.ndarray], slots: np.ndarray) -> list[bytes]:
    """Fingerprints as bytes: code points u32, the two hashes u32, the slots u16, big-endian."""
    head = np.stack([sizes.astype(">u4"), hashes[0].astype(">u4"), hashes[1].astype(">u4")], axis=1).astype(">u4")
    raw = np.concatenate([head.view(np.uint8).reshape(len(sizes), -1), slots.astype(">u2").view(np.uint8).reshape(len(sizes), -1)], axis=1)
    return [r.tobytes() for r in raw]


def described(texts: list[str], nexts: list[str], powers: Powers) -> dict[str, list]:
    """Fingerprints of texts and of their edited texts, and likenesses; nexts[i] follows texts[i].

    If nexts is texts one place further, as in a sorted partition, each text is hashed once.
    """
    count = len(texts)
    chain = nexts[:-1] == texts[1:]
    every = [*texts, nexts[-1]] if chain else [x for pair in zip(texts, nexts) for x in pair]
    own = np.arange(count) if chain else np.arange(count) * 2
    sizes = np.array([len(x) for x in every], np.int64)
    begin = np.cumsum(sizes) - sizes
    hashes = PrefixHashes(points(every), powers)
    whole = hashes.spans(begin, begin + sizes)
    words = hashes.windows(SPAN)
    slots = np.full((len(every), SLOTS), EMPTY, np.uint16)
    runs = np.maximum(sizes - SPAN + 1, 0)
    owner = np.repeat(np.arange(len(every)), runs)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    values = words[begin[owner] + place]
    least_by_slot(owner, values, slots)
    short = np.flatnonzero((sizes > 0) & (sizes < SPAN))
    least_by_slot(short, mixed(whole[0][short] << np.uint64(31) ^ whole[1][short]), slots)

    n, following = sizes[own], own + 1
    keep = n - n // 4
    head = np.minimum(n // 4, sizes[following])
    # Spans of the edited text: those within the kept part, those within the next text's head, those across.
    edited = np.full((count, SLOTS), EMPTY, np.uint16)
    back = np.full(len(every), -1, np.int64)
    back[own] = np.arange(count)
    limit = np.zeros(len(every), np.int64)
    limit[own] = keep
    inside = (back[owner] >= 0) & (place + SPAN <= limit[owner])
    least_by_slot(back[owner[inside]], values[inside], edited)
    back[:], limit[:] = -1, 0
    back[following], limit[following] = np.arange(count), head
    inside = (back[owner] >= 0) & (place + SPAN <= limit[owner])
    least_by_slot(back[owner[inside]], values[inside], edited)
    seams = [
        t[max(0, k - SPAN + 1) : k] + x[: min(h, SPAN - 1)]
        for t, x, k, h in zip(texts, nexts, keep.tolist(), head.tolist())
    ]
    lengths = np.array([len(x) for x in seams], np.int64)
    starts = np.cumsum(lengths) - lengths
    seam = PrefixHashes(points(seams), powers)
    width = np.minimum(lengths, SPAN)
    # Short edited texts are one span; of others only spans that hold signs of both sides count.
    runs = np.where((lengths >= SPAN) & (head > 0), lengths - SPAN + 1, ((keep + head < SPAN) & (lengths > 0)).astype(np.int64))
    owner = np.repeat(np.arange(count), runs)
    at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    a, b = seam.spans(at, at + width[owner])
    least_by_slot(owner, mixed(a << np.uint64(31) ^ b), edited)

    left = hashes.spans(begin[own], begin[own] + keep)
    right = hashes.spans(begin[following], begin[following] + head)
    edited_whole = joined(left, keep, right, powers)
    own_whole = [x[own] for x in whole]
    next_whole = [x[following] for x in whole]
    same = lambda x, size: (own_whole[0] == x[0]) & (own_whole[1] == x[1]) & (n == size)
    # The kept part is common, and what the next text's head happens to share with the text's own end.
    shared = keep + hashes.extension(begin[own] + keep, begin[following], np.minimum(n - keep, head))
    return {
        "n_chars": n,
        "edited_sha256": [
            hashlib.sha256((t[:k] + x[:h]).encode("utf-8", "surrogatepass")).hexdigest()
            for t, x, k, h in zip(texts, nexts, keep.tolist(), head.tolist())
        ],
        "fingerprint": packed(n, own_whole, slots[own]),
        "edited_fingerprint": packed(keep + head, edited_whole, edited),
        "near_edited": likeness(slots[own], edited, same(edited_whole, keep + head)),
        "near_next": likeness(slots[own], slots[following], same(next_whole, sizes[following])),
        "common_prefix": shared,
    }


COLUMNS = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, common_prefix long"


def _batch(ids: list, texts: list[str], nexts: list[str], powers: Powers) -> list[pa.Array]:
    found = described(texts, nexts, powers)
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]
    return [pa.array(ids, pa.int64()), *(pa.array(v, k) for v, k in zip(found.values(), kinds))]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, common_prefix of all rows.

    The edited text has the last n // 4 code points of the text replaced by the first as many, or all, of the next row's
    in ascending doc_id order; the last row's next is the first row, which for one row is itself. Null text is empty, a
    null doc_id comes first, rows of one doc_id are in the order of their text's hash, and equal rows are exchangeable.
    An empty table gives an empty result. common_prefix is the longest common extension of the text's and the edited
    text's starts.

    Rows are sorted in ranges. All but the last row of a range find their next in it; the first and last texts of the
    ranges, two for each, then meet in a join.
    """
    folder = work_folder(docs.sparkSession, "prefix-hash")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, part, last = Powers(), TaskContext.get().partitionId(), None
        names = ["edge", "part", "text", "doc_id", *(c.split()[0] for c in COLUMNS.split(", "))]
        blank = [pa.nulls(1, k) for k in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64())]

        def edge(kind: str, row: tuple) -> pa.RecordBatch:
            head = [pa.array([kind]), pa.array([part], pa.int64()), pa.array([row[1]], pa.string()), pa.array([row[0]], pa.int64())]
            return pa.RecordBatch.from_arrays([*head, *blank], names)

        for batch in slices(batches, "text"):
            rows = list(zip(batch.column("doc_id").to_pylist(), (x or "" for x in batch.column("text").to_pylist())))
            if last is None:
                yield edge("first", rows[0])
            else:
                rows.insert(0, last)
            last = rows[-1]
            if len(rows) > 1:
                ids, texts = [r[0] for r in rows[:-1]], [r[1] for r in rows]
                found = _batch(ids, texts[:-1], texts[1:], powers)
                n = len(ids)
                head = [pa.array(["row"] * n), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*head, *found], names)
        if last is not None:
            yield edge("last", last)

    key = [F.col("doc_id").asc_nulls_first(), F.col("mark").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = rows.withColumn("mark", F.xxhash64("text")).repartitionByRange(*key).sortWithinPartitions(*key)
    found = dealt.select("doc_id", "text").mapInArrow(ranges, f"edge string, part long, text string, doc_id long, {COLUMNS}")
    found = kept(found, folder, "rows")

    # One row for each range: which range comes next, the last's being the first.
    firsts = found.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    order = Window.orderBy("part")
    parts = found.where("edge = 'first'").select("part")
    parts = parts.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("next"))
    lasts = found.where("edge = 'last'").select("part", "doc_id", "text").join(parts, "part").join(firsts, "next")

    def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        names = ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))]
        for batch in slices(batches, "text"):
            texts = [batch.column(c).to_pylist() for c in ("text", "next_text")]
            yield pa.RecordBatch.from_arrays(_batch(batch.column("doc_id").to_pylist(), *texts, powers), names)

    ends = lasts.select("doc_id", "text", "next_text").mapInArrow(seams, f"doc_id long, {COLUMNS}")
    return found.where("edge = 'row'").drop("edge", "part", "text").unionByName(ends)
