"""Exact n-gram Jaccard join with set-relation skipping.

Texts become sets of word shingles, each a hash. Documents of one set are one node. Two sets with 100 * |x & y| >=
75 * |x | y| must share a token within the first |x| - ceil(0.75 |x|) + 1 tokens of each, in any common order of tokens;
the order here is rarest first.

Frequencies. A scan deals the tokens by hash into buckets, each token once per batch of texts. A bucket tells each batch
which of its tokens other documents have too, and how many. Tokens that one document alone has are not sent back: they
only count as that document's leading tokens. Documents with too few shared tokens are done.

Index-level skipping. A list has the sets that a token leads to, in blocks by (size of the set, place of the token in
it). Sizes and places bound the overlap of any two sets of two blocks, and a block that no other can go with is skipped.

Answer-level skipping. The set of a list with the token at the first place is its centre, and each set of the list is
compared with it. That answer bounds those of all others: sets x and y share at most min(o(c, x), o(c, y)) tokens of c
and, beyond c, as many as the one has that has fewer there, without those that it alone has. Sets that the centres' answers have joined need no
comparison with each other; of the rest, only pairs that the bound leaves are compared. A bitmap of each set, in which
every token flips one bit, bounds them too: sets differ in at least as many tokens as their bitmaps do in bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.llm.common import flat_binary, forget, give_back_at_once, held_by_worker, kept, slices, work_folder

WORDS = 5
#: Likeness at least, in hundredths.
PERCENT = 75

#: Tokens of a bucket, about; the number of buckets follows from the number of all tokens.
BUCKET_TOKENS = 1 << 20

#: Bytes of text of a batch.
BATCH_BYTES = 4 << 20

MANY = 0xFFFF

#: Words of 64 bits of a set's bitmap.
MAP = 4
MAPS = [f"map{i}" for i in range(MAP)]

#: Two sums of hashes of a set's tokens; with its size they name the set.
SUMS = ["sum_a", "sum_b"]
SEEDS = (0x1234567, 0x7654321)

CHANGED = "the rows changed between two scans; write them to a table first"

#: Rounds of the search for components; chains of links at least halve in each, so more mean a fault.
ROUNDS = 99


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where those of each text start (one more than texts)."""
    n = len(texts)
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    bounds = split.offsets.to_numpy()
    coded = split.flatten().dictionary_encode()
    # Only here, on an array that is no slice: pyarrow's ascii_lower misreads slices.
    names = pc.ascii_lower(coded.dictionary)
    index = coded.indices.to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, names.cast(pa.large_binary()).to_pylist()), np.uint64, len(names))
    filled = (pc.binary_length(names).to_numpy(zero_copy_only=False) > 0)[index] if len(index) else np.zeros(0, bool)
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))[filled]
    word = hashes[index[filled]]
    del coded, split, index, filled
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    # The hash of a shingle starting at each word; short texts have one of all their words, with their number.
    sizes = np.minimum(count, words)
    value = np.zeros(len(word), np.uint64)
    for k in range(min(words, len(word))):
        moved = value * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
        moved[: len(word) - k] += word[k:]
        inside = k < sizes[owner]
        value[inside] = mix(moved[inside])
    whole = np.arange(len(word)) - first[owner] <= (count - sizes)[owner]
    value, owner = value[whole], owner[whole]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def set_sums(values: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The SUMS of each set of shingle_sets()."""
    sums = []
    for seed in SEEDS:
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(seed)))])
        sums.append(total[bounds[1:]] - total[bounds[:-1]])
    return sums


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches of bounded text and fewer than MANY rows, each with a number that no other of the scan has."""
    held_by_worker(("jaccard",), dict)  # what another operator left in this worker goes
    give_back_at_once()
    number = TaskContext.get().partitionId() << 32
    for batch in slices(batches, "text", BATCH_BYTES):
        for a in range(0, batch.num_rows, MANY - 1):
            yield number, batch.slice(a, MANY - 1)
            number += 1


def _mark(batch: pa.RecordBatch, values: np.ndarray, bounds: np.ndarray) -> int:
    """A hash of a batch's ids and sets in their order: both scans must number the same rows alike."""
    seen = xxhash.xxh64(np.ascontiguousarray(values))
    seen.update(np.ascontiguousarray(bounds, np.int64))
    ids = batch.column("doc_id")
    seen.update(np.ascontiguousarray(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)))
    seen.update(np.ascontiguousarray(np.asarray(ids.is_null())))
    return seen.intdigest() >> 1


def _once(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different tokens of a batch, ascending; the text of each, or MANY; and all occurrences sorted alike."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    start = np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))
    token, count = ordered[start], np.diff(np.append(start, len(ordered)))
    who = np.where(count == 1, owner[order][start], MANY).astype(np.uint16)
    return token, who, np.stack([start, count])


def _scan_sets(docs: DataFrame, words: int) -> DataFrame:
    """For each batch its documents and the tokens that several of them have.

    doc_id, n (size of the set) and two sums of hashes that tell sets apart are packed columns of binary; so are the
    shared tokens, with the numbers of texts that have each and those texts.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in _batches(batches):
            values, bounds = shingle_sets(batch.column("text"), words)
            sums = set_sums(values, bounds)
            token, who, (start, count) = _once(values, bounds)
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[np.argsort(values, kind="stable")]
            several = count > 1
            texts = owner[np.repeat(several, count)].astype(np.uint16)
            ids = batch.column("doc_id")
            columns = [
                pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8"),
                np.asarray(ids.is_null()).astype(np.uint8),
                np.diff(bounds).astype("<u4"),
                sums[0],
                sums[1],
                token[several],
                count[several].astype("<u2"),
                texts,
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (number, _mark(batch, values, bounds), len(values))]
                + [pa.array([c.tobytes()], pa.binary()) for c in columns],
                ["batch", "mark", "tokens", "ids", "no_id", "n", "sum_a", "sum_b", "shared", "times", "texts"],
            )

    kind = "batch long, mark long, tokens long, ids binary, no_id binary, n binary, sum_a binary, sum_b binary, shared binary, times binary, texts binary"
    return docs.mapInArrow(scan, kind)


def _scan_tokens(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """Each batch's different tokens, once, by bucket: the top ``bits`` of a hash. The next 40 bits name the token."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in _batches(batches):
            values, bounds = shingle_sets(batch.column("text"), words)
            token, who, (_, count) = _once(values, bounds)
            if not len(token):
                continue
            mark = _mark(batch, values, bounds)
            bucket = (token >> np.uint64(64 - bits)).astype(np.int64)
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            name = token >> np.uint64(24 - bits)
            low = (name & np.uint64(0xFFFFFFFF)).astype("<u4")
            high = (name >> np.uint64(32) & np.uint64(0xFF)).astype(np.uint8)
            several = who == MANY
            counts = np.concatenate([[0], np.cumsum(several)])[edges]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[edges[:-1]]),
                    pa.array(np.full(len(edges) - 1, number)),
                    pa.array(np.full(len(edges) - 1, mark)),
                    flat_binary(low.tobytes(), edges * 4),
                    flat_binary(high.tobytes(), edges),
                    flat_binary(who.astype("<u2").tobytes(), edges * 2),
                    flat_binary(count[several].astype("<u2").tobytes(), counts * 2),
                ],
                ["bucket", "batch", "mark", "low", "high", "who", "times"],
            )

    return docs.mapInArrow(scan, "bucket long, batch long, mark long, low binary, high binary, who binary, times binary")


def _shared_tokens(tokens: DataFrame, bits: int) -> DataFrame:
    """For each batch, its tokens of a bucket that more than one document has: token, number of documents, text or MANY."""

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kinds = (("low", "<u4"), ("high", "u1"), ("who", "<u2"), ("times", "<u2"))
        rows = [np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in kinds]
        sizes = pc.binary_length(table.column("high")).to_numpy().astype(np.int64)
        name = rows[0].astype(np.uint64) | rows[1].astype(np.uint64) << np.uint64(32)
        order = np.argsort(name, kind="stable")
        sorted_name = name[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_name[1:] != sorted_name[:-1]]))
        documents = np.ones(len(name), np.int64)
        documents[rows[2] == MANY] = rows[3]
        seen = np.empty(len(name), np.int64)
        seen[order] = np.repeat(np.add.reduceat(documents[order], first), np.diff(np.append(first, len(name))))
        keep = seen > 1
        owner = np.repeat(np.arange(len(sizes)), sizes)[keep]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
        full = np.uint64(key[0].as_py()) << np.uint64(40) | name[keep]
        return pa.Table.from_arrays(
            [
                table.column("batch"),
                table.column("mark"),
                flat_binary(full.astype("<u8").tobytes(), ends * 8),
                flat_binary(seen[keep].astype("<u4").tobytes(), ends * 4),
                flat_binary(rows[2][keep].astype("<u2").tobytes(), ends * 2),
            ],
            ["batch", "mark", "token", "seen", "who"],
        )

    found = tokens.groupBy("bucket").applyInArrow(count, "batch long, mark long, token binary, seen binary, who binary")
    return found.where(F.length("token") > 0)


def _linkable(scanned: DataFrame, shared: DataFrame, bits: int, percent: int) -> DataFrame:
    """Documents with enough shared tokens for a link: doc_id, n, sums, unique (tokens no other has), bitmaps, tokens.

    Tokens come rarest first; they and the bitmaps leave out those that no other document has. A batch whose rows or
    their order differ between the two scans ends the query with an error: its texts are known by their place only.
    """
    empty = F.lit(None).cast("binary")
    own = ("ids", "no_id", "n", "sum_a", "sum_b", "shared", "times", "texts")
    docs = scanned.select("batch", "mark", *own, *(empty.alias(c) for c in ("token", "seen", "who")))
    back = shared.select("batch", "mark", *(empty.alias(c) for c in own), "token", "seen", "who")

    def order(table: pa.Table) -> pa.Table:
        def joined(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), kind)

        if len(pc.unique(table.column("mark"))) > 1 or table.column("ids").null_count == table.num_rows:
            raise ValueError(CHANGED)
        ids, no_id, n = joined("ids", "<i8"), joined("no_id", "u1"), joined("n", "<u4").astype(np.int64)
        token, seen, who = joined("token", "<u8"), joined("seen", "<u4"), joined("who", "<u2")
        lone = who != MANY
        # Tokens of several texts of the batch: their texts were kept by the first scan.
        many = joined("shared", "<u8") >> np.uint64(24 - bits)
        times, texts = joined("times", "<u2").astype(np.int64), joined("texts", "<u2")
        by = np.argsort(token[~lone])
        at = np.searchsorted(token[~lone], many, sorter=by)
        if len(many) and (at.max() == len(by) or (token[~lone][by[at]] != many).any()):
            raise ValueError(CHANGED)
        total = seen[~lone][by[at]] if len(many) else np.zeros(0, np.int64)
        tokens = np.concatenate([token[lone], np.repeat(many, times)])
        counts = np.concatenate([seen[lone].astype(np.int64), np.repeat(total, times)])
        owner = np.concatenate([who[lone], texts]).astype(np.int64)
        have = np.bincount(owner, minlength=len(n))
        able = (100 * have >= percent * n) & (n > 0) & (no_id == 0)
        keep = able[owner]
        rank = np.lexsort((tokens[keep], counts[keep], owner[keep]))
        tokens, owner = tokens[keep][rank], owner[keep][rank]
        rows = np.flatnonzero(able)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])
        ends = np.append(ends[rows], ends[-1])
        row = np.repeat(np.arange(len(rows)), np.diff(ends))
        flips = np.bincount(row * (64 * MAP) + (mix(tokens) % np.uint64(64 * MAP)).astype(np.int64), minlength=len(rows) * 64 * MAP)
        maps = np.packbits((flips % 2).astype(np.uint8)).view("<i8").reshape(len(rows), MAP)
        return pa.Table.from_arrays(
            [
                pa.array(ids[rows]),
                pa.array(n[rows]),
                *(pa.array(joined(c, "<i8")[rows]) for c in SUMS),
                pa.array((n - have)[rows]),
                *(pa.array(maps[:, i]) for i in range(MAP)),
                flat_binary(tokens.astype("<u8").tobytes(), ends * 8),
            ],
            ["doc_id", "n", *SUMS, "unique", *MAPS, "tokens"],
        )

    kind = f"doc_id long, n long, sum_a long, sum_b long, unique long, {', '.join(f'{m} long' for m in MAPS)}, tokens binary"
    return docs.unionByName(back).groupBy("batch").applyInArrow(order, kind)


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """token, node, n, unique, place for the shared tokens among a set's first n - ceil(percent * n / 100) + 1."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            unique = batch.column("unique").to_numpy()
            take = np.maximum(n - -(-percent * n // 100) + 1 - unique, 0)
            if not take.sum():
                continue
            tokens = [np.frombuffer(t.as_buffer(), "<u8", k) for t, k in zip(batch.column("tokens"), take.tolist())]
            row = np.repeat(np.arange(len(n)), take)
            place = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take) + unique[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).astype(np.int64)),
                    batch.column("node").take(pa.array(row)),
                    pa.array(n[row]),
                    pa.array(unique[row]),
                    pa.array(place),
                ],
                ["token", "node", "n", "unique", "place"],
            )

    kind = "token long, node long, n long, unique long, place long"
    return sets.select("node", "n", "unique", "tokens").mapInArrow(lead, kind)


def _enough(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether ``overlap`` shared tokens are enough for sets of n and m."""
    return 100 * overlap >= percent * (n + m - overlap)


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds ``overlap`` to pairs (a, b) of nodes. Only tokens that both may share are compared."""

    def common(left: pa.Array, right: pa.Array) -> pa.Array:
        out = np.empty(len(left), np.int64)
        for i, (x, y) in enumerate(zip(left, right)):
            tokens = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
            out[i] = len(np.intersect1d(*tokens, assume_unique=True))
        return pa.array(out)

    both = F.arrow_udf(common, "long")
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("a_tokens"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("b_tokens"))
    found = pairs.join(a, "a").join(b, "b").withColumn("overlap", both("a_tokens", "b_tokens"))
    return found.drop("a_tokens", "b_tokens")


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """node and component (the smallest node that links reach) for the nodes of ``edges`` (a, b).

    Each round links every node to the smallest node around it, and that to the smaller ones there, so stars merge;
    tables are kept in the shared folder after each round, and rounds end when no link changes.
    """
    links = kept(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), folder, f"{name}-0"
    )
    state = None
    for step in range(1, ROUNDS + 1):
        # Larger neighbours of a node, and it, go to its smallest neighbour; then smaller ones likewise. What joins the
        # links of a node to its smallest neighbour is kept, so that a frequent node's links are split among tasks.
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = kept(
            both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), folder, f"{name}-{step}-least"
        )
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        grown = kept(
            large.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).where("a > b").distinct(),
            folder,
            f"{name}-{step}-grown",
        )
        low = kept(grown.groupBy("a").agg(F.min("b").alias("m")), folder, f"{name}-{step}-low")
        small = grown.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = kept(
            small.unionByName(low.select("a", F.col("m").alias("b"))).where("a > b").distinct(), folder, f"{name}-{step}"
        )
        mark = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        before, state = state, tuple(links.agg(F.count("*"), mark).first())
        for old in (f"{name}-{step - 1}", f"{name}-{step}-least", f"{name}-{step}-grown", f"{name}-{step}-low"):
            forget(edges.sparkSession, folder, old)
        if state == before:
            break
    else:
        raise RuntimeError(f"links still change after {ROUNDS} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _links(docs: DataFrame, words: int, percent: int, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n, sums) of docs, nodes (sets with their number and smallest doc_id) and links (a, b) of nodes."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned = kept(_scan_sets(rows, words), folder, "scanned")
    total = scanned.agg(F.sum("tokens")).first()[0] or 0
    bits = min(24, max(8, int(total // BUCKET_TOKENS).bit_length()))
    shared = _shared_tokens(_scan_tokens(rows, words, bits), bits)
    linkable = kept(_linkable(scanned, shared, bits, percent), folder, "linkable")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(r["ids"], "<i8"), mask=np.frombuffer(r["no_id"], "u1") == 1),
                        pa.array(np.frombuffer(r["n"], "<u4").astype(np.int64)),
                        pa.array(np.frombuffer(r["sum_a"], "<i8")),
                        pa.array(np.frombuffer(r["sum_b"], "<i8")),
                    ],
                    ["doc_id", "n", "sum_a", "sum_b"],
                )

    each = scanned.select("ids", "no_id", "n", "sum_a", "sum_b").mapInArrow(
        unpacked, "doc_id long, n long, sum_a long, sum_b long"
    )
    each = kept(each, folder, "each")
    # Documents of one set are one node, numbered in the stored table; the one with the smallest doc_id stands for it.
    known = each.where("n > 0 and doc_id is not null")
    nodes = known.groupBy("n", *SUMS).agg(F.min("doc_id").alias("least"))
    nodes = kept(nodes.withColumn("node", F.monotonically_increasing_id()), folder, "nodes")
    sets = linkable.join(nodes.withColumnRenamed("least", "doc_id"), ["doc_id", "n", *SUMS]).drop("doc_id", *SUMS)
    sets = kept(sets.dropDuplicates(["node"]), folder, "sets")

    posts = kept(_prefixes(sets, percent), folder, "posts")
    first = F.min(F.struct("place", "n", "node")).alias("c")
    lists = kept(posts.groupBy("token").agg(first, F.count("*").alias("size")).where("size > 1"), folder, "centres")
    posts = posts.join(lists.select("token", F.col("c.node").alias("centre")), "token")
    posts = kept(posts, folder, "lists")
    answers = posts.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    sizes = sets.select("node", "n")
    answers = _overlaps(answers, sets)
    answers = answers.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a")), "a")
    answers = kept(answers.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b")), "b"), folder, "answers")
    near = answers.where(_enough(F.col("overlap"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")
    joined = components(near, folder, "first")

    # What is left: sets of one list in different components.
    own = posts.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = answers.select(F.col("a").alias("centre"), F.col("b").alias("node"), "overlap")
    own = own.join(known, ["centre", "node"], "left").withColumn("overlap", F.coalesce("overlap", "n"))
    groups = own.groupBy("token", "component").agg(F.count("*").alias("size"))
    main = groups.groupBy("token").agg(F.max(F.struct("size", "component")).alias("m"), F.count("*").alias("parts"))
    main = kept(main.where("parts > 1").select("token", F.col("m.component").alias("main")), folder, "main")
    own = own.join(main, "token")
    own = kept(own, folder, "open")
    x, y = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
    beyond = F.greatest(F.col("n") - F.col("unique") - F.col("overlap"), F.lit(0))
    # Tokens that one set alone has come first in it and are in no overlap.
    by_place = F.least(x("n") - x("place"), y("n") - y("place")) + F.least(x("ahead"), y("ahead"))
    by_answer = F.least(x("overlap"), y("overlap")) + F.least(x("beyond"), y("beyond"))
    able = _enough(F.least(by_place, by_answer), x("n"), y("n"), percent)
    own = own.withColumns({"ahead": F.col("place") - F.col("unique"), "beyond": beyond, "off": F.col("component") != F.col("main")})
    block = ["token", "n", "place"]
    best = [F.max(c).alias(c) for c in ("ahead", "overlap", "beyond", "off")]
    best += [F.min("component").alias("least"), F.max("component").alias("most")]
    blocks = kept(own.groupBy(*block).agg(*best), folder, "blocks")
    left = blocks.select("token", *(F.col(c).alias(f"x_{c}") for c in blocks.columns[1:]))
    right = blocks.select("token", *(F.col(c).alias(f"y_{c}") for c in blocks.columns[1:]))
    apart = (x("off") | y("off")) & ((x("least") != y("most")) | (x("most") != y("least")))
    read = left.join(right.withColumnRenamed("token", "y_token"), (F.col("token") == F.col("y_token")) & apart & able, "left_semi")
    read = read.select("token", F.col("x_n").alias("n"), F.col("x_place").alias("place"))
    own = kept(own.join(read, block, "left_semi").join(sets.select("node", *MAPS), "node"), folder, "read")
    xs = own.where("off").select("token", *(F.col(c).alias(f"x_{c}") for c in own.columns if c != "token"))
    ys = own.select("token", *(F.col(c).alias(f"y_{c}") for c in own.columns if c != "token"))
    flips = sum((F.bit_count(x(m).bitwiseXOR(y(m))) for m in MAPS), F.lit(0))
    by_map = (x("n") - x("unique") + y("n") - y("unique") - flips) / 2
    once = (x("component") < y("component")) | ((x("component") != y("component")) & ~y("off"))
    pairs = xs.join(ys.withColumnRenamed("token", "y_token"), (F.col("token") == F.col("y_token")) & once & able & _enough(by_map, x("n"), y("n"), percent))
    pairs = pairs.select(
        F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"), (x("n") + y("n")).alias("n_both")
    ).distinct()
    rest = _overlaps(pairs, sets)
    rest = kept(rest.where(100 * F.col("overlap") >= percent * (F.col("n_both") - F.col("overlap"))).select("a", "b"), folder, "rest")
    return each, nodes, near.unionByName(rest)


def _placed(each: DataFrame, nodes: DataFrame, edges: DataFrame, folder: str) -> DataFrame:
    """each with group, a node of the sets that edges reach from the row's, and component_id, their smallest doc_id or its own."""
    final = components(edges, folder, "last")
    # Of a component its smallest node is no row of final.
    whole = final.unionByName(final.select(F.col("component").alias("node"), "component").distinct())
    least = whole.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    whole = kept(whole.join(least, "component").select("node", "component", "component_id"), folder, "whole")
    named = nodes.join(whole, "node", "left").select(
        "n", *SUMS, F.coalesce("component", "node").alias("group"), F.coalesce("component_id", "least").alias("component_id")
    )
    # Rows without words, and those without doc_id, link with nothing.
    place = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return each.join(named, ["n", *SUMS], "left").withColumn("component_id", place)


def linked_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text; other columns are not read).

    Words are lower-cased (A-Z) and end at ASCII white space. A text of fewer words than a shingle has one shingle, of
    all its words; null texts and texts without words have none and link with nothing. component_id is the smallest
    doc_id that links reach, the row's own included. Rows that repeat a doc_id are one document: the links of all its
    texts are its links, and its rows share a component, n_shingles being that of the row. A row without doc_id links
    with nothing and has no component. An empty table gives an empty result. A task holds one batch of texts, or one
    longer text, at a time.
    """
    folder = work_folder(docs.sparkSession, "jaccard")
    each, nodes, links = _links(docs, words, percent, folder)
    # Sets of one document hold together: those that are not its first link with it.
    own = F.struct("n", *SUMS)
    mixed = each.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    mixed = kept(mixed.where("first <> last").select("doc_id", "first.*"), folder, "mixed")
    first = mixed.join(nodes, ["n", *SUMS]).select("doc_id", F.col("node").alias("a"))
    others = each.join(first, "doc_id").join(nodes.drop("least"), ["n", *SUMS]).select("a", F.col("node").alias("b")).where("a <> b")
    found = _placed(each, nodes, links.unionByName(others.distinct()), folder)
    if not mixed.isEmpty():
        # A text without words goes with the document's others.
        least = found.groupBy("doc_id").agg(F.min("component_id").alias("least"))
        found = found.join(least, "doc_id", "left").withColumn("component_id", F.coalesce("least", "component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _own_sets(rows: DataFrame, words: int) -> DataFrame:
    """rows (id, row, text) with n and the sums of each row's set."""

    def named(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            columns = [[], [], []]
            for piece in slices(iter([pa.RecordBatch.from_arrays([pa.array(part)], ["text"])]), "text"):
                values, bounds = shingle_sets(piece.column("text"), words)
                for column, found in zip(columns, (np.diff(bounds), *set_sums(values, bounds))):
                    column.append(found.astype(np.uint64).view(np.int64))
            arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns]
            yield pa.StructArray.from_arrays(arrays, ["n", *SUMS])

    own = F.arrow_udf(named, "n long, sum_a long, sum_b long")
    return rows.withColumn("own", own("text")).select("id", "row", "text", "own.*")


def first_of_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, all columns as they are, without near duplicates: of each component the smallest doc_id stays.

    Texts of one doc_id are apart here unless links join them: each is kept or not by its own component. Of rows of one
    doc_id in one component, or with one text without words, that with the smallest hash of its columns stays. Rows
    without a doc_id stay all. An empty table stays empty. The rows move once, by doc_id, to leave out what goes and what
    is repeated; the latter is judged row by row and added.
    """
    folder = work_folder(docs.sparkSession, "groups")
    each, nodes, links = _links(docs, words, percent, folder)
    found = kept(_placed(each, nodes, links, folder).where("doc_id is not null"), folder, "found")
    goes = F.col("component_id") != F.col("doc_id")
    by_id = found.groupBy(F.col("doc_id").alias("gone")).agg(F.max(goes).alias("goes"), F.count("*").alias("copies"))
    by_id = kept(by_id.where("goes or copies > 1"), folder, "by_id")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), F.struct("*").alias("row"))
    single = rows.join(by_id.select("gone").hint("merge"), F.col("id") == F.col("gone"), "left_anti")
    repeated = kept(by_id.where("copies > 1").select("gone"), folder, "repeated")
    several = _own_sets(rows.join(repeated, F.col("id") == F.col("gone"), "left_semi"), words)
    stay = found.where(~goes).select(F.col("doc_id").alias("id"), "n", *SUMS, "group").distinct()
    several = several.join(stay, ["id", "n", *SUMS])
    blank = F.when(F.col("n") == 0, F.xxhash64("text"))
    hashed = F.xxhash64(*(F.to_json(f"row.`{c}`") if "map<" in k else F.col(f"row.`{c}`") for c, k in docs.dtypes))
    first = several.groupBy("id", "group", blank.alias("blank")).agg(F.min_by("row", hashed).alias("row"))
    return single.select("row").unionByName(first.select("row")).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
