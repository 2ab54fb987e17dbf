"""Spelling variants: words one code point apart, found by pairs of trie nodes.

A word's prefixes are nodes of a trie, its suffixes nodes of the trie of reversed words. A node is numbered from its
parent's number and the sign that leads to it. A word is the pair (prefix node, suffix node) at each of its positions. Leave
out one sign, and the nodes around the gap are a pair again:

    two words with the same pair around a gap differ by a replaced sign there,
    a word whose gap has the pair of a whole word differs from it by an inserted sign.

So rows (prefix node, suffix node) of all gaps and all whole words, grouped by these two integers, hold all neighbours.
Numbers are taken modulo a prime, so groups of two rows or more are told apart once more by their letters, and the result
is exact. A group has at most one whole word and one word for each sign of the alphabet, so no group is large, and no
neighbour pair is ever made twice: within a run of equal signs only the first counts as left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bankmetrics.llm.common import kept, slices, work_folder

#: Letters of a word, once A to Z are lower-cased.
LETTERS = r"a-zÀ-ÿ"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5

PRIME = (1 << 61) - 1
#: Bases of the numbers of prefix and suffix nodes.
BASES = (911382323, 972663749)

#: Different words that a task counts before it hands on their counts, and code points of a text scanned at once.
HELD_WORDS = 1 << 18
SCAN_CHARS = 1 << 20
#: Rows of trie nodes handed on at once.
NODE_ROWS = 1 << 16


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that end between words."""
    at, gap = 0, re.compile(f"[^{LETTERS}]")
    while at < len(text):
        found = gap.search(text, at + SCAN_CHARS)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, damage: int = 0) -> DataFrame:
    """word and n, partial sums by task: occurrences of words of at least ``min_chars`` code points in docs (doc_id, text).

    Words are maximal runs of letters (A to Z and the Latin letters of U+00C0 to U+00FF), lower-cased in A to Z alone. With
    ``damage``, a word loses a code point in a document where that divides h, the crc32 of "doc_id:word": the one at h
    modulo its length. Null texts have no words; a null doc_id counts as empty; repeated rows count each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = re.compile(f"[{LETTERS}]{{{min_chars},}}")
        totals: Counter[str] = Counter()

        def found() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["word", "n"]
            )
            totals.clear()
            return out

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text.lower() if text.isascii() else text.encode().translate(LOWER).decode()
                start = zlib.crc32(f"{doc_id}:".encode())
                for piece in _pieces(text):
                    if not damage:
                        totals.update(run.findall(piece))
                        continue
                    for word, n in Counter(run.findall(piece)).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % damage == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_chars:
                                continue
                        totals[word] += n
                    if len(totals) > HELD_WORDS:
                        yield found()
            if len(totals) > HELD_WORDS:
                yield found()
        yield found()

    rows = docs.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(count, "word string, n long")


def node_numbers(word: str) -> tuple[list[int], list[int]]:
    """The numbers of the nodes of all prefixes and of all suffixes, the empty ones included."""
    forward, backward, codes = [0], [0], [ord(c) for c in word]
    for code in codes:
        forward.append((forward[-1] * BASES[0] + code) % PRIME)
    for code in reversed(codes):
        backward.append((backward[-1] * BASES[1] + code) % PRIME)
    return forward, backward[::-1]


def trie_pairs(words: DataFrame) -> DataFrame:
    """prefix, suffix (node numbers), at (length of the prefix), id, gap and first, of every position of words (id, word).

    Without ``gap`` the pair is the whole word; else the sign after the prefix is left out, and ``first`` says that it
    differs from the sign before it.
    """
    kind = "prefix long, suffix long, at int, id long, gap boolean, first boolean"
    names = [field.split()[0] for field in kind.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_()]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []

        def found() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
            rows.clear()
            return out

        for batch in batches:
            for id, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist()):
                prefixes, suffixes = node_numbers(word)
                for at in range(len(word) + 1):
                    rows.append((prefixes[at], suffixes[at], at, id, False, False))
                    if at < len(word):
                        rows.append((prefixes[at], suffixes[at + 1], at, id, True, not at or word[at] != word[at - 1]))
                    if len(rows) >= NODE_ROWS:
                        yield found()
        if rows:
            yield found()

    return words.select("id", "word").mapInArrow(pairs, kind)


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near and best (struct<less, word>, less = -n) of each word of words (id, word, n) that has a near word.

    Near words differ by one inserted, deleted or replaced code point. best is the near word of largest n, ties to the
    smallest in code-point order. Words must differ from each other.
    """
    pairs = trie_pairs(words)
    met = F.count("*").over(Window.partitionBy("prefix", "suffix"))
    found = pairs.withColumn("met", met).where("met > 1").drop("prefix", "suffix", "met").join(words, "id")
    left = F.concat(F.substring("word", F.lit(1), F.col("at")), F.substring(F.col("word"), F.col("at") + 2, F.length("word")))
    letters = F.when(F.col("gap"), left).otherwise(F.col("word"))
    member = F.struct((-F.col("n")).alias("less"), "word", "id", "gap", "first")
    # At most one word for each sign of the alphabet and one whole word.
    groups = found.groupBy("at", letters.alias("letters")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    groups = groups.where(F.size("members") > 1)

    def seen(m):
        near = F.filter(
            "members",
            lambda x: (x["id"] != m["id"])
            & ((x["gap"] & m["gap"]) | (x["gap"] & x["first"] & ~m["gap"]) | (m["gap"] & m["first"] & ~x["gap"])),
        )
        return F.struct(
            m["id"].alias("id"),
            F.size(near).alias("near"),
            F.transform(F.slice(near, 1, 1), lambda x: F.struct(x["less"], x["word"])).alias("best"),
        )

    each = groups.select(F.explode(F.transform("members", seen)).alias("m")).select("m.*").where("near > 0")
    return each.groupBy("id").agg(F.sum("near").alias("n_near"), F.min(F.col("best")[0]).alias("best"))


def roots(links: DataFrame, folder: str, rounds: int) -> DataFrame:
    """word and root for links (word, form): the last word that forms lead to, in ``rounds`` doublings of the step."""
    found = kept(links.select("word", F.col("form").alias("root")), folder, "roots-0")
    for i in range(1, rounds + 1):
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = found.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"))
        found = kept(step, folder, f"roots-{i}")
    return found


def grouped(counts: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, n, form, root, n_near and form_n of all words of counts (word, n) with at least ``min_count`` occurrences.

    Rows of one word are added up. A word's form is its near word of largest n (ties: the smallest in code-point order) if
    that is at least ``ratio`` times its own, else null; root follows forms to the last word. Null words take no part; an
    empty table gives an empty result. Other columns are not read. ``ratio`` is over 1, so forms have no cycle.
    """
    if ratio < 2:
        raise ValueError(f"ratio {ratio}: forms could lead back")
    folder = work_folder(counts.sparkSession, "variants")
    words = counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    words = kept(words.withColumn("id", F.monotonically_increasing_id()), folder, "words")
    best = F.col("best")
    joined = words.join(neighbours(words), "id", "left")
    stands = -best["less"] >= ratio * F.col("n")
    formed = joined.select(
        "word",
        "n",
        F.when(stands, best["word"]).alias("form"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(stands, -best["less"]).alias("form_n"),
    )
    formed = kept(formed, folder, "formed")
    # Each step along forms multiplies n by the ratio, so the largest n bounds how many there are.
    most, steps, rounds = formed.agg(F.max("form_n")).first()[0] or 0, 0, 0
    while max(min_count, 1) * ratio ** (steps + 1) <= most:
        steps += 1
    while 1 << rounds < steps:
        rounds += 1
    last = roots(formed.where("form is not null").select("word", "form"), folder, rounds)
    return formed.join(last, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )
