"""Language identification by cross-parsing: the language whose sample text explains a text in fewest phrases.

Training keeps, for each language, the suffix automaton of a bounded sample of its labelled text. A text is parsed from
left to right into the longest phrases that occur in the sample: one walk through the automaton until no transition
fits, then anew from its start. Phrases per character estimate the cross-entropy; the language with fewest wins.

Texts are walked through in chunks side by side, each from the automaton's start, and then mended: the phrase that is open
where a chunk ends goes on into the next, until a phrase of the true parse starts where one of the chunk's own does. From
there both are the same, so the phrases are those of one walk through the whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.llm.common import forget, held_by_worker, kept, slices, work_folder

#: Bound of the sample: texts of a language, and code points taken of each.
SAMPLE_TEXTS = 128
SAMPLE_CHARS = 256

#: Languages whose automata a worker holds at once; more take several passes over the texts.
LANGUAGES = 200

#: Code points of a text that are walked through in one go; the phrases do not depend on it.
CHUNK = 256

#: Parses, of a chunk in a language, that run side by side in a task.
LANES = 1 << 15

#: Bits of an entry that hold the sign; the rest is the next state.
SIGN_BITS = 21
SIGN_MASK = (1 << SIGN_BITS) - 1

#: Share of the table that transitions fill, at most.
FILL = 0.7

UNKNOWN = "und"

#: A text is in no learned language beyond so many times the spread of labelled texts that were not learned from. Prose
#: that holds keys and numbers needs up to 13.5 times (sf0.1).
REACH = 18.0
#: The spread is the excess over the median that so large a share of those texts stays under; the others may be junk.
SPREAD_SHARE = 0.9


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    moves, link, length, last = [{}], [-1], [0], 0
    for sign in text:
        state, at = len(moves), last
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        while at >= 0 and sign not in moves[at]:
            moves[at][sign] = state
            at = link[at]
        if at >= 0:
            to = moves[at][sign]
            if length[at] + 1 == length[to]:
                link[state] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and moves[at].get(sign) == to:
                    moves[at][sign] = copy
                    at = link[at]
                link[to] = link[state] = copy
        last = state
    return moves


class Parser:
    """The automata of all languages in one table, which tells the next state by a sum and one read.

    A state is the number of its first place: the transition by a sign lies that many places on, beside the sign. The places
    of several states mesh, and no two states have one number, so a place that holds the sign belongs to the state. Only
    transitions that exist take room, some two for each code point of a sample, however many signs all languages have
    together, and those of one language lie together. The texts of a sample are closed by a NUL, so that phrases don't run
    from one into the next.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        signs = sorted(set("".join(samples.values())))
        #: Sign 0 is any code point that no sample has.
        self.code = {ord(c): i + 1 for i, c in enumerate(signs)}
        self.width = len(signs) + 1
        roots, tables, end, carry = [], [], 0, np.zeros(0, np.int64)
        for name in self.languages:
            root, table, carry = self._meshed(automaton(samples[name]), end, carry)
            roots.append(root)
            tables.append(table)
            end += len(table)
        self.roots = np.array(roots, np.int64)
        # Places after the last, so that no sum leads out of the table.
        after = np.full(self.width, -1)
        after[: len(carry)] = carry
        self.table = np.concatenate([*tables, after])
        self.codes = np.zeros(0x110000, np.min_scalar_type(self.width))
        for point, code in self.code.items():
            self.codes[point] = code

    def _meshed(self, states: list[dict[str, int]], end: int, carry: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Finds numbers from ``end`` on for all states, and fills the places: the start's number, the places of this
        automaton's numbers, and those after them, as far as its signs reach.

        ``carry`` is what the automaton before it holds from ``end`` on. States draw numbers, those of most signs first; one
        that meets a taken number or place draws again, from more room if that goes on.
        """
        fan = np.fromiter(map(len, states), np.int64, len(states))
        sign = np.fromiter((self.code[ord(c)] for moves in states for c in moves), np.int64, int(fan.sum()))
        to = np.fromiter((x for moves in states for x in moves.values()), np.int64, len(sign))
        first, number = np.cumsum(fan) - fan, np.zeros(len(states), np.int64)
        draw, room, held = np.random.default_rng(0), 0, 0
        table, used = carry.copy(), np.zeros(len(carry), bool)
        claims = np.zeros((2, len(carry)), np.int32)
        for size in np.unique(fan)[::-1]:
            left, rounds = np.flatnonzero(fan == size), 0
            held += len(left) * max(int(size), 1)
            # States of many signs need free room about them: their places come first and lie apart.
            room = max(room, min(int(held / min(FILL, 1.5 / max(size, 1))), int(len(sign) / FILL)) + 1)
            while len(left):
                if rounds >= 64:
                    room += room // 64 + 1
                rounds += 1
                if (more := room + self.width - len(table)) > 0:
                    more += len(table) // 4
                    table = np.concatenate([table, np.full(more, -1)])
                    used = np.concatenate([used, np.zeros(more, bool)])
                    claims = np.concatenate([claims, np.zeros((2, more), np.int32)], axis=1)
                tried = draw.integers(room, size=len(left))
                places = tried[:, None] + sign[first[left][:, None] + np.arange(size)]
                free = np.flatnonzero(~used[tried] & (table[places] < 0).all(axis=1))
                tried, places = tried[free], places[free]
                # Of states that draw the same, one that gets its number and all its places keeps them.
                claims[0, tried], claims[1, places] = free, free[:, None]
                won = (claims[0, tried] == free) & (claims[1, places] == free[:, None]).all(axis=1)
                used[tried[won]], table[places[won]] = True, 0
                number[left[free[won]]] = tried[won]
                left = np.delete(left, free[won])
        number += end
        table[np.repeat(number, fan) - end + sign] = number[to] << SIGN_BITS | sign
        return int(number[0]), table[:room], np.trim_zeros(table[room:] + 1, "b") - 1

    def _next(self, state: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state after each state and sign, and whether there is none; the state then means nothing."""
        to = self.table.take(state + sign)
        none = (to & SIGN_MASK) != sign
        to >>= SIGN_BITS
        return to, none

    def _step(self, state: np.ndarray, sign: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after the signs, and whether a phrase starts with each.

        A sign that fits no transition ends the open phrase and opens the next, or is one by itself if the sample lacks it.
        """
        to, starts = self._next(state, sign)
        stuck = starts.nonzero()
        if len(stuck[0]):
            # Of a table, roots differ by row and signs by column.
            at, own = (root[stuck[0], 0], sign[stuck[1]]) if to.ndim > 1 else (root[stuck], sign[stuck])
            fresh, none = self._next(at, own)
            to[stuck] = np.where(none, at, fresh)
        starts |= state == root
        return to, starts

    def _walked(self, signs: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each chunk (begin, size in signs; longest first) walked through from the start: starts by place, phrases, last states.

        The latter two have a row for each language and a column for each chunk.
        """
        root = self.roots[:, None]
        starts = np.zeros((int(size[0]), len(self.roots), len(size)), bool)
        found = np.zeros(starts.shape[1:], np.int64)
        state = np.repeat(root, len(size), axis=1)
        longer = np.searchsorted(-size, -np.arange(len(starts)))  # chunks longer than each place
        for k, n in enumerate(longer.tolist()):
            state[:, :n], opens = self._step(state[:, :n], signs[begin[:n] + k].astype(np.int64), root)
            starts[k, :, :n] = opens
            found[:, :n] += opens
        return starts, found, state

    def _carry(self, signs, begin, size, starts, rank, own_last, found, chunk, entry) -> np.ndarray:
        """Goes on with the phrases open before the chunks of ``chunk`` (states ``entry``, by language and chunk).

        Counts in ``found``, which are the chunks' own, become the true ones. Returns the chunks' true last states: their own,
        but where a phrase of the true parse never starts with one of the chunk's own.
        """
        language, at = (x.reshape(-1) for x in np.indices(entry.shape))
        state, lane = entry.reshape(-1), chunk[at]
        root, place, most, column = self.roots[language], begin[lane], size[lane], rank[lane]  # columns of starts
        last, k = own_last[:, chunk], 0
        change = np.zeros(entry.shape, np.int64)
        shortest = int(most.min()) if len(most) else 0
        while len(state):
            if k >= shortest:
                ends = most == k
                last[language[ends], at[ends]] = state[ends]
                language, at, column, state, root, place, most = (x[~ends] for x in (language, at, column, state, root, place, most))
                if not len(state):
                    break
                shortest = int(most.min())
            to, opens = self._step(state, signs[place + k].astype(np.int64), root)
            own = starts[k, language, column]
            change[language, at] += opens.astype(np.int64) - own
            on = ~(opens & own)
            language, at, column, state, root, place, most = (x[on] for x in (language, at, column, to, root, place, most))
            k += 1
        found[:, chunk] += change
        return last

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        sizes = np.array([len(x) for x in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        signs = self.codes[points]
        chunks = -(-sizes // CHUNK)
        owner = np.repeat(np.arange(len(texts)), chunks)
        within = (np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)) * CHUNK
        begin = np.repeat(np.cumsum(sizes) - sizes, chunks) + within
        length = np.minimum(CHUNK, sizes[owner] - within)
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        lanes = max(1, LANES // max(len(self.languages), 1))
        before = None  # the true state at the end of the last chunk of the lanes before
        for a in range(0, len(owner), lanes):
            part = slice(a, a + lanes)
            size, own, first = length[part], owner[part], within[part] == 0
            order = np.argsort(-size, kind="stable")
            rank = np.argsort(order, kind="stable")
            starts, by_rank, last_by_rank = self._walked(signs, begin[part][order], size[order])
            plain, own_last = by_rank[:, rank], last_by_rank[:, rank]
            found, last, entry = plain.copy(), own_last.copy(), np.roll(own_last, 1, axis=1)
            if before is not None:
                entry[:, 0] = before
            chunk = np.flatnonzero(~first)
            while len(chunk):
                found[:, chunk] = plain[:, chunk]
                mended = self._carry(signs, begin[part], size, starts, rank, own_last, found, chunk, entry[:, chunk])
                # Chunks after one that ends otherwise than it did are mended again.
                after = chunk[(mended != last[:, chunk]).any(axis=0)] + 1
                last[:, chunk] = mended
                chunk = after[after < len(size)]
                chunk = chunk[~first[chunk]]
                entry[:, chunk] = last[:, chunk - 1]
            before = last[:, -1]
            np.add.at(out, own, found.T)
        return out

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, weight and phrases per character of each text; ties go to the language first in the alphabet.

        A phrase costs about the bits that name its place in the sample, which makes phrase counts code lengths and
        their differences likelihoods. The weight is the sum of all languages' likelihoods in units of the best one's,
        each character weighing the less the longer the text, as the characters of a text are not independent.
        """
        size = np.array([len(x) for x in texts], float).reshape(-1, 1)
        rate = self.phrases(texts) / np.maximum(size, 1)
        weight = np.exp(-(rate - rate.min(axis=1, keepdims=True)) * np.sqrt(size) * 8).sum(axis=1)
        return [self.languages[i] for i in rate.argmin(axis=1)], weight, rate.min(axis=1)


def sample(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """The bounded training text of each language: at most ``chars`` code points of each of at most ``texts`` documents.

    Rows are dealt into ``texts`` cells by a hash of their text, and the smallest hash of each cell and language is
    taken, so the sample depends on neither order nor partitions, and one frequent label costs nothing. Null labels and
    texts take no part. Of a text, the middle is taken.
    """
    rows = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'").withColumn("mark", F.xxhash64("text"))
    rows = rows.withColumn("cell", F.pmod(F.shiftright("mark", 20), F.lit(texts)))
    least = rows.groupBy("lang", "cell").agg(F.min("mark").alias("mark"))
    begin = F.greatest(F.lit(1), F.floor((F.length("text") - chars) / 2)).cast("int")
    taken = rows.join(F.broadcast(least), ["lang", "cell", "mark"]).select(
        "lang", "mark", F.lower(F.substring(F.col("text"), begin, F.lit(chars))).alias("text")
    )
    found: dict[str, list[str]] = {}
    for r in taken.distinct().orderBy("lang", "mark", "text").collect():
        found.setdefault(r["lang"], []).append(r["text"])
    return {k: "".join(x + "\0" for x in v) for k, v in found.items()}


def _judge(spark: SparkSession, samples: dict[str, str]):
    """A function of text columns: struct<lang, weight, rate> by the languages of ``samples``."""
    shared = spark.sparkContext.broadcast(samples)
    key = "parser", zlib.crc32(repr(sorted(samples.items())).encode())

    def judged(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = held_by_worker(key, lambda: Parser(shared.value))
        for part in parts:
            names, weights, rates = [], [], []
            batch = pa.RecordBatch.from_arrays([pa.array(part)], ["text"])
            for piece in slices(iter([batch]), "text"):
                a, b, c = parser.judge([x.lower() for x in piece.column("text").to_pylist()])
                names, weights, rates = names + a, weights + b.tolist(), rates + c.tolist()
            columns = [pa.array(names, pa.string()), pa.array(weights, pa.float64()), pa.array(rates, pa.float64())]
            yield pa.StructArray.from_arrays(columns, ["lang", "weight", "rate"])

    return F.arrow_udf(judged, "lang string, weight double, rate double")


def with_language(docs: DataFrame, samples: dict[str, str], held: int = LANGUAGES) -> DataFrame:
    """Adds lang_pred, lang_score and lang_rate to docs, whose other columns stay (columns of these names are replaced).

    ``und``, score 0 and rate 0: null text, text without a letter, or nothing learned. lang_rate is the number of phrases
    per character in the language predicted, lang_score its share of all languages' likelihoods. Each row is judged by its
    text alone. With more than ``held`` languages the rows are kept in the shared folder between passes of so many each.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_rate")]
    row = [F.col(f"row.`{c}`").alias(c) for c in names]
    text = F.col("text").cast("string")
    known: Column = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.when(known, text).otherwise(F.lit("")).alias("text"), known.alias("known")
    )
    spark, languages, judged = docs.sparkSession, sorted(samples), []
    groups = [languages[i : i + held] for i in range(0, len(languages), held)]
    folder = work_folder(spark, "language") if len(groups) > 1 else ""
    for i, group in enumerate(groups):
        if i:
            rows = kept(rows, folder, f"pass-{i}")
            if i > 1:
                forget(spark, folder, f"pass-{i - 1}")
        judge = _judge(spark, {k: samples[k] for k in group})
        rows = rows.withColumn(f"judged{i}", judge(F.col("text")))
        judged.append(F.col(f"judged{i}"))
    if not judged:
        return rows.select(*row, F.lit(UNKNOWN).alias("lang_pred"), *(F.lit(0.0).alias(c) for c in ("lang_score", "lang_rate")))
    best = F.least(*(F.struct(j["rate"], j["lang"]) for j in judged)) if len(judged) > 1 else F.struct(judged[0]["rate"], judged[0]["lang"])
    rows = rows.withColumn("best", best)
    scale = F.sqrt(F.length(F.lower("text")).cast("double")) * 8
    total = sum((j["weight"] * F.exp((F.col("best.rate") - j["rate"]) * scale) for j in judged), F.lit(0.0))
    return rows.select(
        *row,
        F.when(F.col("known"), F.col("best.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("known"), 1 / total).otherwise(0.0).alias("lang_score"),
        F.when(F.col("known"), F.col("best.rate")).otherwise(0.0).alias("lang_rate"),
    )


def spreads(judged: DataFrame, share: float = SPREAD_SHARE) -> DataFrame:
    """language, median, even and by_root of rows (lang, lang_pred, lang_rate, size) with labels that were not learned from.

    For each predicted language: the median rate, and the excess over it that ``share`` of the rows stays under, as it is
    and times the root of the text's size, for what evens out along a text. Rows whose label is another language take no
    part, nor do null ones. A language of -null- is all of them together, for those without labelled rows left.
    """
    rows = judged.where((F.col("lang") == F.col("lang_pred")) & (F.col("size") > 0))
    rows = rows.select(F.explode(F.array("lang_pred", F.lit(None).cast("string"))).alias("language"), "lang_rate", "size")
    median = rows.groupBy("language").agg(F.percentile_approx("lang_rate", F.lit(0.5), F.lit(1000)).alias("median"))
    same = F.col("language").eqNullSafe(F.col("of"))
    # One row for each language.
    over = rows.join(F.broadcast(median.withColumnRenamed("language", "of")), same).drop("of")
    over = over.withColumn("over", F.col("lang_rate") - F.col("median"))
    at = F.lit(share), F.lit(1000)
    return over.groupBy("language", "median").agg(
        F.percentile_approx("over", *at).alias("even"), F.percentile_approx(F.col("over") * F.sqrt("size"), *at).alias("by_root")
    )


def accepted(docs: DataFrame, label: str = "lang", reach: float = REACH, held: int = LANGUAGES) -> DataFrame:
    """The rows of docs, all columns as they are, whose text is in one of the languages learned from ``label``.

    Rows go whose text is null or without a letter, and those that need more phrases than labelled texts of the language
    predicted do: over its median by ``reach`` times the spread, which is the wider the shorter the text. Languages are
    learned from one half of the labelled texts, by a hash of the text, and spreads come from the other, so copies of a
    text are in one half. A language without texts in the other half has the spread of all; without any, only texts
    without a letter go. Rows are judged one by one, so ties and repeated rows don't matter; an empty table stays empty.
    """
    text = F.col("text").cast("string")
    half = F.shiftrightunsigned(F.xxhash64(text), 63)
    rows = docs.select(
        F.struct("*").alias("row"), text.alias("text"), F.col(f"`{label}`").cast("string").alias("lang"), half.alias("half")
    )
    samples = sample(rows.where("half = 0").select("text", "lang"))
    judged = with_language(rows, samples, held).withColumn("size", F.length("text"))
    folder = work_folder(docs.sparkSession, "accepted")
    judged = kept(judged.drop("text"), folder, "judged")
    found = kept(spreads(judged.where("half = 1")), folder, "spreads")
    # One row for each learned language.
    spread = F.broadcast(found.withColumnsRenamed({c: f"own_{c}" for c in found.columns}))
    overall = {r["language"]: r for r in found.where("language is null").collect()}.get(None)
    joined = judged.join(spread, F.col("lang_pred") == F.col("own_language"), "left")
    own = lambda c: F.coalesce(F.col(f"own_{c}"), F.lit(overall[c] if overall else None).cast("double"))
    most = own("median") + F.greatest(own("even"), own("by_root") / F.sqrt("size"), F.lit(0.0)) * reach
    letters = F.coalesce(F.col("row.text").cast("string").rlike(r"\p{L}"), F.lit(False))
    good = letters & ((F.col("lang_pred") != UNKNOWN) if samples else F.lit(True))
    strange = F.coalesce(F.col("lang_rate") > most, F.lit(False))
    return joined.where(good & ~strange).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
