"""Secrets in texts: fixed patterns, and tokens that look random and not like anything that is written otherwise.

All is built-in functions. Each long token is tested twice.

Against randomness, in the alphabet of its inferred encoding, by a battery whose scores are standard normal for random strings:

    uniformity   chi-squared of its sign counts against equal shares, standardised by its exact mean and variance
    runs         number of runs of signs in the upper or lower half of the alphabet, standardised (Wald-Wolfowitz)
    serial       correlation of neighbouring signs' places in the alphabet, standardised

The sum of their squares must stay under MOST_SCORE (uniformity counts only where signs are too uneven).

Against ordinary writing, by the serial test of signs that follow each other: with the chances of each pair of signs in
ordinary tokens (words, names, numbers), the bits by which a random string of the encoding explains the token better. An
ordinary token gets x bits or more with a chance of 2**-x at most (Markov's inequality), whatever its length and
alphabet, letters alone included. Words do not follow the pair chances exactly, so the bits are reduced, for each length
class, by what makes the bound hold for the corpus' own words of that length or shorter. Benjamini-Hochberg on these
chances within each length class then bounds the share of ordinary tokens among those reported.

The pair chances are counted over the corpus' different words of WORD_CHARS letters or more and its different ordinary
tokens, on top of fixed chances of kinds of signs, which alone decide where a corpus has few.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.llm import spans
from bankmetrics.llm.common import kept, work_folder

# The base patterns, written so that they need no backtracking.
ASSIGN = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9+/_.=-]++"
ASSIGNED = r"[A-Za-z0-9+/_.=-]{6,}$"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ["assign", "access", "hex"]

#: Tokens that are tested.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
RANDOM = "random"

#: Ordinary tokens: letters alone, digits alone, or words and numbers with signs between them, as names of files are.
ORDINARY = r"^(?:[A-Za-z]++|[0-9]++)(?:[_/+-]++(?:[A-Za-z]++|[0-9]{1,8}+))*+=*$"

#: Encodings by the first that fits: its signs in order, and a pattern of its own signs.
ENCODINGS = [
    ("0123456789abcdef", "^[0-9a-f]*$"),
    ("0123456789ABCDEF", "^[0-9A-F]*$"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "^[A-Z2-7]*$"),
    ("0123456789abcdefghijklmnopqrstuvwxyz", "^[0-9a-z]*$"),
    ("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "^[0-9A-Z]*$"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "^[A-Za-z0-9]*$"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", "^[A-Za-z0-9_-]*$"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "^[A-Za-z0-9+/]*$"),
]
LETTERS = [
    ("abcdefghijklmnopqrstuvwxyz", "^[a-z]*$"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "^[A-Z]*$"),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "^[A-Za-z]*$"),
]

#: Length classes start here.
CLASSES = [16, 20, 24, 32, 48]

#: The battery's score of random strings is over this once in some hundreds.
MOST_SCORE = 20.0

#: Signs by their number: lower and upper case, digits, others. Digits are one symbol of pairs, and so are the others.
SIGNS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
KIND_OF = [("lower", 26, 26), ("upper", 26, 26), ("digit", 1, 10), ("other", 1, 4)]
SYMBOLS = 54
START = SYMBOLS

# Chances of the kind of a sign after one of another kind, in ordinary tokens.
KIND_CHANCES = {
    "lower": {"lower": 0.95, "upper": 0.02, "digit": 0.01, "other": 0.02},
    "upper": {"lower": 0.60, "upper": 0.35, "digit": 0.02, "other": 0.03},
    "digit": {"lower": 0.05, "upper": 0.03, "digit": 0.87, "other": 0.05},
    "other": {"lower": 0.60, "upper": 0.15, "digit": 0.20, "other": 0.05},
    "start": {"lower": 0.70, "upper": 0.20, "digit": 0.07, "other": 0.03},
}

#: Counted pairs that the fixed chances weigh as much as.
PRIOR = 20.0

#: Of the words that reduce the bits, the share with most bits that is left out: it may be secrets.
TRIMMED = 0.05

#: Letters of a word that counts for the pair chances.
WORD_CHARS = 10

#: Bits are kept as whole numbers up to this many.
MOST_BITS = 300

FALSE_SHARE = 0.05


def base_spans(text: Column) -> Column:
    """assign, access and hex spans of ``text``, which may not be null, in order."""
    # A value of six or more signs: what follows the first [:=] of the match, without quotes and spaces before it.
    value = lambda s: F.regexp_replace(s["value"], r"^[^:=]*[:=]\x20*[\"']?", "")
    assign = F.filter(spans.located(text, ASSIGN, "assign"), lambda s: F.length(value(s)) >= 6)
    found = F.concat(assign, spans.located(text, ACCESS, "access"), spans.located(text, HEX, "hex"))
    return spans.in_order(found, KINDS)


def _form(value: Column) -> Column:
    """struct<body, signs>: the token without padding, and the alphabet of its encoding."""
    body = F.regexp_replace(value, "=+$", "")
    fit = F.lit(ENCODINGS[-2][0] + "+/")
    for signs, own in reversed([ENCODINGS[0], ENCODINGS[1], *LETTERS, *ENCODINGS[2:]]):
        fit = F.when(body.rlike(own), F.lit(signs)).otherwise(fit)
    return F.struct(body.alias("body"), fit.alias("signs"))


def _score(form: Column) -> Column:
    """The battery's score of struct<body, signs>."""

    def of(x: Column) -> Column:
        """x: struct<at: places of the signs in the alphabet, n, k>, all double."""
        at, n, k = x["at"], x["n"], x["k"]
        squares = F.aggregate(
            F.array_distinct(at),
            F.lit(0.0),
            lambda acc, c: acc + F.pow(F.size(F.filter(at, lambda y: y == c)), F.lit(2)),
        )
        uniform = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
        start = F.struct(*(F.lit(0.0).alias(c) for c in ("s", "ss", "sp", "up", "runs")), F.lit(None).cast("double").alias("last"))

        def add(a: Column, c: Column) -> Column:
            upper = F.when(c >= k / 2, 1.0).otherwise(0.0)
            before = F.when(a["last"] >= k / 2, 1.0).otherwise(0.0)
            return F.struct(
                (a["s"] + c).alias("s"),
                (a["ss"] + c * c).alias("ss"),
                (a["sp"] + F.coalesce(a["last"] * c, F.lit(0.0))).alias("sp"),
                (a["up"] + upper).alias("up"),
                (a["runs"] + F.when(a["last"].isNull() | (upper != before), 1.0).otherwise(0.0)).alias("runs"),
                c.alias("last"),
            )

        def tests(t: Column) -> Column:
            # With all signs in one half there is one run; it counts as the least number of a balanced string.
            up = F.when((t["up"] == 0) | (t["up"] == n), n / 2).otherwise(t["up"])
            mean = 1 + 2 * up * (n - up) / n
            runs = (t["runs"] - mean) / F.sqrt(F.greatest(F.lit(0.25), (mean - 1) * (mean - 2) / (n - 1)))
            # Circular, so that the sums of both neighbours are the same.
            product = t["sp"] + t["last"] * at[0]
            spread = t["ss"] - t["s"] * t["s"] / n
            serial = F.coalesce(F.try_divide(product - t["s"] * t["s"] / n, spread), F.lit(1.0)) * F.sqrt(n)
            return F.struct(runs.alias("runs"), serial.alias("serial"))

        both = spans.let(
            spans.let(F.aggregate(at, start, add), tests),
            lambda b: F.pow(b["runs"], F.lit(2)) + F.pow(b["serial"], F.lit(2)),
        )
        return F.pow(F.greatest(uniform, F.lit(0.0)), F.lit(2)) + both

    at = F.transform(
        F.filter(F.split(form["body"], ""), lambda c: c != ""), lambda c: F.instr(form["signs"], c).cast("double") - 1
    )
    sized = spans.let(
        at,
        lambda x: F.struct(
            x.alias("at"), F.size(x).cast("double").alias("n"), F.length(form["signs"]).cast("double").alias("k")
        ),
    )
    return spans.let(sized, of)


@dataclass(frozen=True)
class Limits:
    """What limits() learns: bits of each pair of symbols in ordinary tokens, and the fewest bits reported by length class."""

    pairs: tuple[float, ...]
    least: tuple[tuple[int, int], ...] = ()


def _kinds() -> list[tuple[str, int]]:
    """Kind of each symbol, and how many signs it stands for."""
    return [(kind, signs // symbols) for kind, symbols, signs in KIND_OF for _ in range(symbols)]


def pair_bits(counts: dict[tuple[int, int], int]) -> tuple[float, ...]:
    """-log2 of the chance of each sign after each symbol or the start, from counts of pairs of symbols."""
    kinds, share = _kinds(), {kind: symbols for kind, symbols, _ in KIND_OF}
    bits = []
    for before in range(SYMBOLS + 1):
        chances = KIND_CHANCES["start" if before == START else kinds[before][0]]
        total = sum(counts.get((before, s), 0) for s in range(SYMBOLS)) + PRIOR
        for symbol, (kind, signs) in enumerate(kinds):
            prior = PRIOR * chances[kind] / share[kind]
            bits.append(-math.log2((counts.get((before, symbol), 0) + prior) / total / signs))
    return tuple(bits)


def _symbols(body: Column) -> Column:
    """The symbol of each sign of a token."""

    def symbol(c: Column) -> Column:
        at = F.instr(F.lit(SIGNS), c) - 1
        return F.when(at < 52, at).when(at < 62, 52).otherwise(53)

    return F.transform(F.filter(F.split(body, ""), lambda c: c != ""), symbol)


def _bits(form: Column, pairs: tuple[float, ...]) -> Column:
    """Bits by which a random string of its encoding explains struct<body, signs> better than ordinary writing does."""
    table = F.lit(list(pairs))

    def add(state: Column, symbol: Column) -> Column:
        more = F.get(table, state["last"] * SYMBOLS + symbol)
        return F.struct((state["bits"] + more).alias("bits"), symbol.alias("last"))

    start = F.struct(F.lit(0.0).alias("bits"), F.lit(START).alias("last"))
    return F.aggregate(_symbols(form["body"]), start, add)["bits"] - F.length(form["body"]) * F.log2(F.length(form["signs"]).cast("double"))


def _level(value: Column) -> Column:
    level = F.lit(0)
    for i, least in enumerate(CLASSES):
        level = F.when(F.length(value) >= least, i).otherwise(level)
    return level


def tokens(text: Column, base: Column) -> Column:
    """Long tokens of ``text`` apart from the base spans."""
    return spans.apart(spans.located(text, TOKEN, RANDOM), base)


def judged(value: Column, pairs: tuple[float, ...]) -> Column:
    """struct<level, bits, random>: a token's length class, its whole bits from 0, and whether the battery takes it as random."""

    def of(form: Column) -> Column:
        bits = F.least(F.greatest(F.floor(_bits(form, pairs)), F.lit(0)), F.lit(MOST_BITS)).cast("int")
        return F.struct(
            _level(value).alias("level"), bits.alias("bits"), F.when(bits > 0, _score(form) <= MOST_SCORE).otherwise(False).alias("random")
        )

    return spans.let(_form(value), of)


def reduction(words: dict[int, int], trimmed: float = TRIMMED) -> float:
    """The bits too many of words (bits to their number): with so many less, 2**-bits bounds the share of words beyond."""
    total, beyond, most = sum(words.values()), 0, 0.0
    for bits in sorted(words, reverse=True):
        beyond += words[bits]
        if beyond >= trimmed * total and bits:
            most = max(most, bits + math.log2(beyond / total))
    return most


def fewest_bits(tests: dict[int, int], others: int, less: float, false_share: float = FALSE_SHARE) -> int | None:
    """Benjamini-Hochberg: the fewest bits reported, of ``tests`` (bits to number) and ``others`` that can't be reported."""
    total, reported, found = sum(tests.values()) + others, 0, None
    for bits in sorted(tests, reverse=True):
        reported += tests[bits]
        if 2.0 ** -(bits - less) * total <= false_share * reported:
            found = bits
    return found


def limits(docs: DataFrame, false_share: float = FALSE_SHARE) -> Limits:
    """Pair chances of ordinary tokens, and the fewest bits reported in each length class, from ``text`` of all rows.

    Null texts have no tokens; rows count each, so copies weigh as often as they stand, but pairs and words are counted
    once for each different token. Equal bits are reported together. An empty table reports nothing. The different
    tokens are kept in the shared folder. What comes to the driver is a count for each pair of 54 symbols and for each of
    300 numbers of bits in each of five length classes.
    """
    folder = work_folder(docs.sparkSession, "secrets")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"[A-Za-z]{{{WORD_CHARS},}}+"), F.lit(0)))
    both = F.concat(
        F.transform(tokens(text, base_spans(text)), lambda s: F.struct(s["value"].alias("value"), F.lit(1).alias("n"))),
        F.transform(words, lambda w: F.struct(w.alias("value"), F.lit(0).alias("n"))),
    )
    # n is the number of tokens; words count as values alone.
    every = docs.select(F.inline(both)).groupBy("value").agg(F.sum("n").alias("n"))
    every = kept(every, folder, "tokens")
    found = every.where("n > 0")
    ordinary = every.where(F.col("value").rlike(ORDINARY)).select(_symbols(F.regexp_replace("value", "=+$", "")).alias("s"))
    each = ordinary.select(F.explode(F.arrays_zip(F.concat(F.array(F.lit(START)), "s").alias("a"), F.col("s").alias("b"))).alias("p"))
    counted = each.where("p.b is not null").groupBy("p.a", "p.b").agg(F.count("*").alias("n")).collect()
    pairs = pair_bits({(r["a"], r["b"]): r["n"] for r in counted})
    word = F.regexp_replace("value", "=+$", "").rlike("^[A-Za-z]*$").alias("word")
    scored = found.select("n", word, judged(F.col("value"), pairs).alias("j")).select("n", "word", "j.*")
    grouped = scored.groupBy("level", "bits", "random", "word").agg(F.sum("n").alias("n"), F.count("*").alias("different")).collect()
    least, words = [], {}
    for level in range(len(CLASSES)):
        own = [r for r in grouped if r["level"] == level]
        for r in own:
            if r["word"]:  # of this length class or a shorter one
                words[r["bits"]] = words.get(r["bits"], 0) + r["different"]
        tests = {}
        for r in own:
            if r["random"]:
                tests[r["bits"]] = tests.get(r["bits"], 0) + r["n"]
        others = sum(r["n"] for r in own if not r["random"])
        bits = fewest_bits(tests, others, reduction(words), false_share)
        if bits is not None:
            least.append((level, bits))
    return Limits(pairs, tuple(least))


def with_secrets(docs: DataFrame, limit: Limits) -> DataFrame:
    """Adds ``base`` and ``secrets`` (base spans and random tokens, in order) to docs; other columns stay.

    Null is the empty text, which has no spans. Rows are judged one by one, so ties and repeated rows don't matter.
    Columns named base or secrets are replaced. A long text's tokens are one row's array.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.withColumn("base", base_spans(text))
    if not limit.least:
        return found.withColumn("secrets", F.col("base"))
    least = lambda j: F.coalesce(
        *(F.when(j["level"] == level, F.lit(bits)) for level, bits in limit.least), F.lit(MOST_BITS + 1)
    )
    good = lambda s: spans.let(judged(s["value"], limit.pairs), lambda j: j["random"] & (j["bits"] >= least(j)))
    more = F.transform(
        F.filter(tokens(text, F.col("base")), good),
        lambda s: F.struct(s["start"], s["end"], s["kind"], F.lit("").alias("value")),
    )
    return found.withColumn("secrets", spans.in_order(F.concat(F.col("base"), more), [*KINDS, RANDOM]))


def redacted(docs: DataFrame, limit: Limits) -> DataFrame:
    """docs with each secret in ``text`` replaced by a mark of its kind; null texts stay null."""
    marks = {k: f"[{k.upper()}]" for k in [*KINDS, RANDOM]}
    found = with_secrets(docs.select(F.col("text"), F.struct("*").alias("row")), limit)
    text = spans.replaced(F.col("text").cast("string"), F.col("secrets"), marks)
    return found.select(*((text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
