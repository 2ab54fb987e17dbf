"""Fill-in-middle texts, cut at token boundaries that a piecewise-linear rank index locates.

A token is a run of signs that are no white space with the white space before it, or the white space at the end. The
offsets of all boundaries of a text grow almost evenly with their number, so a few line segments tell each offset up to
ERROR code points: a segment starts at a boundary and is carried on while one slope keeps all boundaries within the error
(a cone of slopes that each boundary narrows). One byte for each boundary stores what the line misses. The offset of a cut
is then the line's prediction plus that byte, exact, without another scan of the text: an index that is kept serves any
number of seeds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.llm.common import slices

#: Largest miss of a segment. Rounding adds less than one, and a miss is kept in a byte.
ERROR = 126

#: Boundaries that are tried at once; doubled while they fit one segment.
BLOCK = 256

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

INDEX = "struct<n:long,firsts:array<long>,bases:array<long>,slopes:array<double>,misses:binary>"


def boundaries(text: str) -> np.ndarray:
    """Code-point offsets of all token boundaries: 0, and the end of each token."""
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    blank = (signs == 32) | ((signs >= 9) & (signs <= 13))
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.concatenate([[0], ends, [len(signs)]]) if len(signs) else np.zeros(1, np.int64)


def segments(offsets: np.ndarray, error: int = ERROR) -> tuple[list[int], list[float]]:
    """The number of the first boundary of each segment, and its slope."""
    firsts, slopes, at = [], [], 0
    while at < len(offsets):
        low, high, reach, block = 0.0, np.inf, at + 1, BLOCK
        while reach < len(offsets):
            run = np.arange(reach - at, min(reach + block, len(offsets)) - at)
            rise = offsets[at + run] - offsets[at]
            lows = np.maximum.accumulate(np.maximum((rise - error) / run, low))
            highs = np.minimum.accumulate(np.minimum((rise + error) / run, high))
            fit = int(np.searchsorted(lows > highs, True))  # once a cone is empty it stays so
            if fit:
                low, high, reach = lows[fit - 1], highs[fit - 1], reach + fit
            if fit < len(run):
                break
            block *= 2
        firsts.append(at)
        slopes.append(float(low + high) / 2 if high < np.inf else 0.0)
        at = reach
    return firsts, slopes


def index_of(text: str, error: int = ERROR) -> tuple[int, list[int], list[int], list[float], bytes]:
    """n, firsts, bases, slopes and misses of a text: tokens, segments, and one byte for each boundary."""
    offsets = boundaries(text)
    firsts, slopes = segments(offsets, error)
    starts = np.array(firsts, np.int64)
    size = np.diff(np.append(starts, len(offsets)))
    run = np.arange(len(offsets)) - np.repeat(starts, size)
    line = np.repeat(offsets[starts], size) + np.floor(np.repeat(slopes, size) * run + 0.5).astype(np.int64)
    return len(offsets) - 1, firsts, offsets[starts].tolist(), slopes, (offsets - line + 128).astype(np.uint8).tobytes()


def boundary_index(text: Column) -> Column:
    """The rank index of each text, as a struct. A null text is the empty one: no token, one boundary.

    A task holds one slice of texts at a time and some 40 bytes for each code point of one text, the longest included.
    """

    def indexed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary()]
        for part in parts:
            found = []
            for piece in slices(iter([pa.RecordBatch.from_arrays([pa.array(part)], ["text"])]), "text"):
                found += [index_of(x) for x in piece.column("text").to_pylist()]
            columns = zip(*found) if found else [[]] * len(kinds)
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            yield pa.StructArray.from_arrays(arrays, ["n", "firsts", "bases", "slopes", "misses"])

    return F.arrow_udf(indexed, INDEX)(F.coalesce(text.cast("string"), F.lit("")))


def offset_of(index: Column, rank: Column) -> Column:
    """The code-point offset of boundary ``rank`` (0 to n): the segment's prediction, corrected by the stored miss."""
    segment = F.size(F.filter(index["firsts"], lambda first: first <= rank))
    run = rank - F.element_at(index["firsts"], segment)
    line = F.element_at(index["bases"], segment) + F.floor(F.element_at(index["slopes"], segment) * run + F.lit(0.5))
    miss = F.conv(F.hex(F.substring(index["misses"], (rank + 1).cast("int"), F.lit(1))), 16, 10).cast("long") - 128
    return line + miss


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the first groups of sha256("seed:key"); a null key is the empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def with_fill_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, key: str = "doc_id", index: str | None = None
) -> DataFrame:
    """Adds n, form, prefix_chars, middle_chars and fim to docs; other columns stay, columns of these names are replaced.

    Of the texts that are neither empty nor hold a mark, ``percent`` out of 100 keys are cut in three at two boundaries
    that the key draws, ``spm_percent`` of them with the suffix first; the others stay plain, and their cuts are null.
    Null is the empty text. Each row is cut by its key and text alone, so equal rows come out equal; rows without a key
    draw as one key. ``index`` names a column with boundary_index() of the text; without it the index is made here.
    """
    names = [c for c in docs.columns if c not in ("n", "form", "prefix_chars", "middle_chars", "fim")]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.array(*draws(F.col(f"`{key}`"), seed)).alias("h"),
        (F.col(f"`{index}`") if index else boundary_index(F.col("text"))).alias("index"),
    )
    h = F.col("h")
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= percent)
    form = F.when(plain, PLAIN).when(h[3] % 100 < spm_percent, SPM).otherwise(PSM)
    n = F.col("index")["n"]
    cuts = [h[i] % (n + 1) for i in (0, 1)]
    cut = rows.select(
        "row",
        "text",
        n.alias("n"),
        form.alias("form"),
        *(F.when(~plain, offset_of(F.col("index"), f(*cuts))).alias(c) for f, c in ((F.least, "begin"), (F.greatest, "end"))),
    )
    begin, end = F.col("begin").cast("int"), F.col("end").cast("int")
    prefix = F.substring(F.col("text"), F.lit(1), begin)
    middle = F.substring(F.col("text"), begin + 1, end - begin)
    suffix = F.substring(F.col("text"), end + 1, F.length("text"))
    fim = (
        F.when(F.col("form") == PLAIN, F.col("text"))
        .when(F.col("form") == PSM, F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return cut.select(
        *(F.col(f"row.`{c}`").alias(c) for c in names),
        "n",
        "form",
        F.col("begin").alias("prefix_chars"),
        (F.col("end") - F.col("begin")).alias("middle_chars"),
        fim.alias("fim"),
    )


def restored(fim: Column, form: Column) -> Column:
    """The text that ``fim`` was made of. No cut text holds a mark, so each mark stands once."""
    head, middle = F.substring_index(fim, MIDDLE, 1), F.substring_index(fim, MIDDLE, -1)

    def parts(first: str, second: str) -> tuple[Column, Column]:
        before = F.substring_index(head, second, 1)
        return F.substring(before, F.lit(len(first) + 1), F.length(before)), F.substring_index(head, second, -1)

    prefix, suffix = parts(PREFIX, SUFFIX)
    last, first = parts(SUFFIX, PREFIX)
    return F.when(form == PSM, F.concat(prefix, middle, suffix)).when(form == SPM, F.concat(first, middle, last)).otherwise(fim)
