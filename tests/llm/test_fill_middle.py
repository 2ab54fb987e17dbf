"""Fill-in-middle texts, against a scan of the text by the token pattern."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bankmetrics.llm import fill_middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, seed=42, percent=50, spm_percent=80):
    """n, form, prefix_chars, middle_chars and output, without an index."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    ends = [0] + [m.end() for m in TOKEN.finditer(text)]
    n = len(ends) - 1
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    a, b = sorted((ends[h[0] % (n + 1)], ends[h[1] % (n + 1)]))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_percent:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\xa0ab<>é😀", max_size=60))
def test_boundaries_are_the_ends_of_tokens(text):
    assert fill_middle.boundaries(text).tolist() == [0] + [m.end() for m in TOKEN.finditer(text)]


def offset(index, rank):
    """The offset of a boundary from its segment and its stored miss."""
    n, firsts, bases, slopes, misses = index
    k = np.searchsorted(firsts, rank, "right") - 1
    return bases[k] + int(np.floor(slopes[k] * (rank - firsts[k]) + 0.5)) + misses[rank] - 128


@pytest.mark.parametrize("error", [1, 4, fill_middle.ERROR])
def test_every_boundary_is_exact_and_misses_are_bounded(error):
    draw = random.Random(error)
    texts = ["", " ", "a", "a" * 5000, "ab " * 4000, " ".join("x" * draw.randrange(1, 9) for _ in range(20_000))]
    texts.append(" ".join("x" * draw.choice((1, 1, 1, 2000)) for _ in range(900)))
    for text in texts:
        index, expected = fill_middle.index_of(text, error), fill_middle.boundaries(text).tolist()
        assert [offset(index, k) for k in range(len(expected))] == expected
        assert all(abs(x - 128) <= error + 1 for x in index[4])
    assert len(fill_middle.index_of(texts[4], error)[1]) == 1  # even tokens lie on one line
    assert len(fill_middle.index_of(texts[5], fill_middle.ERROR)[1]) < 100


@pytest.fixture(scope="module")
def marked(spark, docs):
    extra = [(200, "has <P> in it"), (201, "ends in <S>"), (202, "<M>"), (203, "a <p> b <s> c"), (None, "no key at all"), (3, "twice a key")]
    more = spark.createDataFrame(extra * 2, "doc_id long, text string")
    wide = docs.withColumns({c: F.lit(1) for c in ("n", "h", "index", "row", "begin", "end", "fim")})
    return wide.unionByName(more, allowMissingColumns=True)


@pytest.mark.parametrize("percent, spm_percent", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_same_as_a_scan(marked, percent, spm_percent):
    found = fill_middle.with_fill_middle(marked, 42, percent, spm_percent)
    rebuilt = found.withColumn("rebuilt", fill_middle.restored(F.col("fim"), F.col("form"))).collect()
    assert len(rebuilt) == marked.count() and found.columns.count("n") == 1 and "index" in found.columns
    for r in rebuilt:
        expected = plain(r["doc_id"], r["text"], 42, percent, spm_percent)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim"]) == expected
        assert r["rebuilt"] == (r["text"] or "")
    forms = {r["form"] for r in rebuilt}
    assert forms == ({"plain", "spm", "psm"} if percent == 50 else {"plain"} | ({"spm" if spm_percent else "psm"} if percent else set()))


def test_a_stored_index_serves_other_seeds(marked, tmp_path):
    marked.withColumn("cuts", fill_middle.boundary_index(F.col("text"))).write.parquet(f"{tmp_path}/indexed")
    stored = marked.sparkSession.read.parquet(f"{tmp_path}/indexed")
    for seed in (1, 2):
        found = fill_middle.with_fill_middle(stored, seed, 90, 50, index="cuts")
        for r in found.collect():
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim"]) == plain(r["doc_id"], r["text"], seed, 90, 50)


def test_empty_table(empty):
    found = fill_middle.with_fill_middle(empty)
    assert found.count() == 0 and found.columns[-5:] == ["n", "form", "prefix_chars", "middle_chars", "fim"]
