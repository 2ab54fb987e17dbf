import random

import pytest
from pyspark.sql import functions as F

#: Words of two invented languages.
WORDS = {
    "aa": [a + b for a in ("the", "an", "re", "on", "st", "wh") for b in ("er", "ing", "tion", "ed", "ly", "ou")],
    "bb": [a + b for a in ("sch", "ge", "ver", "ü", "pf", "ein") for b in ("ich", "keit", "ung", "tz", "ß", "au")],
}


def prose(lang, words, seed):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS[lang]) + draw.choice(("", "", "", ",", ".", ".\n")) for _ in range(words))


def documents():
    """Null, empty, blank, short, long, repeated and near-copied texts; two languages; null and missing fields."""
    rows = [(i, prose("aa" if i % 3 else "bb", 20 + 7 * i, i), "aa" if i % 3 else "bb", f"s{i % 4}") for i in range(40)]
    base = prose("aa", 120, 99).split(" ")
    for i in range(40, 60):  # copies of one text, each with a few other words
        words = list(base)
        draw = random.Random(i)
        for _ in range(i % 5):
            words[draw.randrange(len(words))] = f"x{i}"
        rows.append((i, " ".join(words), "aa", "hot"))
    odd = ["", None, "   \n\t", "one", "One  TWO three", "one two three", "1 2 3 4 5", "a\x00b é😀   z", "é" * 3000, "x" * 200_000]
    rows += [(60 + i, text, None if i % 2 else "aa", None) for i, text in enumerate(odd)]
    rows += [(80, rows[3][1], "aa", "s0"), (81, rows[4][1].upper(), "aa", "s0"), (82, " ".join(base * 60), None, "long")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The documents as a table of several files, with columns whose names operators use inside."""
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    kind = "doc_id long, text string, lang string, source string, base string, node int, length double, _row string"
    made = spark.createDataFrame([(*r, "b", 7, 1.5, None) for r in rows], kind)
    inner = ("_id", "_mark", "_spans", "_judged", "_encoded")
    made = made.withColumns({c: F.lit(c) for c in inner})
    made.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
