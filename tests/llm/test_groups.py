"""The Jaccard join, vector search and fingerprints against brute force."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bankmetrics.llm import jaccard, metric_search, prefix_hash
from bankmetrics.llm.common import work_folder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def components(rows, k=5, percent=75):
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(sets[i]), top(i)) for i in ids}


def near_texts(seed, groups=6, size=12, length=40, edits=6):
    """Groups of texts around a base, with more or fewer edits, some longer, and passages that groups share."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    passage = [word() for _ in range(25)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(draw.randrange(8, length))]
        for _ in range(size):
            words = list(base)
            for _ in range(draw.randrange(edits)):
                at = draw.randrange(len(words))
                words[at : at + draw.randrange(2)] = [word() for _ in range(draw.randrange(2))]
            if draw.random() < 0.4:
                words += passage
            rows.append(" ".join(words))
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, k, percent", [(1, 5, 75), (2, 2, 75), (3, 1, 60), (4, 3, 90), (5, 1, 75)])
def test_components_are_those_of_all_pairs(spark, tmp_path, seed, k, percent):
    rows = near_texts(seed)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "t"))
    found = jaccard.linked_components(spark.read.parquet(str(tmp_path / "t")), k, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == components(rows, k, percent)


def test_components_of_odd_rows(docs, rows):
    found = jaccard.linked_components(docs).collect()
    expected = components([(r[0], r[1]) for r in rows])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert expected[80][1] == 3 and expected[81][1] == 4 and expected[65][1] == 64 and expected[60] == (0, 60)


def test_one_of_each_group_stays(docs, rows, empty):
    expected = components([(r[0], r[1]) for r in rows])
    left = jaccard.first_of_groups(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [i for i, (_, c) in expected.items() if i == c]
    assert jaccard.first_of_groups(empty).count() == 0 and jaccard.linked_components(empty).count() == 0


def test_rows_without_or_with_equal_ids(spark, tmp_path):
    text = "one two three four five six seven"
    rows = [(None, text), (None, text), (5, text), (5, text), (9, text), (7, "other words in this text here now"), (8, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    found = jaccard.linked_components(docs).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [(0, 0), (0, 0), (5, 5), (5, 5), (7, 7), (8, 8), (9, 5)]
    left = sorted(r["doc_id"] or 0 for r in jaccard.first_of_groups(docs).collect())
    assert left == [0, 0, 5, 7, 8]


def test_documents_of_several_texts(spark, tmp_path):
    """Brute force over rows that repeat a doc_id with other texts."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, ""), (4, a), (5, None), (6, "lone words of a text"), (6, "lone words of a text")]
    draw = random.Random(8)
    for i, text in near_texts(4):
        rows += [(1000 + i, text)] + [(1000 + draw.randrange(60), text + " more")] * (draw.random() < 0.4)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    alone = components([(i, t) for i, (_, t) in enumerate(rows)])  # each row a document of its own
    parent = {k: k for k, _ in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (_, c) in alone.items():
        x, y = sorted((root(rows[i][0]), root(rows[c][0])))
        parent[y] = x
    found = jaccard.linked_components(docs).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(
        (k, alone[i][0], root(k)) for i, (k, _) in enumerate(rows)
    )
    assert {root(k) for k in (1, 2, 3, 4)} == {1}
    # Of each component of texts, the smallest doc_id; texts that nothing links stay, whatever their doc_id.
    groups = {}
    for i, (_, c) in alone.items():
        key = c if alone[i][0] else (rows[i][0], rows[i][1])
        groups.setdefault(key, []).append(rows[i])
    left = jaccard.first_of_groups(docs.withColumns({c: F.lit(1) for c in ("_id", "id", "row", "n", "sum_a", "own", "gone")}))
    kept = left.collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(min(k for k, _ in g) for g in groups.values())
    assert {(r["doc_id"], r["text"]) for r in kept} <= set(rows) and left.columns[2:] == ["_id", "id", "row", "n", "sum_a", "own", "gone"]
    assert {(1, a), (1, b), (4, "")} <= {(r["doc_id"], r["text"]) for r in kept}


def test_rows_that_change_places_between_scans_are_an_error(spark):
    """Tokens of equal texts but for one word are all there in any order; only the marks of the batches tell."""
    rows = [(i, f"lead{i % 7} " + " ".join(f"w{k}" for k in range(30))) for i in range(64)]

    def dealt(batches):
        for batch in batches:
            yield batch.take(np.random.default_rng(int.from_bytes(os.urandom(8))).permutation(batch.num_rows))

    kind = "doc_id long, text string"
    docs = spark.createDataFrame(rows, kind).coalesce(1).mapInArrow(dealt, kind)
    with pytest.raises(Exception, match="rows changed between two scans"):
        jaccard.linked_components(docs).collect()


def test_unfinished_components_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 2)
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    with pytest.raises(RuntimeError):
        jaccard.components(edges, work_folder(spark, "test"), "c")


def test_a_large_group_makes_few_pairs(spark, tmp_path, monkeypatch):
    """Rows of all joins grow with the group, not with its square."""
    draw = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(draw.randrange(7)):
            words[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    counted, plain = [], jaccard._overlaps
    monkeypatch.setattr(jaccard, "_overlaps", lambda pairs, sets: counted.append(pairs.count()) or plain(pairs, sets))
    found = jaccard.linked_components(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == components(rows)
    assert sum(counted) < 12 * len(rows)


def test_chains_of_links_are_one_component(spark):
    folder = work_folder(spark, "test")
    edges = [(i, i + 1) for i in range(60)] + [(200, 100), (300, 200), (100, 300), (7, 7)]
    found = jaccard.components(spark.createDataFrame(edges, "a long, b long"), folder, "c").collect()
    assert {r["node"]: r["component"] for r in found} == {**{i: 0 for i in range(1, 61)}, 200: 100, 300: 100}


def vectors(seed, n, dim, copies=0):
    draw = np.random.default_rng(seed)
    x = draw.normal(0, 0.3, (n, dim))
    x[n - copies :] = x[0]
    return [(i, v.tolist()) for i, v in enumerate(x)]


def best(rows, step, k):
    whole = {i: np.floor(64 * np.array(v)) for i, v in rows}
    out = []
    for q in whole:
        if q % step == 0:
            ranked = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("n, dim, copies, page", [(900, 8, 0, 16), (700, 3, 300, 8), (40, 16, 0, 256), (3, 2, 0, 4)])
def test_search_is_exact(spark, monkeypatch, n, dim, copies, page):
    monkeypatch.setattr(metric_search.Tree.__init__, "__defaults__", (page,))
    monkeypatch.setattr(metric_search, "TREE_ROWS", 100)
    monkeypatch.setattr(metric_search, "GROUP_ROWS", 250)
    monkeypatch.setattr(metric_search, "BLOCK_QUERIES", 30)
    rows = vectors(n, n, dim, copies)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, cell int, id string")
    found = metric_search.top_products(table, F.col("id") % 7 == 0, 20)
    assert sorted(tuple(r) for r in found.collect()) == best(rows, 7, 20)


def test_trees_skip_and_keep_bounds():
    draw = np.random.default_rng(0)
    centres = draw.normal(0, 40, (30, 6))
    x = np.floor(np.repeat(centres, 60, axis=0) + draw.normal(0, 1, (1800, 6)))
    tree = metric_search.Tree(np.arange(1800), x, page=32)
    seen = []
    for leaf, router, rows, parent, *rest in tree.pages:
        if router is not None:
            stored = tree.all[rows] if leaf else rest[0]
            assert np.allclose(parent, np.sqrt(((stored - tree.all[router]) ** 2).sum(axis=1)))
        seen += list(rows) if leaf else []
    assert sorted(seen) == list(range(1800))
    found = []
    tree.search(x[5], 5, 10, found, -np.inf)
    expected = sorted(((float(x[5] @ v), -i) for i, v in enumerate(x) if i != 5), reverse=True)[:10]
    assert sorted(found, reverse=True) == expected


def test_vectors_that_take_no_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0]), (20, [-0.01, 2.0]), (21, [1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = metric_search.top_products(table, F.col("id") % 20 == 0, 3).collect()
    assert sorted(tuple(r) for r in found) == [(0, 1, 1, 2048), (0, 2, 20, -64), (20, 1, 1, 4064), (20, 2, 0, -64)]
    assert metric_search.top_products(table.limit(0), F.col("id") % 20 == 0, 3).count() == 0


def spans_of(text, k=prefix_hash.SPAN):
    return {text[i : i + k] for i in range(len(text) - k + 1)} or ({text} if text else set())


def described(rows):
    out = {}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        out[i] = (text, edited, after)
    return out


def test_fingerprints(docs, rows, empty):
    expected = described(sorted((r[0], r[1]) for r in rows))
    found = {r["doc_id"]: r for r in prefix_hash.fingerprints(docs).collect()}
    assert found.keys() == expected.keys()
    prints, error = {}, []
    for i, (text, edited, after) in expected.items():
        r = found[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["common_prefix"] == len(os.path.commonprefix([text, edited]))
        for t, p in ((text, r["fingerprint"]), (edited, r["edited_fingerprint"])):
            assert prints.setdefault(t, p) == p
        a, b, c = spans_of(text), spans_of(edited), spans_of(after)
        error += [abs(len(a & x) / max(1, len(a | x)) - near) for x, near in ((b, r["near_edited"]), (c, r["near_next"])) if a | x]
    assert len(set(prints.values())) == len(prints)
    assert np.mean(error) < 0.06
    assert prefix_hash.fingerprints(empty).count() == 0


def test_fingerprints_of_few_and_equal_rows(spark):
    make = lambda rows: {str(r["doc_id"]): r for r in prefix_hash.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lone = make([(1, "abcdefgh")])["1"]
    assert lone["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and lone["near_next"] == 1.0
    blank = make([(1, None), (2, "")])
    assert blank["1"]["near_next"] == 1.0 and blank["1"]["fingerprint"] == blank["2"]["fingerprint"]
    assert make([(None, "x"), (3, "y")]).keys() == {"None", "3"}


def test_spans_and_extensions():
    draw = random.Random(1)
    text = "".join(draw.choice("ab") for _ in range(300))
    hashes = prefix_hash.PrefixHashes(prefix_hash.points([text]), prefix_hash.Powers())
    places = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    a, b = (np.array(x) for x in zip(*places))
    most = 300 - np.maximum(a, b)
    expected = [len(os.path.commonprefix([text[i:], text[j:]])) for i, j in places]
    assert hashes.extension(a, b, most).tolist() == expected
    assert hashes.equal(a, b, np.array(expected)).all()


@pytest.mark.parametrize("size", [1, 1000, 2**23])
def test_search_is_exact_at_large_norms(size):
    draw = np.random.default_rng(size)
    # Groups whose members differ by little against their norms, so that bounds come close to the scores.
    x = np.floor(np.repeat(draw.normal(0, size, (12, 5)), 40, axis=0) + draw.integers(-3, 4, (480, 5)))
    ids = draw.permutation(480)
    tree = metric_search.Tree(ids, x, page=8)
    whole = [[int(v) for v in row] for row in x]
    assert max(sum(v * v for v in row) for row in whole) < 2**50
    for i in range(0, 480, 5):
        found = []
        tree.search(x[i], int(ids[i]), 10, found, -np.inf)
        scores = ((sum(a * b for a, b in zip(whole[i], row)), -int(j)) for row, j in zip(whole, ids) if j != ids[i])
        assert sorted(((int(s), int(j)) for s, j in found), reverse=True) == sorted(scores, reverse=True)[:10]
