"""Shards by a Feistel permutation of row numbers."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bankmetrics.llm import sharding


@settings(max_examples=60, deadline=None)
@given(rows=st.integers(1, 3000), seed=st.integers(0, 5))
def test_every_place_is_taken_once_and_leads_back(rows, seed):
    permutation = sharding.Permutation(rows, seed)
    places = permutation.place(np.arange(rows))
    assert sorted(places.tolist()) == list(range(rows))
    assert permutation.number(places).tolist() == list(range(rows))


def test_large_numbers_lead_back_and_seeds_differ():
    rows = 10**15 + 7
    numbers = np.random.default_rng(1).integers(0, rows, 10_000)
    places = [sharding.Permutation(rows, seed).place(numbers) for seed in (0, 1)]
    assert places[0].max() < rows and (places[0] != places[1]).mean() > 0.99
    assert (sharding.Permutation(rows, 0).number(places[0]) == numbers).all()


def test_places_look_shuffled():
    places = sharding.Permutation(100_000, 3).place(np.arange(100_000))
    assert abs(np.corrcoef(np.arange(100_000), places)[0, 1]) < 0.02
    assert abs(np.corrcoef(places[:-1], places[1:])[0, 1]) < 0.02
    # Neighbours fall into each pair of 8 shards about equally often.
    pairs = Counter(zip((places[:-1] % 8).tolist(), (places[1:] % 8).tolist()))
    assert len(pairs) == 64 and all(abs(n - 100_000 / 64) < 250 for n in pairs.values())


def plain(rows, shards, seed):
    """doc_id to (shard, slot), for keys without repetition."""
    keys = sorted(rows, key=lambda k: (k is not None, k or 0))
    places = sharding.Permutation(len(keys), seed).place(np.arange(len(keys)))
    return {k: (p % shards, p // shards) for k, p in zip(keys, places.tolist())}


def test_rows_get_the_place_of_their_number(spark, docs, rows):
    found = sharding.assigned(docs, shards=7, seed=5).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in found} == plain([r[0] for r in rows], 7, 5)
    assert {(r["doc_id"], r["text"], r["base"], r["_row"]) for r in found} == {(r[0], r[1], "b", None) for r in rows}
    again = sharding.assigned(docs.repartition(5, "lang"), shards=7, seed=5)
    assert sorted(map(tuple, again.select("doc_id", "shard", "slot").collect())) == sorted(
        (r["doc_id"], r["shard"], r["slot"]) for r in found
    )


def slots_have_no_gap(found, shards):
    """Whether shards differ by a row at most and slots run from 0."""
    by_shard = {s: sorted(r["slot"] for r in found if r["shard"] == s) for s in range(shards)}
    sizes = [len(x) for x in by_shard.values()]
    return max(sizes) - min(sizes) <= 1 and all(x == list(range(len(x))) for x in by_shard.values())


def test_repeated_rows_and_null_keys_and_clashing_names(spark):
    kind = "doc_id long, text string, shard string, slot int, row int, key int, hash int, at int, tags map<string,int>"
    rows = [(None, None, "x", 1, 1, 1, 1, 1, {"a": 1}), (3, "", "x", 1, 1, 1, 1, 1, None), (3, "t", "x", 1, 1, 1, 1, 1, None)]
    rows += [(1, "same", None, None, None, None, None, None, None)] * 50
    found = sharding.assigned(spark.createDataFrame(rows, kind).repartition(4), shards=6)
    assert found.columns == ["doc_id", "text", "row", "key", "hash", "at", "tags", "row_number", "shard", "slot"]
    got = found.collect()
    assert slots_have_no_gap(got, 6) and Counter((r["doc_id"], r["text"]) for r in got)[1, "same"] == 50
    assert sorted(r["row_number"] for r in got) == list(range(53)) and got and min(r["row_number"] for r in got if r["doc_id"]) == 1


def test_fewer_rows_than_shards_and_none(spark, docs, empty):
    assert slots_have_no_gap(sharding.assigned(docs.limit(3), shards=24).collect(), 24)
    none = sharding.assigned(empty, shards=24)
    assert none.count() == 0 and none.columns[-3:] == ["row_number", "shard", "slot"]
    with pytest.raises(ValueError):
        sharding.assigned(docs, shards=0)


def test_written_shards_hold_their_slots_in_order(spark, docs, rows, tmp_path):
    folder = f"{tmp_path}/shards"
    sharding.write(docs, folder, shards=4, seed=2, file_rows=5)
    found = sharding.read(spark, folder).withColumnRenamed("_row", "row").selectExpr("*", "_metadata.file_path as file").collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in found} == plain([r[0] for r in rows], 4, 2)
    assert {(r["doc_id"], r["text"]) for r in found} == {(r[0], r[1]) for r in rows}
    files = {}
    for r in found:
        files.setdefault(r["file"], []).append((r["shard"], r["slot"]))
    for places in files.values():
        shard, first = places[0]
        assert first % 5 == 0 and places == [(shard, first + i) for i in range(len(places))] and len(places) <= 5
    # A loader asks for row numbers of slots without a table.
    numbers = {(r["shard"], r["slot"]): r["row_number"] for r in found}
    assert sharding.numbers_at(len(rows), 4, 3, np.arange(6), seed=2).tolist() == [numbers[3, i] for i in range(6)]


def test_an_empty_table_is_written(spark, empty, tmp_path):
    sharding.write(empty, f"{tmp_path}/none", shards=4)
    assert not [x for x in tmp_path.joinpath("none").iterdir() if x.name.startswith("shard=")]
