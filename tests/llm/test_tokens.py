"""Token files and packing against the tokenizers library, one document at a time."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bankmetrics.llm import packing, token_files
from bankmetrics.llm.common import kept, work_folder
from bankmetrics.llm.encoding import Encoder

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(BPE)
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return Encoder(BPE, words=50)


ODD = ["", "  a  b", "a\n\nb", "a \nb", "\nx", "x\n", " x", "x ", "I'm\n's", "c.\nd, e!?", "é. a", "ж. я\nю", "<|endoftext|> x", "t\tb", "a b", "a 　b"]


def check(encoder, library, texts):
    ids, starts = encoder.encode(pa.array(texts, pa.string()), 2)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [[*library(t), 2] for t in texts]


def test_encoder_gives_the_library_s_ids(encoder, library, rows):
    check(encoder, library, [*ODD, None])
    check(encoder, library, [r[1] for r in rows])
    check(Encoder(BPE), library, [r[1] for r in rows])
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == [0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é.\n ,!'sж1 \t "), max_size=12), min_size=1, max_size=5))
def test_encoder_on_drawn_texts(texts):
    made = Tokenizer.from_file(BPE)
    check(ENCODER, lambda t: made.encode(t, add_special_tokens=False).ids, texts)


ENCODER = Encoder(BPE)


def test_added_tokens_in_texts_are_the_library_s(spark):
    made = Tokenizer.from_file(BPE)
    texts = [*ODD, "end of one<|endoftext|>start", "<|endoftext|>", "a <|endoftext|>\n b", "<|endoftext", "plain words"]
    check(Encoder(BPE, plain=False), lambda t: made.encode(t, add_special_tokens=False).ids, texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = f"{work_folder(spark, 'test')}/ids"
    token_files.write(docs, folder, BPE, 2)
    plain = lambda t: made.encode(t, add_special_tokens=False).ids
    found = token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))
    assert sorted(tuple(r) for r in found.collect()) == expected_files(rows, plain)
    packed_right(packing.pack(docs, BPE, 1, 16).collect(), rows, plain, 16)


def test_encoder_with_other_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    ids, starts = Encoder(path).encode(pa.array(["Hello World, x", "", "a b"]))
    expected = [made.encode(t, add_special_tokens=False).ids for t in ("Hello World, x", "", "a b")]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=900), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    raw = token_files.segment(3, 4, [(5, len(ids), False)], ids, percentile)
    part = token_files.Segment(raw + b"\n")
    assert part.end == len(raw) and (part.shard, part.number) == (3, 4)
    assert part.ids().tolist() == values
    blocks = [part.block(k).tolist() for k in range(-(-len(values) // token_files.BLOCK))]
    assert sum(blocks, []) == values


def test_damage_is_found():
    raw = bytearray(token_files.segment(0, 0, [(1, 300, False)], np.arange(300, dtype=np.uint32)))
    raw[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        token_files.Segment(raw)


def expected_files(rows, library):
    start, out = 0, []
    for doc_id, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0])):
        ids = [*library(text), 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment_ids", [1 << 20, 700])
def test_files_return_all_documents(spark, docs, rows, library, segment_ids):
    folder = f"{work_folder(spark, 'test')}/ids"
    token_files.write(docs, folder, BPE, 2, segment_ids=segment_ids)
    found = token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))
    assert sorted(tuple(r) for r in found.collect()) == expected_files(rows, library)
    # The same by one read of the files and sums over the rows kept.
    local = kept(token_files.read_local(spark, folder), folder, "local")
    assert sorted(r["doc_id"] for r in local.collect()) == sorted(r[0] for r in rows)
    once = token_files.with_start(local, local.groupBy("shard").agg(F.sum("n_tokens").alias("n")))
    assert sorted(tuple(r) for r in once.select(*found.columns[:3], F.crc32("ids")).collect()) == expected_files(rows, library)


def test_files_keep_null_ids_and_repeated_rows(spark, library):
    rows = [(None, "b c"), (None, "b c"), (4, None), (4, "z"), (4, "z"), (-1, "")]
    folder = f"{work_folder(spark, 'test')}/ids"
    token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), folder, BPE, 2)
    found = token_files.read(spark, folder).orderBy("start").select("doc_id", "start", "n_tokens").collect()
    assert [r["doc_id"] for r in found] == [None, None, -1, 4, 4, 4]
    sizes = [r["n_tokens"] for r in found]
    assert [r["start"] for r in found] == np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()


def test_no_documents(spark, empty):
    folder = f"{work_folder(spark, 'test')}/ids"
    token_files.write(empty, folder, BPE, 2)
    assert token_files.read(spark, folder).count() == 0
    assert packing.pack(empty, BPE, 1).count() == 0


def packed_right(found, rows, library, window):
    by_doc = {r[0]: [*library(r[1]), 1] for r in rows}
    held = {}
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == by_doc[r["doc_id"]][r["start"] : r["start"] + r["length"]] and r["length"] == len(ids)
        assert r["doc_tokens"] == len(by_doc[r["doc_id"]])
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in found) == sum(map(len, by_doc.values()))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    return held


@pytest.mark.parametrize("window", [64, 2048])
def test_each_id_lies_in_one_piece(docs, rows, library, window):
    held = packed_right(packing.pack(docs, BPE, 1, window).collect(), rows, library, window)
    full = sum(sum(n for _, n in parts) for parts in held.values())
    assert full >= 0.97 * window * (len(held) - 1)


def test_extra_columns_stay(docs):
    pieces = docs.selectExpr("doc_id", "node", "cast(doc_id % 9 + 1 as long) as length", "`length` as offset")
    found = packing.assign(pieces.withColumnRenamed("offset", "c0"), 16)
    assert found.columns == ["doc_id", "node", "length", "c0", "sequence_id", "offset"]
    assert found.where("c0 = 1.5 and node = 7").count() == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 9), max_size=6), st.integers(0, 30))
def test_fill_is_the_best_subset_sum(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    taken = packing.fill(counts, room)
    assert sum(k * n for k, n in taken.items()) == max(sums)
    assert all(n <= counts[k] for k, n in taken.items())


def test_plan_uses_each_piece_once():
    counts = {700: 5, 1348: 5, 3: 1000, 2048: 4, 2047: 1, 1: 2}
    rows = packing.plan(counts, 2048)
    for length, n in counts.items():
        spans = sorted((a, b) for k, a, b, *_ in rows if k == length)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
