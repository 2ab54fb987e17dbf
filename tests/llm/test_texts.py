"""Language, role repair, SentencePiece and the pipeline."""

import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from bankmetrics.llm import language, pieces, role_repair

from .conftest import prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def phrases(sample, text):
    """Longest matches one after the other; a sign that the sample lacks is a phrase of its own."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample and text[at] in sample:
            size += 1
        count, at = count + 1, at + size
    return count


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("abc"), max_size=14), st.text(st.sampled_from("abcd"), max_size=20))
def test_phrases_are_longest_matches(sample, text):
    assert int(language.Parser({"x": sample}).phrases([text])[0, 0]) == phrases(sample, text)


@pytest.mark.parametrize("chunk, lanes", [(1, 1), (2, 6), (3, 4), (5, 1 << 15), (7, 9)])
def test_phrases_do_not_depend_on_chunks(monkeypatch, chunk, lanes):
    monkeypatch.setattr(language, "CHUNK", chunk)
    monkeypatch.setattr(language, "LANES", lanes)
    draw = random.Random(chunk)
    for _ in range(150):
        samples = {k: "".join(draw.choice("abcd"[: 2 + i]) for _ in range(draw.randrange(25))) for i, k in enumerate("xyz")}
        # Phrases over several chunks, which need to be carried through more than one.
        parts = [draw.choice(("e", "a", "ab", samples["x"], samples["z"], samples["y"][:9])) for _ in range(40)]
        texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(8))) for _ in range(5)]
        found = language.Parser(samples).phrases(texts)
        assert found.tolist() == [[phrases(samples[k], t) for k in "xyz"] for t in texts]


def test_more_languages_than_are_held_at_once(spark):
    draw = random.Random(11)
    words = {f"l{i:03}": ["".join(chr(0x61 + (i * 7 + draw.randrange(9)) % 26) for _ in range(draw.randrange(2, 7))) for _ in range(30)] for i in range(250)}
    rows = [(k, " ".join(draw.choice(v) for _ in range(60))) for k, v in words.items() for _ in range(3)]
    docs = spark.createDataFrame([(i, t, k, 1) for i, (k, t) in enumerate(rows)], "doc_id long, text string, lang string, judged0 int")
    samples = language.sample(docs)
    assert len(samples) == 250
    once = language.with_language(docs, samples, held=250).collect()
    several = language.with_language(docs, samples, held=60)
    assert several.columns == [*docs.columns, "lang_pred", "lang_score", "lang_rate"]
    keyed = {r["doc_id"]: r for r in several.collect()}
    for r in once:
        other = keyed[r["doc_id"]]
        assert (other["lang_pred"], other["lang_rate"]) == (r["lang_pred"], r["lang_rate"])
        assert other["lang_score"] == pytest.approx(r["lang_score"], rel=1e-9)


@pytest.mark.parametrize("size", [90, 150, 190, 210, 250, 4000])
def test_junk_goes_and_prose_stays_whatever_its_length(spark, size):
    draw = random.Random(size)
    rows = [(i, prose("aa" if i % 2 else "bb", draw.randrange(2, 120), i), "aa" if i % 2 else "bb") for i in range(600)]
    rows += [(1000 + i, prose("aa" if i % 2 else "bb", size // 6, 5000 + i), None) for i in range(30)]
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows += [(2000 + i, "".join(draw.choice(signs) for _ in range(size)), None) for i in range(30)]
    rows += [(3000, "word password = 0641917ea4e9feb9cda83477b57ac2654884f485 " + prose("aa", 300, 1), None), (3001, None, "aa"), (3002, "123 ...", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    left = {r["doc_id"] for r in language.accepted(docs.withColumns({"row": F.lit(1), "half": F.lit("x"), "size": F.lit(0)})).collect()}
    assert left == {i for i, *_ in rows if i < 2000 or i == 3000}


def test_accepted_rows_without_labels_or_rows(spark, docs, empty):
    assert language.accepted(empty).count() == 0 and language.accepted(empty).columns == docs.columns
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in language.accepted(unlabelled).collect()} == {
        r["doc_id"] for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()
    }
    # Labelled texts of one half alone: nothing to take a limit from.
    few = spark.createDataFrame([(1, "some words of one text", "aa"), (2, "some words of one text", "aa")], "doc_id long, text string, lang string")
    assert language.accepted(few).count() in (0, 2)


def test_chunks_cover_the_whole_text():
    parser = language.Parser({"x": "ab" * 200, "y": "cd" * 200})
    text = "ab" * 5000 + "cd" * 6000
    assert parser.judge([text])[0] == ["y"]
    assert parser.phrases([text, "", "q"]).shape == (3, 2)


def test_table_grows_with_the_samples_and_not_with_the_signs_of_all_languages():
    draw = random.Random(3)
    samples = {f"l{i}": "".join(chr(0x4E00 + 200 * i + draw.randrange(200)) for _ in range(1000)) for i in range(20)}
    parser = language.Parser(samples)
    held = sum(x.nbytes for x in vars(parser).values() if isinstance(x, np.ndarray))
    assert held - parser.codes.nbytes <= 150 * 20 * 1000
    assert parser.judge([samples["l7"][300:400], samples["l13"][:50]])[0] == ["l7", "l13"]
    assert language.SAMPLE_TEXTS * language.SAMPLE_CHARS >= 128 * 256


def test_states_mesh_in_a_table_of_few_more_places_than_transitions():
    draw = random.Random(8)
    samples = {f"l{i}": "".join(chr(0x61 + 700 * (i % 3) + draw.randrange(4 + 9 * i)) for _ in range(3000)) for i in range(6)}
    parser = language.Parser(samples | {"": ""})
    automata = [language.automaton(samples.get(name, "")) for name in parser.languages]
    # A hash table, at most half full, of keys and states took 24 bytes for each transition at least.
    held = sum(x.nbytes for x in vars(parser).values() if isinstance(x, np.ndarray)) - parser.codes.nbytes
    assert held <= 16 * sum(len(m) for moves in automata for m in moves) + 16 * parser.width
    signs = np.arange(parser.width)
    for moves, root in zip(automata, parser.roots.tolist()):
        number, left = {0: root}, [0]
        while left:
            state = left.pop()
            to, none = parser._next(np.full(parser.width, number[state]), signs)
            assert set(signs[~none].tolist()) == {parser.code[ord(c)] for c in moves[state]}
            for c, other in moves[state].items():
                if other not in number:
                    left.append(other)
                assert number.setdefault(other, int(to[parser.code[ord(c)]])) == to[parser.code[ord(c)]]
        assert len(set(number.values())) == len(moves)


def test_held_out_accuracy(spark):
    rows = [(i, prose("aa" if i % 2 else "bb", 15, i), "aa" if i % 2 else "bb") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    samples = language.sample(docs.where("doc_id % 3 = 0"))
    found = language.with_language(docs.where("doc_id % 3 <> 0"), samples)
    assert found.where("lang = lang_pred").count() == 200
    assert found.where("lang_score between 0.5 and 1").count() == 200


def test_language_of_odd_rows(docs, empty, rows):
    assert language.sample(empty) == {} and language.with_language(empty, {}).count() == 0
    samples = language.sample(docs)
    found = language.with_language(docs, samples)
    assert found.columns == [*docs.columns, "lang_pred", "lang_score", "lang_rate"]
    pred = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    unknown = {i for i, t, *_ in rows if not any(c.isalpha() for c in t or "")}
    assert {i for i, p in pred.items() if p == "und"} == unknown == {60, 61, 62, 66}
    assert {r["lang_pred"] for r in language.with_language(docs, {}).collect()} == {"und"}


def test_sample_is_bounded_and_the_same_for_any_partitions(spark):
    rows = [(prose("aa", 300, i), "aa") for i in range(300)] + [("short", "bb"), (None, "bb"), ("x", None), ("123", "cc")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    first, second = language.sample(docs.repartition(7)), language.sample(docs.coalesce(1))
    assert first == second and first.keys() == {"aa", "bb"}
    assert len(first["aa"]) <= language.SAMPLE_TEXTS * (language.SAMPLE_CHARS + 1)


ROLES = (None, role_repair.SYSTEM, role_repair.USER, role_repair.ASSISTANT)


def cost(roles, states):
    total, at = 0, role_repair.START
    for role, to in zip(roles, states):
        step = role_repair.MOVES[role][at][to]
        if step is None:
            return None
        total, at = total + step[0], to
    return total + role_repair.INSERT * len(role_repair.closing(at))


@settings(max_examples=120, deadline=None)
@given(st.lists(st.sampled_from(ROLES), min_size=1, max_size=6))
def test_repair_costs_least(roles):
    states = [s for s, _, _ in role_repair.traced(roles, role_repair.START, None)]
    every = (cost(roles, x) for x in itertools.product(range(1, 4), repeat=len(roles)))
    assert cost(roles, states) == min(c for c in every if c is not None)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ROLES), min_size=1, max_size=5), min_size=1, max_size=4))
def test_cuts_do_not_change_the_repair(parts):
    whole = role_repair.traced(sum(parts, []), role_repair.START, None)
    ways = role_repair.ways([role_repair.reduced(p) for p in parts])
    assert sum((role_repair.traced(p, a, b) for p, (a, b) in zip(parts, ways)), []) == whole


def test_conversations(spark):
    draw = random.Random(2)
    names = ["user", "assistant", "system", "Human", "bot", None, "tool"]
    rows = [(c, t, draw.choice(names), f"c{c}t{t}") for c in range(60) for t in range(draw.randrange(1, 9))]
    rows += [(77, t, draw.choice(names), f"hot{t}") for t in range(3000)]
    rows += [(None, 1, "user", None), (78, None, "user", "a"), (79, 1, "user", "x"), (79, 1, "user", "x")]
    table = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, place int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = role_repair.repaired(table.repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == len(rows)
    assert len({r["part"] for r in found if r["conv_id"] == 77}) > 1
    by = {}
    for r in sorted(found, key=lambda r: (r["part"], r["place"])):
        by.setdefault(r["conv_id"], []).append(r)
    for c, turns in by.items():
        own = [x for x in rows if x[0] == c]
        if c not in (78, 79, None):
            assert [r["text"] for r in turns] == [x[3] for x in own]
            states = [s for s, _, _ in role_repair.traced([role_repair.role_of(x[2]) for x in own], role_repair.START, None)]
            assert [r["role"] for r in turns] == [role_repair.STATES[s] for s in states]
        text = "".join(r["rendered"] for r in turns)
        shown = [line[2:-2] for line in text.split("\n") if line.startswith("<|")]
        state = role_repair.START
        for name in shown:
            assert role_repair.STATES.index(name) in role_repair.NEXT[state]
            state = role_repair.STATES.index(name)
        assert state == role_repair.LAST
    assert role_repair.repaired(table.limit(0)).count() == 0


ODD = ["", " ", "  a  b", "a\n\n b ", "<s> </s> <0x0A> <unk>", "é日本語 ▁x▁▁y", "\t\x00z", "aaa aaaaaaa   ", "😀 b", "a b", None]


@pytest.fixture(scope="module")
def checker():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_are_the_library_s(checker, rows):
    with open(MODEL, "rb") as file:
        raw = file.read()
    encoder = pieces.Encoder(pieces.Model(raw), words=100)
    texts = [*ODD, *(r[1] for r in rows)]
    for some in (texts, texts[:1], texts[3:5]):
        ids, starts, exact = encoder.encode(pa.array(some, pa.string()))
        assert all(checker.decode(checker.encode(t or "")) == (t or "") for t, e in zip(some, exact) if e)
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [checker.encode(t or "") for t in some]
    with pytest.raises(ValueError):
        pieces.Model(b"\x0b no model")


def unigram_model():
    """A small unigram model with byte fallback, written by hand in the file format."""

    def number(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    def field(k, value):
        if isinstance(value, int):
            return number(k << 3) + number(value)
        if isinstance(value, float):
            import struct

            return number(k << 3 | 5) + struct.pack("<f", value)
        return number(k << 3 | 2) + number(len(value)) + value

    listed = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    listed += [("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.5, 1), ("ab", -5.0, 1), ("▁a", -4.0, 1), ("ba", -6.0, 1), ("▁ab", -7.5, 1)]
    body = b"".join(field(1, field(1, p.encode()) + field(2, s) + (field(3, k) if k != 1 else b"")) for p, s, k in listed)
    trainer = field(3, 1) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2) + field(43, (1 << 64) - 1)
    return body + field(2, trainer) + field(3, field(1, b"identity") + field(3, 1) + field(4, 1) + field(5, 1))


def test_unigram_scores_and_byte_fallback():
    raw = unigram_model()
    theirs = sentencepiece.SentencePieceProcessor(model_proto=raw)
    encoder = pieces.Encoder(pieces.Model(raw))
    texts = ["ab", "aab bab", "  a   b ", "é a", "", "abababba x"]
    ids, starts, _ = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [theirs.encode(t) for t in texts]


def test_pieces_of_all_rows(docs, empty, rows):
    found = pieces.encoded(docs, MODEL)
    assert found.columns == [*docs.columns, "pieces", "decoded", "parity"]
    kept = found.collect()
    assert len(kept) == len(rows) and all(r["parity"] and r["decoded"] == (r["text"] or "") for r in kept)
    assert pieces.encoded(empty, MODEL).count() == 0


def test_stages(spark, docs, rows, empty, tmp_path):
    """Each stage against a plain version on its own input, as the driver runs them."""
    from .test_groups import components
    from .test_spans import secret

    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "packing"]
    rows = [*rows, (90, "see password=abcdef123 and " + prose("aa", 30, 1234), "aa", "s"), (91, "".join(random.Random(4).choice("0123456789abcdefghijk") for _ in range(900)), "aa", "s")]
    kind = "doc_id long, text string, lang string, source string, n_chars long, component_id long"
    spark.createDataFrame([(*r, len(r[1] or ""), 4) for r in rows], kind).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    left, plain = spark.read.parquet(str(tmp_path / "documents.parquet")), {r[0]: r[1] for r in rows}
    columns = left.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        left = stage(spark, left, str(tmp_path))
        if name == "language":
            gone = {i for i, t in plain.items() if not any(c.isalpha() for c in t or "")} | {68, 69, 91}
            plain = {i: t for i, t in plain.items() if i not in gone}
        elif name == "near_duplicates":
            plain = {i: plain[i] for i, (_, c) in components(list(plain.items())).items() if i == c}
        elif name == "secrets":
            assert secret(plain[90])
            plain[90] = plain[90].replace("password=abcdef123", "[ASSIGN]")
        if i < 3:
            assert left.columns == columns
            assert {r["doc_id"]: r["text"] for r in left.collect()} == plain
            assert left.where("n_chars <> length(text)").count() == 0
            left.write.parquet(str(tmp_path / name))
            left = spark.read.parquet(str(tmp_path / name))
    assert left.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n = m").count() == len(plain)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == left.count()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], kind), str(tmp_path)).count() == 0
