"""SentencePiece models on the tokenizers library: the model file is read here, and its parts are rebuilt there.

Read from the file: the pieces with their scores and kinds, the model type, byte fallback, and the normaliser (its
character map, the dummy prefix, white space rules). Byte pair models get their merges from the pieces: all pairs of
pieces that make up a piece, in the order of that piece's score. Unigram models keep their scores. Each encoding can be
compared with the sentencepiece library's.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmetrics.llm.common import held_by_worker, slices

# Fixed values of the model format: kinds of pieces, model types, field numbers.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, SUFFIX, BYTE_FALLBACK = 3, 24, 35
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5

SPACE = "▁"

#: Words a worker remembers for good at most; those of one slice of texts come on top.
WORDS = 600_000


def fields(raw: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protobuf message: numbers, or bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if kind == 2:
            size = number()
        if size is None or at + size > len(raw):
            raise ValueError(f"no model: wire type {kind} at byte {at}")
        yield key >> 3, raw[at : at + size]
        at += size


class Model:
    """The parts of a model file that encoding depends on."""

    def __init__(self, raw: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.type, self.suffix, self.byte_fallback = UNIGRAM, False, False
        self.charsmap, self.dummy_prefix, self.remove_extra, self.escape = b"", True, True, True
        for field, value in fields(raw):
            if field == PIECES:
                part = dict(fields(value))
                score = struct.unpack("<f", part[SCORE])[0] if SCORE in part else 0.0
                self.pieces.append((part.get(PIECE, b"").decode(), score, part.get(KIND, NORMAL)))
            elif field == TRAINER:
                part = dict(fields(value))
                self.type = part.get(MODEL_TYPE, UNIGRAM)
                self.suffix = bool(part.get(SUFFIX, 0))
                self.byte_fallback = bool(part.get(BYTE_FALLBACK, 0))
            elif field == NORMALIZER:
                part = dict(fields(value))
                self.charsmap = part.get(CHARSMAP, b"")
                self.dummy_prefix = bool(part.get(DUMMY_PREFIX, 1))
                self.remove_extra = bool(part.get(REMOVE_EXTRA, 1))
                self.escape = bool(part.get(ESCAPE, 1))
        if self.type not in (UNIGRAM, BPE) or self.suffix or not self.escape:
            raise ValueError("only unigram and byte pair models with a leading space marker are supported")

    def unknown(self) -> tuple[int, str]:
        return next(((i, p) for i, (p, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), (0, self.pieces[0][0]))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make up a piece, the best piece first."""
        usable = {p: (score, i) for i, (p, score, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, (score, i) in usable.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in usable and right in usable:
                    found.append((-score, i, usable[left][1], usable[right][1], left, right))
        return [(x[4], x[5]) for x in sorted(found)]


def tokenizer(model: Model):
    """The tokenizers library's tokenizer for the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    number, unknown = model.unknown()
    if model.type == BPE:
        # Control pieces and bytes are in the vocabulary, but no merge leads to them, so text never makes them.
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        built = Tokenizer(
            models.BPE(vocab=vocab, merges=model.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback)
        )
    else:
        # Pieces that text must not make get a score that no path takes.
        scores = [(p, s if kind in (NORMAL, USER_DEFINED) else min(s, -1e9)) for p, s, kind in model.pieces]
        built = Tokenizer(models.Unigram(scores, unk_id=number, byte_fallback=model.byte_fallback))
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    built.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", SPACE)])
    inner = any(SPACE in p.lstrip(SPACE) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))
    if model.type == BPE and not inner:
        # No piece has a marker after another sign, so no merge crosses the place before a run of markers.
        built.pre_tokenizer = pre_tokenizers.Split(Regex(f"{SPACE}*[^{SPACE}]+|{SPACE}+"), "isolated")
    user = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    built.add_tokens([AddedToken(p, normalized=False, special=False) for p in user])
    tail = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    built.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return built


class Encoder:
    """Encodes Arrow arrays of texts.

    Where no piece has a marker after another sign and spaces stay as they are, a text with single spaces between its
    words has the ids of its words, each with a marker before it. Each different word is encoded once by the library's
    model and remembered (at most ``words`` of them). All other texts go through the library's tokenizer as a whole.
    """

    def __init__(self, model: Model, words: int = WORDS):
        self.tokenizer = tokenizer(model)
        self.model, self.words = self.tokenizer.model, words
        inner = any(SPACE in p.lstrip(SPACE) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))
        user = any(kind == USER_DEFINED for _, _, kind in model.pieces)
        self.by_word = model.type == BPE and model.dummy_prefix and not (inner or user or model.charsmap or model.remove_extra)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        #: Words of the last slice that were too many to keep, with the number of ids kept before them.
        self.passing: tuple[list[str], int] = ([], 0)
        self.flat, self.ends, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0
        #: Whether the library decodes the word's ids to the word.
        self.exact = np.zeros(1 << 14, bool)

    def _codes(self, words: list[str]) -> np.ndarray:
        if self.passing[0]:
            for x in self.passing[0]:
                del self.known[x]
            self.used, self.passing = self.passing[1], ([], 0)
        new = [x for x in words if x not in self.known]
        if self.known and len(self.known) + len(new) > self.words:
            if 2 * len(new) > len(words):  # texts of another kind
                self._clear()
                new = words
            else:
                self.passing = new, self.used
        ids = [[x.id for x in self.model.tokenize(SPACE + w)] for w in new]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        old, total = len(self.known), int(sizes.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(self.used, total) * 2, np.int32)])
        if old + len(new) > len(self.ends):
            self.ends = np.concatenate([self.ends[:old], np.zeros(max(old, len(new)) * 2, np.int64)])
            self.exact = np.concatenate([self.exact[:old], np.zeros(max(old, len(new)) * 2, bool)])
        # Decoded in one go: each word's ids begin with a marker, which becomes the space between two words.
        back = self.tokenizer.decode(list(chain.from_iterable(ids)), skip_special_tokens=False).split(" ")
        self.exact[old : old + len(new)] = [a == b for a, b in zip(back, new)] if len(back) == len(new) else False
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.int32, total)
        self.ends[old : old + len(new)] = self.used + np.cumsum(sizes)
        self.used += total
        self.known.update(zip(new, range(old, old + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids; where those of each text start (one more than texts); which texts are known to be decoded exactly.

        Null is the empty text. A text of words that are decoded exactly is so too, as words are joined by one space.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        odd = np.ones(n, bool) if not self.by_word else pc.match_substring_regex(texts, f"^ |  | $|{SPACE}").to_numpy(zero_copy_only=False)
        whole = [e.ids for e in self.tokenizer.encode_batch_fast(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)]
        split = pc.split_pattern(texts.filter(pa.array(~odd & ~empty)), " ")
        pieces = split.flatten().dictionary_encode()
        index = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        code = self._codes(pieces.dictionary.to_pylist())[index]
        before = np.where(code > 0, self.ends[np.maximum(code, 1) - 1], 0)
        size = self.ends[code] - before
        sizes, exact = np.zeros(n, np.int64), empty.copy()
        if len(split):
            bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
            sizes[~odd & ~empty] = np.add.reduceat(size, bounds[:-1])
            exact[~odd & ~empty] = np.logical_and.reduceat(self.exact[code], bounds[:-1])
        sizes[odd] = [len(x) for x in whole]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        ours = self.flat[np.repeat(before - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        if not odd.any():
            return ours, starts, exact
        out = np.empty(int(starts[-1]), np.int32)
        out[np.repeat(~odd, sizes)] = ours
        out[np.repeat(odd, sizes)] = np.fromiter(chain.from_iterable(whole), np.int32, int(sizes[odd].sum()))
        return out, starts, exact


def worker_encoder(raw: bytes, threads: int) -> Encoder:
    """This Python worker's encoder for a model file, with ``threads`` threads for batches."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    return held_by_worker(("pieces", zlib.crc32(raw), len(raw)), lambda: Encoder(Model(raw)))


def encoded(docs: DataFrame, model_path: str, threads: int = 2, verify: bool = True) -> DataFrame:
    """Adds ``pieces`` (ids), ``decoded`` (their text) and ``parity`` to docs; other columns stay as they are.

    The model file is read by the driver and sent with the tasks. parity tells whether the sentencepiece library gives
    the same ids and the same text back (null where ``verify`` is off). Null and empty texts have no ids, and so have
    texts that the normaliser empties. Rows are taken one by one. Columns of these names are replaced.
    """
    with open(model_path, "rb") as file:
        raw = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = worker_encoder(shared.value, threads)
        checker = None
        if verify:
            import sentencepiece

            checker = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        kind = pa.struct([("pieces", pa.list_(pa.int32())), ("decoded", pa.string()), ("parity", pa.bool_())])
        for part in parts:
            out = []
            batch = pa.RecordBatch.from_arrays([pa.array(part)], ["text"])
            for piece in slices(iter([batch]), "text"):
                back = [x or "" for x in piece.column("text").to_pylist()]
                flat, starts, exact = encoder.encode(piece.column("text"))
                every, bounds = flat.tolist(), starts.tolist()
                ids = [every[a:b] for a, b in zip(bounds, bounds[1:])]
                theirs = checker.encode(back, num_threads=threads) if checker else []
                rest = np.flatnonzero(~exact).tolist()
                for i, text in zip(rest, encoder.tokenizer.decode_batch([ids[i] for i in rest], skip_special_tokens=False)):
                    back[i] = text
                parity = [None] * len(ids)
                if checker:
                    parity = [x == y and t == u for x, y, t, u in zip(ids, theirs, back, checker.decode(theirs))]
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))
                columns = [lists, pa.array(back, pa.string()), pa.array(parity, pa.bool_())]
                out.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
            yield pa.concat_arrays(out) if out else pa.array([], kind)

    udf = F.arrow_udf(encode, "pieces array<int>, decoded string, parity boolean")
    names = [c for c in docs.columns if c not in ("pieces", "decoded", "parity")]
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    found = docs.select(row.alias("row"), udf(F.col("text").cast("string")).alias("encoded"))
    return found.select(*(F.col(f"row.`{c}`").alias(c) for c in names), "encoded.*")
