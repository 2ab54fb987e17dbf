"""Token ids of texts by a file of the tokenizers library, word by word where that is the same."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from bankmetrics.llm.common import held_by_worker

#: A space or line end before anything but a printable ASCII sign, a letter or a digit, or other white space before a
#: line end: white space may then form one token with it, so the text is encoded as a whole.
UNSAFE = r"[ \n](?:[^!-~\p{L}\p{N}]|$)|[^!-~\p{L}\p{N}]\n"

#: Marks that form a token of their own after a word.
MARKS = ".,;:!?"

#: Letters up to here are letters in every version of Unicode that a tokenizer may follow.
LATIN = "\u024f"

#: Words a worker remembers for good at most; those of one slice of texts come on top.
WORDS = 600_000


def worker_encoder(path: str, words: int = WORDS) -> Encoder:
    """The encoder of this Python worker, which later tasks of the worker find with all it remembers.

    Its ids are those of the library with add_special_tokens=False and nothing else set.
    """
    return held_by_worker(("encoder", path, words), lambda: Encoder(path, words, plain=False))


def byte_signs() -> list[str]:
    """The visible sign that byte-level vocabularies use for each byte: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Signs(dict):
    """For str.translate: the signs of each character's bytes."""

    def __init__(self):
        self.signs = byte_signs()

    def __missing__(self, code: int) -> str:
        self[code] = "".join(self.signs[b] for b in chr(code).encode())
        return self[code]


class Encoder:
    """Encodes Arrow arrays of texts.

    A byte-level tokenizer always starts a new pre-token at a space that a visible sign follows, so the ids of a text
    are those of its pieces between spaces, each but the first with its space. A single line end is one pre-token
    and the word after it has no space; a mark after Latin letters ends their pre-token. Each different word is encoded once and remembered (at most ``words`` of them). Words of Latin
    letters go straight to the library's model; other pieces, texts with other white space after a space, texts that
    hold an added token (unless ``plain``, which takes special tokens for plain text), and all texts of tokenizers that
    are not byte-level, go through the whole tokenizer.
    """

    def __init__(self, path: str, words: int = WORDS, plain: bool = True):
        import json
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model = self.tokenizer.model
        form = json.loads(self.tokenizer.to_str())
        pre = form["pre_tokenizer"] or {}
        self.by_word = (
            form["normalizer"] is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
        )
        added = [x["content"] for x in form["added_tokens"] if x["content"] and not (plain and x["special"])]
        self.unsafe = "|".join([UNSAFE, *map(re.escape, added)])
        # A mark that is more than one id is no mark here.
        alone = {m: self.whole([m])[0] for m in MARKS}
        self.marks = "".join(m for m, ids in alone.items() if len(ids) == 1)
        line = self.whole(["\n"])[0]
        self.by_word = self.by_word and len(line) == 1
        self.line = line[0] if line else 0
        self.mark_ids = np.full(256, -1, np.int32)
        for m in self.marks:
            self.mark_ids[ord(m)] = alone[m][0]
        self.signs = Signs()
        self.words = words
        self._clear()

    def _clear(self) -> None:
        #: Words with a space before them, and the first words of lines, which have none.
        self.known: dict[str, int] = {}
        self.first: dict[str, int] = {}
        #: Words of the last slice that were too many to keep, with the number and the ids kept before them.
        self.passing: tuple[list[str], list[str], int] | None = None
        self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, words: list[str], space: str) -> list[list[int]]:
        """Ids of words after ``space``."""
        tokenize, signs = self.model.tokenize, self.signs
        sign = space.translate(signs)
        out: list = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            if word.isalpha() and word.isascii():
                out[i] = [x.id for x in tokenize(sign + word)]
            elif word.isalpha() and max(word) <= LATIN:
                out[i] = [x.id for x in tokenize(sign + word.translate(signs))]
            else:
                rest.append(i)
        for i, ids in zip(rest, self.whole([space + words[i] for i in rest])):
            out[i] = ids
        return out

    def _learn(self, known: dict[str, int], words: list[str], space: str) -> None:
        ids = self._new(words, space)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        old, total = len(self.known) + len(self.first), int(sizes.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(self.used, total) * 2, np.uint32)])
        if old + len(words) > len(self.ends):
            self.ends = np.concatenate([self.ends[:old], np.zeros(max(old, len(words)) * 2, np.int32)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.ends[old : old + len(words)] = self.used + np.cumsum(sizes)
        self.used += total
        known.update(zip(words, range(old, old + len(words))))

    def _codes(self, words: list[str], first: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The places in the memory of different words, and of different first words.

        Frequent words come early. So when the memory is full, other words are only kept for one slice, unless most
        words of a slice are new: then the texts are of another kind, and the memory starts anew.
        """
        if self.passing:
            gone, gone_first, self.used = self.passing
            for x in gone:
                del self.known[x]
            for x in gone_first:
                del self.first[x]
            self.passing = None
        new, new_first = [x for x in words if x not in self.known], [x for x in first if x not in self.first]
        held = len(self.known) + len(self.first)
        if held and held + len(new) + len(new_first) > self.words:
            if 2 * len(new) > len(words):
                self._clear()
                new, new_first = words, first
            else:
                self.passing = new, new_first, self.used
        if new:
            self._learn(self.known, new, " ")
        if new_first:
            self._learn(self.first, new_first, "")
        a = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return a, np.fromiter(map(self.first.__getitem__, first), np.int64, len(first))

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text start (one more than texts). Null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        n = len(texts)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if self.by_word:
            odd = pc.match_substring_regex(texts, self.unsafe).to_numpy(zero_copy_only=False)
        else:
            odd = np.ones(n, bool)
        lines = pc.replace_substring(pc.if_else(pa.array(odd), "", texts), "\n", " \n")
        split = pc.split_pattern(lines, " ")
        bounds = split.offsets.to_numpy()
        bounds = bounds - bounds[0]
        code, line, mark = self._pieces(split.flatten().dictionary_encode(), bounds)
        size = self.ends[code] - np.where(code > 0, self.ends[np.maximum(code, 1) - 1], 0)
        size[code < 0] = 0
        total = size + line + (mark >= 0)
        whole = self.whole(texts.filter(pa.array(odd)).to_pylist()) if odd.any() else []
        per_text = np.add.reduceat(total, bounds[:-1]).astype(np.int64)
        per_text[np.flatnonzero(odd)] = [len(ids) for ids in whole]
        closing = end is not None
        starts = np.concatenate([[0], np.cumsum(per_text + closing)])
        out = np.empty(int(starts[-1]), np.uint32)
        if closing:
            out[starts[1:] - 1] = end
        # The ids of a piece go after those of the text's pieces before it.
        before = np.cumsum(total, dtype=np.int32) - total
        place = before + np.repeat((starts[:-1] - before[bounds[:-1]]).astype(np.int32), np.diff(bounds))
        out[place[line]] = self.line
        place += line
        marked = np.flatnonzero(mark >= 0)
        out[(place + size)[marked]] = mark[marked]
        sums = np.cumsum(size, dtype=np.int32) - size
        run = np.arange(int(size.sum()), dtype=np.int32)
        source = run + np.repeat(self.ends[code] - size - sums, size)
        run += np.repeat(place - sums, size)
        out[run] = self.flat[source]
        for i, ids in zip(np.flatnonzero(odd), whole):
            out[starts[i] : starts[i] + len(ids)] = ids
        return out, starts

    def _pieces(self, pieces: pa.DictionaryArray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each piece its word's place in the memory, whether it opens a line, its mark's id; -1 for none."""
        units = pieces.dictionary
        index = pieces.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        opens = pc.starts_with(units, "\n")
        line = opens.to_numpy(zero_copy_only=False)
        units = pc.if_else(opens, pc.utf8_slice_codeunits(units, 1), units)
        stems = pc.utf8_rtrim(units, self.marks)
        ended = pc.equal(pc.subtract(pc.binary_length(units), pc.binary_length(stems)), 1)
        latin = pc.match_substring_regex(stems, "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$")
        ended = pc.and_(ended, latin)
        marks = np.full(len(units), -1, np.int32)
        at = np.flatnonzero(ended.to_numpy(zero_copy_only=False))
        if len(at):
            last = pc.utf8_slice_codeunits(units.take(pa.array(at)), -1).to_pylist()
            marks[at] = self.mark_ids[np.frombuffer("".join(last).encode("latin-1"), np.uint8)]
        words = pc.if_else(ended, stems, units).dictionary_encode()
        own = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = words.dictionary.to_pylist()
        used = np.zeros((2, len(names)), bool)
        used[line.astype(np.int8), own] = True
        used[1, own[index[bounds[:-1]]]] = True
        spaced = np.flatnonzero(used[0])
        bare = np.array([i for i in np.flatnonzero(used[1]).tolist() if names[i]], np.int64)
        a, b = self._codes([names[i] for i in spaced.tolist()], [names[i] for i in bare.tolist()])
        place = np.full((2, len(names)), -1, np.int32)
        place[0, spaced], place[1, bare] = a, b
        code = place[line.astype(np.int8), own][index]
        head = bounds[:-1]
        code[head] = place[1, own[index[head]]]
        return code, line[index], marks[index]
