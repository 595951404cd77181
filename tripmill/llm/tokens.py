"""Token ids of whole texts, by the tokenizers library.

A byte-level tokenizer cuts a text before it merges anything: at every single
space or line feed between other characters, and between letters and punctuation.
So each worker keeps the ids of words it has met, and the library works on a word
once and not at each of its places. Arrow splits some hundred texts at a time and
numbers their words, so that a word that they share is looked up once for all of
them. Texts and words of any other shape go through the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripmill.llm.frames import kept_for, slices, texts_of

#: Bytes of words and their ids that a worker keeps, in each of two generations, unless told
#: otherwise. Fewer bytes mean that rare words are cut again when they come back.
KEPT_BYTES = 112 << 20
#: Characters of texts that are split at a time, or one longer text.
GROUP_CHARS = 8 << 20
#: Bytes of an entry besides its word and ids.
_ENTRY_BYTES = 190
#: Runs of marks whose ids a worker keeps for good.
_MARKS_KEPT = 4096

# Letters that are letters in every version of Unicode, then marks but for the
# apostrophe, which can begin a contraction.
_PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")


_LATIN = [c for c in map(chr, range(256)) if _PLAIN.fullmatch(c)]
_LETTERS = "".join(c for c in _LATIN if c.isalpha())
_MARKS = "".join(c for c in _LATIN if c != "\n" and not c.isalpha())


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else from 256 up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Words(dict):
    """Ids by word. A word stands for itself with a space before it, unless it
    begins with a line feed."""

    def __init__(self, tokenizer, kept_bytes: int):
        super().__init__()
        self._kept_bytes = kept_bytes
        self._tokenizer = tokenizer
        self._merge = tokenizer.model.tokenize
        self._letters = _byte_letters()
        self._space = self._letters[0x20]
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        self._bytes = [i.to_bytes(4, "little") for i in range(size)]
        self._older: dict[str, bytes] = {}
        self._marks: dict[str, bytes] = {}
        self._held = 0

    def _ids(self, shown: str) -> bytes:
        return b"".join([self._bytes[t.id] for t in self._merge(shown)])

    def _merged(self, part: str) -> bytes:
        """Ids of a part that the tokenizer does not cut."""
        if not part:
            return b""
        return self._ids(part.encode("utf-8").decode("latin-1").translate(self._letters))

    def whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _made(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._ids(self._space + word)
        shape = _PLAIN.fullmatch(word)
        if not shape:
            return self.whole(word if word[0] == "\n" else " " + word)
        feed, letters, marks = shape.groups()
        if feed:
            return self.marked(feed) + self._merged(letters) + self.marked(marks)
        if letters and marks:
            return self[letters] + self.marked(marks)
        return self._merged(" " + word)

    def marked(self, marks: str) -> bytes:
        """Ids of a feed or of marks behind letters, of which there are few kinds."""
        ids = self._marks.get(marks)
        if ids is None:
            ids = self._merged(marks)
            if len(self._marks) < _MARKS_KEPT and len(marks) < 8:
                self._marks[marks] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self._older.get(word)
        if ids is None:
            ids = self._made(word)
        if self._held >= self._kept_bytes:
            self._older = dict(self)
            self.clear()
            self._held = 0
        self._held += _ENTRY_BYTES + len(word) + len(ids)
        self[word] = ids
        return ids


class Encoder:
    """Ids of texts with ``end_id`` after each, as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_path: str, end_id: int, kept_bytes: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        self._special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self._end = np.array([end_id], "<u4").tobytes()
        self._words = _Words(tokenizer, KEPT_BYTES if kept_bytes is None else kept_bytes)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; words that several texts share are looked up once."""
        place = np.cumsum([len(x) for x in texts]) // GROUP_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(texts)]
        return [x for at, to in pairwise(cuts) for x in self._encode_group(texts[at:to])]

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        whole = self._words.whole
        heads: list[bytes] = []
        rests: list[str | None] = []
        for text in texts:
            # Only single spaces and line feeds, each between two words, and no
            # special token that is spelt out.
            by_word = " ".join(text.split()) == text.replace("\n", " ")
            if not by_word or any(x in text for x in self._special):
                heads.append(whole(text))
                rests.append(None)
                continue
            # A word at the start has no space before it.
            first, _, rest = text.replace("\n", " \n").partition(" ")
            heads.append(whole(first) if first else b"")
            rests.append(rest or None)
        tails = self._by_word(rests)
        return [h + t + self._end for h, t in zip(heads, tails, strict=True)]

    def _by_word(self, texts: list[str | None]) -> list[bytes]:
        """Ids of the words between the spaces of each text; null has none."""
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        words = split.flatten().dictionary_encode()
        ids = self._looked_up(words.dictionary).take(words.indices)
        # Buffers begin where the array does, as it was just made.
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) if len(ids) else [0]
        counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
        last = np.cumsum(counts)
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[ends[i - n] : ends[i]]) for i, n in zip(last, counts, strict=True)]


    def _looked_up(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of words; letters with marks behind them look theirs up apart."""
        letters = pc.utf8_rtrim(words, _MARKS)
        marks = pc.utf8_ltrim(words, _LETTERS)
        lengths = pc.add(pc.binary_length(letters), pc.binary_length(marks))
        cut = pc.and_(
            pc.greater(pc.binary_length(letters), 0),
            pc.equal(lengths, pc.binary_length(words)),
        )
        words = pc.if_else(cut, letters, words).dictionary_encode()
        marks = pc.if_else(cut, marks, "").dictionary_encode()
        # One string of all words, which hold no space, is quicker to read than each.
        bounds = pa.array([0, len(words.dictionary)], pa.int32())
        one = pc.binary_join(pa.ListArray.from_arrays(bounds, words.dictionary), " ")[0].as_py()
        known = list(map(self._words.__getitem__, one.split(" "))) if one else []
        tails = list(map(self._words.marked, marks.dictionary.to_pylist()))
        return pc.binary_join_element_wise(
            pa.array(known, pa.large_binary()).take(words.indices),
            pa.array(tails, pa.large_binary()).take(marks.indices),
            pa.scalar(b"", pa.large_binary()),
        )


def encoder(tokenizer_path: str, end_id: int, kept_bytes: int | None = None) -> Encoder:
    """One encoder for each worker process, with the words it has met."""
    how = (tokenizer_path, end_id, kept_bytes)
    return kept_for(("tokens", *how), lambda: Encoder(*how))


def encoded_batches(
    batches: Iterator[pa.RecordBatch],
    tokenizer_path: str,
    end_id: int,
    kept_bytes: int | None = None,
    rows: int = 256,
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with the ids of their ``text`` column."""
    encode_all = encoder(tokenizer_path, end_id, kept_bytes).encode_all
    for part in slices(batches, rows, keeps=True):
        yield part, encode_all(texts_of(part.column("text")))
