"""Ids of whole texts by a word-end BPE tokenizer file, with the ids of words kept by the worker.

Such a tokenizer drops white space and ends every piece of its splitting pattern by itself, so a text can be cut at white space, and equal
words have equal ids. Arrow splits the texts and numbers their distinct words; only words that the worker hasn't met are encoded, and the ids of all words are
gathered from a table. Lower-casing and splitting are done here only for words of Latin letters below U+0180, where both are fixed;
their pieces go to the tokenizer's merges. Any other word, and any that may hold a special token, goes to the library as it is.
Other kinds of tokenizer files encode whole texts.
"""

from __future__ import annotations

import os
import re
import string
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in each half of what a worker keeps, and bytes of text looked at together; results don't depend on either.
CACHE_ENTRIES, TOGETHER = 400_000, 1 << 23
_LETTER, _DIGIT, _BLANK = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
#: The splitting pattern as the tokenizer file states it, and the same on characters below U+0180.
STATED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_BLANK}{_LETTER}{_DIGIT}]+")
FIXED = re.compile("[\x00-ıĲ-ſ]*")  # without the capital I with a dot, which becomes two characters
WIDE = "[^\\x{0}-\\x{17F}]|<\\|"  # texts that are not lower-cased ahead
MARKS = string.punctuation.encode()


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: b if b in own else next(others) for b in range(256)}


class WordEndTokens:
    """``encode(texts)`` gives the ids of each (numpy, ``dtype``)."""

    def __init__(self, file: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(file)
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.merges, self.letters = self.whole.model.tokenize, byte_letters()
        splits, steps = repr(self.whole.pre_tokenizer).replace("\\\\", "\\"), repr(self.whole.normalizer)
        self.cuts = (type(self.whole.model).__name__ == "BPE" and bool(self.whole.model.end_of_word_suffix)
                     and STATED in splits and "ByteLevel(add_prefix_space=False" in splits and "NFC()" in steps and "Lowercase()" in steps
                     and self.whole.post_processor is None
                     and all(t.content.startswith("<|") and not (t.lstrip or t.rstrip) for t in self.whole.get_added_tokens_decoder().values()))
        code, swap = self.dtype.char, sys.byteorder == "big"
        self.serial = (lambda ids: np.array(ids, self.dtype).tobytes()) if swap else (lambda ids: array(code, ids).tobytes())
        self.most = cache_entries
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: bytes) -> bytes:
        """Ids of one lower-case piece, serialised."""
        found = self.known.get(piece)
        if found is None:
            found = self.older.get(piece)
            if found is None:
                own = piece.decode() if piece.isalpha() else piece.decode("latin-1").translate(self.letters)
                found = self.serial([t.id for t in self.merges(own)])
            self.known[piece] = found
        return found

    def _word(self, word: bytes) -> bytes | None:
        """Ids of a word that wasn't met, serialised; None: the library's to encode."""
        stem = word.rstrip(MARKS)
        if stem.isalpha() and stem.islower() and b"<|" not in word:
            return self._piece(stem) if stem == word else self._piece(stem) + self._piece(word[len(stem):])
        text = word.decode()
        if "<|" in text or not FIXED.fullmatch(text):
            return None
        return b"".join([self._piece(p.encode()) for p in PIECES.findall(text.lower())])

    def _words(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) >= self.most:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, words))
        other = []
        for k, ids in enumerate(found):
            if ids is None:
                word = words[k]
                ids = older.get(word)
                if ids is None:
                    ids = self._word(word)
                    if ids is None:
                        other.append(k)
                        continue
                found[k] = known[word] = ids
        for k, ids in zip(other, self._library([words[k].decode() for k in other])):
            found[k] = known[words[k]] = ids.tobytes()
        return found

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each of an array of strings without nulls."""
        if not self.cuts:
            return self._library(texts.to_pylist())
        out: list[np.ndarray] = []
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).cumsum()
        at = 0
        while at < len(texts):
            beyond = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER, side="right")))
            out += self._together(texts.slice(at, beyond - at))
            at = beyond
        return out

    def _together(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.if_else(pc.match_substring_regex(texts, WIDE), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(texts)
        distinct = lists.flatten().dictionary_encode()
        number = distinct.indices.to_numpy()
        _, at, data = distinct.dictionary.buffers()
        data, at = data.to_pybytes() if data else b"", np.frombuffer(at, np.int32)[:len(distinct.dictionary) + 1].tolist()
        ids = self._words([data[a:b] for a, b in zip(at, at[1:])])
        table = np.frombuffer(b"".join(ids), self.dtype)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        first = np.cumsum(length) - length
        each = length[number]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = table[np.repeat(first[number] - ends[:-1], each) + np.arange(ends[-1])]
        cuts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])]
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


_LOADED: dict[str, WordEndTokens] = {}


def tokens(file: str) -> WordEndTokens:
    """The worker's tokenizer of a file, loaded once."""
    if file not in _LOADED:
        _LOADED[file] = WordEndTokens(file)
    return _LOADED[file]
