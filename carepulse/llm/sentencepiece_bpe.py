"""SentencePiece encoding and decoding of a merge-type (BPE) model, exact, by backtracking.

Encoding a normalised text:

1. The text is cut where no piece of the vocabulary can reach across: before a run of the space mark, and
   around characters that no piece holds. Pieces on both sides of such a cut never merge, so each part is
   encoded alone. Arrow cuts the texts and numbers their distinct parts (words); only those that the worker hasn't met are
   encoded, and the ids of all are gathered from a table. A word that wasn't met is cut once more, between Latin letters that
   no piece holds side by side.
2. In a part, the trie of an Aho-Corasick automaton over all pieces gives the longest piece at a place; the
   shorter ones follow from it by a table (the next shorter piece that a piece begins with).
3. Backtracking takes the longest piece at the current place that is *compatible* with the piece before it:
   merging the two pieces' characters anew by score must give exactly these two pieces. A sequence whose
   neighbours are all compatible is the merge result, and a place that one compatible sequence cannot be
   carried on from is not on it; a bitfield of failed places keeps each from being tried twice.
4. A character that is no piece is written as its UTF-8 bytes (byte fallback) or the unknown id.

Decoding joins the pieces' bytes, drops the mark that the encoder put before the text and turns marks into
spaces.

Defined results: null text is the empty text (begin and end id only, decoded as empty); repeated rows are
encoded each; an empty table gives an empty result; a text of any length is taken whole, memory being
proportional to its longest part without a cut. Extra columns of the input are left behind.
"""

from __future__ import annotations

import math
import re
import string
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text

MARK = "▁"
ALONE, UNKNOWN = 0xFFFFFFFF, -0xFFFFFFFF
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
#: Entries in each half of what a worker keeps of encoded words and of checked pairs, and characters of text looked at together;
#: results don't depend on either.
CACHE_ENTRIES, TOGETHER = 200_000, 1 << 20
#: Code points below are looked up in a table of neighbours.
LATIN = 0x250


class _Table(dict):
    """A dict that computes what it lacks; when full it becomes the older half, and what is used again moves back."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class MergeCodec:
    """One loaded model: ``encode(text)`` to little-endian uint32 bytes, ``decode(bytes)`` to text."""

    def __init__(self, model_file: str, cache_entries: int = CACHE_ENTRIES):
        import ahocorasick
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        self.ids: dict[str, int] = {}
        self.rank: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.raw: list[bytes] = []
        self.marked = np.zeros(sp.get_piece_size(), dtype=bool)  # pieces that begin with the mark
        self.plain = set()  # control ids, written as nothing
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i):
                self.plain.add(i)
                self.raw.append(b"")
            elif sp.is_unknown(i):
                self.raw.append(sp.decode([i]).encode())
            else:
                if sp.is_unused(i):
                    raise ValueError("a model with unused pieces is not supported")
                self.ids[piece] = i
                self.rank[piece] = -sp.get_score(i)
                self.marked[i] = piece[0] == MARK
                self.raw.append(piece.replace(MARK, " ").encode())
        self.bytes_of = pa.array(self.raw, pa.large_binary())
        self.text_of = {i: piece for piece, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.most = max(map(len, self.ids))
        self.length = [len(self.text_of.get(i, "")) for i in range(sp.get_piece_size())]
        # of all beginnings of pieces, the longest piece in it (UNKNOWN: none)
        self.best: dict[str, int] = {}
        for piece, i in sorted(self.ids.items()):  # a piece comes after those that it begins with
            for n in range(1, len(piece)):
                if piece[:n] not in self.best:
                    self.best[piece[:n]] = self.ids.get(piece[:n], self.best.get(piece[:n - 1], UNKNOWN))
            self.best[piece] = i
        # the next shorter piece that a piece begins with; UNKNOWN: only its first character, which is none
        self.shorter: list[int | None] = [None] * sp.get_piece_size()
        for piece, i in self.ids.items():
            if len(piece) > 1:
                self.shorter[i] = next((j for n in range(len(piece) - 1, 0, -1) if (j := self.ids.get(piece[:n])) is not None), UNKNOWN)
        self.parts, self.cut = self._cutters()
        self.compatible = _Table(self._compatible, cache_entries)  # by first id * 2**32 + second id
        self.apart = self._never_neighbours()
        self.pieces_of = _Table(self._encode_word, max(1, cache_entries // 4))  # of parts of words
        self.most_words = cache_entries
        self.known: dict[bytes, bytes] = {}  # ids of words, both serialised
        self.older: dict[bytes, bytes] = {}

    def _cutters(self) -> tuple[Callable[[str], list[str]], Callable[[pa.Array], pa.Array] | None]:
        """Cut a text, and an array of texts (where a zero character comes to stand), only where no piece holds both neighbouring characters."""
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            return (lambda s: [s] if s else []), None
        held = set("".join(self.ids))
        alone = re.escape("".join(c for c in map(chr, range(32)) if c not in held))
        words = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + f"|[{alone}]" * bool(alone)).findall
        follows: dict[str, set[str]] = {}
        for p in self.ids:
            for c, d in zip(p, p[1:]):
                follows.setdefault(d, set()).add(c)
        letters = {c for c in map(chr, range(0x41, LATIN)) if c.isalpha()}
        tails = "".join(d for d in string.punctuation if not letters & follows.get(d, set()))

        def cut(texts: pa.Array) -> pa.Array:
            texts = pc.replace_substring(pc.replace_substring(texts, MARK, "\x00" + MARK), MARK + "\x00", MARK)
            if "\n" not in held:
                texts = pc.replace_substring(texts, "\n", "\x00\n\x00")
            return pc.replace_substring_regex(texts, f"([A-Za-zÀ-ÖØ-öø-ɏ])([{re.escape(tails)}])", "\\1\x00\\2") if tails else texts

        return words, cut if "\x00" not in held else None

    def _never_neighbours(self) -> np.ndarray:
        """By two code points below LATIN: both are in pieces, but in none side by side."""
        held = np.zeros(LATIN, dtype=bool)
        held[[ord(c) for c in set("".join(self.ids)) if ord(c) < LATIN]] = True
        apart = held[:, None] & held
        for p in self.ids:
            for c, d in zip(p, p[1:]):
                if ord(c) < LATIN and ord(d) < LATIN:
                    apart[ord(c), ord(d)] = False
        return apart

    def merged(self, text: str) -> list[str]:
        """The characters of a short text, merged best score first and leftmost among equals."""
        parts = list(text)
        rank, none = self.rank.get, math.inf
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:])]  # of each part with the next
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            whole = parts[at] + parts.pop(at + 1)
            parts[at] = whole
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + whole, none)
            if at < len(ranks):
                ranks[at] = rank(whole + parts[at + 1], none)
        return parts

    def _compatible(self, pair: int) -> bool:
        """The two pieces are what merging their characters gives; first id 0xFFFFFFFF: the second alone."""
        first, second = pair >> 32, self.text_of[pair & 0xFFFFFFFF]
        if first == ALONE:
            return self.merged(second) == [second]
        return self.merged(self.text_of[first] + second) == [self.text_of[first], second]

    def backtrack(self, part: str) -> list[int]:
        """The piece ids of one part; a character that is no piece is minus its code point, minus 1."""
        n, length, shorter, compatible, best = len(part), self.length, self.shorter, self.compatible, self.best
        reach, most = self.automaton.longest_prefix, self.most
        failed: bytearray | None = None
        ids: list[int] = []
        place, last = 0, ALONE
        while True:
            ahead = part[place:place + most]
            i: int | None = best[ahead[:k]] if (k := reach(ahead)) else UNKNOWN
            if failed is None and last >= 0 and i >= 0:  # the usual case: no place has failed, pieces on both sides
                pair = last << 32
                while not compatible[pair | i]:
                    i = shorter[i]
                    if i is None or i < 0:
                        break
                else:
                    ids.append(i)
                    place += length[i]
                    if place == n:
                        return ids
                    last = i
                    continue
            while True:
                if i == UNKNOWN:
                    i = -1 - ord(part[place])
                while i is not None:
                    if i >= 0:
                        end = place + length[i]
                        fits = compatible[(last if last >= 0 else ALONE) << 32 | i]
                        if fits and (failed is None or not failed[end >> 3] >> (end & 7) & 1):
                            break
                        i = shorter[i]
                        if i == UNKNOWN:
                            i = -1 - ord(part[place])
                    else:
                        end = place + 1
                        if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                            break
                        i = None
                if i is not None:
                    break
                if failed is None:
                    failed = bytearray((n >> 3) + 1)  # a bitfield of places
                failed[place >> 3] |= 1 << (place & 7)
                i = ids.pop()
                place -= length[i] if i >= 0 else 1
                last = ids[-1] if ids else ALONE
                i = shorter[i] if i >= 0 else None
            ids.append(i)
            if end == n:
                return ids
            place, last = end, i

    def _encode_word(self, word: str) -> bytes:
        ids = self.backtrack(word) if word else []
        if ids and min(ids) < 0:
            ids = self._fallback(ids)
        return array("I", ids).tobytes() if LITTLE else np.array(ids, dtype="<u4").tobytes()

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that weren't met, each the ids of its parts."""
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        starts = np.cumsum([0, *map(len, words)])
        cut = np.zeros(len(codes) + 1, dtype=bool)
        if len(codes):
            cut[1:-1] = self.apart[np.minimum(codes[:-1], LATIN - 1), np.minimum(codes[1:], LATIN - 1)] & (codes[:-1] < LATIN) & (codes[1:] < LATIN)
        cut[starts] = True
        places = np.flatnonzero(cut)
        parts = [text[a:b] for a, b in zip(places.tolist(), places[1:].tolist())]
        first = np.searchsorted(places, starts).tolist()
        encoded, known = self._encode_word, self.pieces_of
        return [encoded(word) if b - a < 2 else b"".join([known[p] for p in parts[a:b]]) for word, a, b in zip(words, first, first[1:])]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words."""
        if len(self.known) >= self.most_words:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, words))
        other = []
        for k, ids in enumerate(found):
            if ids is None:
                ids = older.get(words[k])
                if ids is None:
                    other.append(k)
                else:
                    found[k] = known[words[k]] = ids
        for k, ids in zip(other, self._encode_words([words[k].decode() for k in other])):
            found[k] = known[words[k]] = ids
        return found

    def _fallback(self, ids: list[int]) -> list[int]:
        out: list[int] = []
        for i in ids:
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in chr(-1 - i).encode()]
            elif not out or out[-1] != self.unk:
                out.append(self.unk)
        return out

    def encode(self, text: str, begin: bool = True, end: bool = True) -> bytes:
        return self.encode_all([text], begin, end)[0]

    def encode_all(self, texts: list[str], begin: bool = True, end: bool = True) -> list[bytes]:
        """Serialised ids of each text, TOGETHER characters of text at a time, so that memory stays small."""
        sizes = np.cumsum([*map(len, texts)])
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            beyond = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER, side="right")))
            out += self._together(texts[at:beyond])
            at = beyond
        first, last = (np.uint32(i).astype("<u4").tobytes() if wanted else b"" for i, wanted in ((self.bos, begin), (self.eos, end)))
        return [first + ids + last for ids in out]

    def _together(self, texts: list[str]) -> list[bytes]:
        texts = list(map(self.sp.normalize, texts))
        whole = [self.cut is None or "\x00" in t for t in texts]
        other = iter([b"".join(self._words([p.encode() for p in self.parts(t)])) for t, w in zip(texts, whole) if w])
        lists = pc.split_pattern(self.cut(pa.array([t for t, w in zip(texts, whole) if not w], pa.string())), "\x00") if not all(whole) else None
        if lists is None:
            return list(other)
        distinct = lists.flatten().dictionary_encode()
        number = distinct.indices.to_numpy()
        _, at, data = distinct.dictionary.buffers()
        data, at = data.to_pybytes() if data else b"", np.frombuffer(at, np.int32)[:len(distinct.dictionary) + 1].tolist()
        ids = self._words([data[a:b] for a, b in zip(at, at[1:])])
        table = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(length) - length
        each = length[number]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = table[np.repeat(first[number] - ends[:-1], each) + np.arange(ends[-1])].tobytes()
        cuts = 4 * ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])]
        own = (flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return [next(other if w else own) for w in whole]

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").astype(np.uint32, copy=False)
        _, at, data = self.bytes_of.take(pa.array(ids)).buffers()
        out = data.slice(0, int(np.frombuffer(at, np.int64)[len(ids)])).to_pybytes() if data else b""
        first = next((i for i in ids if i not in self.plain), None)
        if first is not None and self.marked[first]:
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:  # byte pieces that are no text: the library's replacement rule
            return self.sp.decode(ids.tolist())


_CODECS: dict[str, MergeCodec] = {}


def codec(model_file: str) -> MergeCodec:
    """The worker's codec of a model file, loaded once."""
    if model_file not in _CODECS:
        _CODECS[model_file] = MergeCodec(model_file)
    return _CODECS[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
           begin: bool = True, end: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (binary: little-endian uint32)."""
    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        own = codec(model_file)
        return pd.Series(own.encode_all(texts.tolist(), begin, end), dtype=object)

    out = id_text(docs, id_col, text_col).select("doc_id", encoded("text").alias("ids"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its packed ids; null ids are the empty text."""
    @F.pandas_udf("string")
    def decoded(packed: pd.Series) -> pd.Series:
        own = codec(model_file)
        return pd.Series([own.decode(p or b"") for p in packed], dtype=object)

    return encoded.withColumn(out_col, decoded(F.col(ids_col)))


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids and decoded, the text of these ids, as ``decode(encode(docs))``.

    One function gives both: Spark puts ``encode``'s into ``decode``'s and would encode every text twice.
    """
    @F.pandas_udf("ids binary, decoded string")
    def both(texts: pd.Series) -> pd.DataFrame:
        own = codec(model_file)
        ids = own.encode_all(texts.tolist())
        return pd.DataFrame({"ids": ids, "decoded": list(map(own.decode, ids))}, dtype=object)

    out = id_text(docs, id_col, text_col).select("doc_id", both("text").alias("both"))
    return out.select("doc_id", (F.octet_length("both.ids") / 4).cast("long").alias("n_tokens"), "both.ids", "both.decoded")


def unpacked(ids_col: str = "ids"):
    """Column: packed ids as array<long>, for readers in SQL."""
    hexed = F.hex(F.col(ids_col))
    return F.transform(
        F.sequence(F.lit(0), (F.octet_length(ids_col) / 4).cast("int") - 1),
        lambda i: F.conv(F.concat(*[F.substring(hexed, i * 8 + 2 * b + 1, F.lit(2)) for b in (3, 2, 1, 0)]), 16, 10).cast("long"))
