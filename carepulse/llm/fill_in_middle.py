"""Fill-in-middle transformation over a sparse exception index.

A text's bytes and its code points differ only from its multibyte characters on. The index records those alone: the byte place of
each and the running sum of the bytes that they have beyond one. A cut given in code points becomes one in bytes, or the other way
round, by one ``searchsorted`` in these places; before the first exception, and in a text of ASCII, it is the same number. No text is
decoded, no per-character table is built: an index holds as many entries as the text has multibyte characters.

Each document is cut into prefix, middle and suffix at two places drawn from the sha256 of ``seed:doc_id``, so a recomputed or retried task
gives the same result and no state is shared. Units are ``tokens`` (white space with the word after it, or trailing white space; white
space is space and tab to carriage return) or ``chars`` (code points). Forms: ``plain`` (the text), ``psm`` (prefix, suffix, middle) and ``spm``
(suffix, prefix, middle), each part after its mark. :func:`restored` gives the text back from output and form alone.

Rows are independent: no exchange; a task holds one batch of texts.

Defined results: null and empty texts are plain with n = 0; a text that contains a mark is plain; a null id draws from the hash of the
seed alone; repeated rows give equal results; an empty table gives an empty result; a text is taken whole at any length. Extra
columns of the input are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepulse.llm.common import id_text

#: The marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class SparseIndex:
    """Places of the multibyte characters of UTF-8 bytes, and their excess bytes."""

    def __init__(self, data: bytes):
        self.size = len(data)
        if data.isascii():
            self.bytes_at = self.chars_at = np.empty(0, np.int64)
            self.excess = np.zeros(1, np.int64)
        else:
            lead = np.frombuffer(data, np.uint8)
            self.bytes_at = np.flatnonzero(lead >= 0xC0)
            lead = lead[self.bytes_at]
            self.excess = np.concatenate([[0], np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0))])  # ahead of each, and in all
            self.chars_at = self.bytes_at - self.excess[:-1]

    @property
    def chars(self) -> int:
        return self.size - int(self.excess[-1])

    def to_byte(self, char: int) -> int:
        """Where the code point ``char`` begins."""
        return char + int(self.excess[np.searchsorted(self.chars_at, char)])

    def to_char(self, byte: int) -> int:
        """How many code points lie before the place ``byte``, where one begins."""
        return byte - int(self.excess[np.searchsorted(self.bytes_at, byte)])


def token_ends(data: bytes) -> np.ndarray:
    """The byte places where the tokens end."""
    if not data:
        return np.empty(0, np.int64)
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.append(ends, len(data))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers below 2**32 of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4)]


def transformed(data: bytes, drawn: Sequence[int], unit: str, rate: int, spm: int, marks: Sequence[bytes]) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    index = SparseIndex(data)
    ends = token_ends(data) if unit == "tokens" else None
    n = index.chars if ends is None else len(ends)
    if not data or drawn[2] % 100 >= rate or any(m in data for m in marks):
        return n, "plain", None, None, data
    cuts = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    if ends is None:
        a, b = map(index.to_byte, cuts)
        first, second = cuts
    else:
        a, b = (int(ends[c - 1]) if c else 0 for c in cuts)
        first, second = index.to_char(a), index.to_char(b)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = marks
    if drawn[3] % 100 < spm:
        return n, "spm", first, second - first, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, second - first, b"".join((p, prefix, s, suffix, m, middle))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, seed: int = 42, rate: int = 50, spm: int = 80,
              unit: str = "tokens", marks: Sequence[str] = MARKS) -> DataFrame:
    """Per row: doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain), output.

    ``rate`` of 100 documents are cut, ``spm`` of 100 of them put the suffix first. A mark's first character may not
    come again in any mark: then no text around a mark can be taken for one.
    """
    if unit not in ("tokens", "chars"):
        raise ValueError("unit is tokens or chars")
    if len(set(marks)) != 3 or not all(marks) or any(m[0] in other[1:] for m in marks for other in marks):
        raise ValueError("marks must be three different texts whose first characters come nowhere else in them")
    coded = [m.encode() for m in marks]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            rows = [transformed(data, draws(seed, i), unit, rate, spm, coded)
                    for i, data in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns[:-1], columns[-1].cast(pa.string())],
                                             ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(cut, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output of a form was made of."""
    def between(first: str, second: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(first), F.lit(2)), F.lit(second), F.lit(1))

    p, s, m = marks
    middle = F.split_part(output, F.lit(m), F.lit(2))
    return (F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output))
