"""Token-id output: blocks of separately compressed documents under one shared zstandard dictionary.

Writing (``write_tokens``):

1. Documents are range-partitioned and sorted by id; each task encodes its documents with the tokenizer,
   appends the end id and serialises the ids as little-endian uint16 or uint32 (by vocabulary size).
2. One zstandard dictionary is trained on the serialised ids of a bounded sample (``SAMPLE_DOCS`` documents,
   the lowest by a hash of the id, at most ``SAMPLE_BYTES`` of each) and shipped to all tasks.
3. Every document is compressed alone against the dictionary, so a short document is read without its
   neighbours. A task packs its documents, in order, into blocks: payload, offset index (where each
   document's bytes begin), document ids, counts, the part's running id count, the dictionary's hash.

The store is two Parquet tables written by Spark's committed writers, ``dictionary`` (one row) and
``blocks``; a lost task is simply run again. ``read_tokens`` reads them back, checks the dictionary hash and
gives every document's ids and its global start: per-part totals (one row for each write task) are summed
ahead of each part, so no id passes through one task. ``read_one`` opens single documents by the index.

Defined results: null text encodes as empty (the end id alone, when there is one); rows of equal id are all
kept, ordered by their text's hash; an empty table writes an empty store; a document of any length is one
compressed record in its block. Extra input columns are left behind.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from carepulse.llm.common import id_text
from carepulse.llm.word_end_tokens import byte_letters

#: The dictionary's training sample: documents, and bytes of each.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 65_536
#: Ids in a block before it is closed (a longer document makes a longer block).
BLOCK_IDS = 1_000_000
LEVEL = 3
#: Words in each half of what a worker keeps, and bytes of text looked at together; results don't depend on either.
CACHE_ENTRIES, TOGETHER = 200_000, 1 << 23
LITTLE = sys.byteorder == "little" and array("H").itemsize == 2 and array("I").itemsize == 4

BLOCKS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
    T.StructField("dict_hash", T.StringType()), T.StructField("width", T.IntegerType()),
    T.StructField("first_doc", T.LongType()), T.StructField("last_doc", T.LongType()),
    T.StructField("start_in_part", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.ArrayType(T.LongType())),
    T.StructField("offsets", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
])


class WordTokens:
    """A byte-level BPE tokenizer, with the ids of words kept by the worker.

    The byte-level splitting pattern never holds a space after a character that is no white space, so a text can
    be cut there, also around a line end between characters that are no white space, and a word between a letter and a closing
    mark. Arrow cuts the texts and numbers their distinct words; the ids of all words are gathered from a table. Letters below
    U+0250 are one piece of the pattern and go to the tokenizer's merges; any other word goes to the library as it is. A text with
    runs of white space around spaces is encoded in one piece instead.
    """

    #: Texts that are not cut: empty, a space first, last or after white space (as characters of the pattern), or the cutting mark.
    SPACES = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in map(chr, range(0x3001)) if c.isspace()) + "]"
    WHOLE = f"^$|^ | $|{SPACES} |\\x{{0}}"
    #: Texts that are not cut around line ends.
    LINES = f"^\n|\n$|{SPACES}\n|\n{SPACES}"
    #: Where a word is cut, and a piece of letters below U+0250 in UTF-8.
    INNER = "([A-Za-zÀ-ÖØ-öø-ɏ])([,.;:!?])"
    PLAIN = re.compile(rb" ?(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|[\xC4-\xC8][\x80-\xBF]|\xC9[\x80-\x8F])+|[,.;:!?]+")

    def __init__(self, file: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype({"H": "<u2", "I": "<u4"}[self.code])
        pre = repr(self.tokenizer.pre_tokenizer)
        self.cuts = "ByteLevel" in pre and "add_prefix_space=False" in pre and self.tokenizer.normalizer is None
        # of a byte-level vocabulary every character of an id's text stands for one byte
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())])
        self.merges, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.merged = self.cuts and "BPE" in type(self.tokenizer.model).__name__ and not self.tokenizer.model.end_of_word_suffix
        self.most = cache_entries
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids_of_words(self, words: list[bytes]) -> None:
        """Learn words; those with a space before them are encoded in rows, which the splitting pattern cuts at these spaces."""
        rows, alone = [], []
        for w in words:
            (rows if w[0] == 32 and not w[-1:].isspace() and (w[-1] < 128 or not w.decode()[-1].isspace()) else alone).append(w)
        self.known.update(zip(alone, self._ids([w.decode() for w in alone])))
        for at in range(0, len(rows), 500):
            self.known.update(zip(rows[at:at + 500], self._row(rows[at:at + 500])))

    def _row(self, words: list[bytes]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode(b"".join(words).decode(), add_special_tokens=False).ids, dtype=self.dtype)
        ends = np.cumsum([*map(len, words)])
        reached = np.cumsum(self.bytes_of[ids])  # an id's length in bytes tells which word it belongs to
        cuts = np.searchsorted(reached, ends) + 1
        if reached[-1] != ends[-1] or (reached[cuts - 1] != ends).any():
            return self._ids([w.decode() for w in words])
        packed, width = ids.tobytes(), ids.itemsize
        return [packed[a:b] for a, b in zip(np.concatenate([[0], cuts[:-1] * width]).tolist(), (cuts * width).tolist())]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        if LITTLE:
            return [array(self.code, e.ids).tobytes() for e in found]
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.known) >= self.most:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        if not missing:
            return found
        again = [(w, ids) for w in missing if (ids := older.get(w)) is not None]
        known.update(again)
        if again:
            missing = [w for w in missing if w not in known]
        match, merges, letters, code = self.PLAIN.fullmatch, self.merges, self.letters, self.code
        other = []
        for w in missing:
            if self.merged and match(w):
                ids = [t.id for t in merges(w.decode("latin-1").translate(letters))]
                known[w] = array(code, ids).tobytes() if LITTLE else np.array(ids, dtype=self.dtype).tobytes()
            else:
                other.append(w)
        self._ids_of_words(other)
        return [known[w] if ids is None else ids for w, ids in zip(words, found)]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Serialised ids of each text, none of them null; TOGETHER bytes of text at a time, so that memory stays small."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.string())
        whole = pc.match_substring_regex(texts, self.WHOLE) if self.cuts else pa.array([True] * len(texts))
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).cumsum()
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            beyond = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER, side="right")))
            out += self._together(texts.slice(at, beyond - at), whole.slice(at, beyond - at))
            at = beyond
        return out

    def _together(self, texts: pa.Array, whole: pa.Array) -> list[bytes]:
        other = texts.filter(whole).to_pylist()
        cut = pc.replace_substring(texts.filter(pc.invert(whole)), " ", "\x00 ")
        cut = pc.if_else(pc.match_substring_regex(cut, self.LINES), cut, pc.replace_substring(cut, "\n", "\x00\n\x00"))
        lists = pc.split_pattern(pc.replace_substring_regex(cut, self.INNER, "\\1\x00\\2"), "\x00")
        distinct = lists.flatten().dictionary_encode()
        number = distinct.indices.to_numpy()
        _, at, data = distinct.dictionary.buffers()
        data, at = data.to_pybytes() if data else b"", np.frombuffer(at, np.int32)[:len(distinct.dictionary) + 1].tolist() if len(number) else [0]
        ids = self._words([data[a:b] for a, b in zip(at, at[1:])])
        table = np.frombuffer(b"".join(ids), self.dtype)
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        first = np.cumsum(length) - length
        each = length[number]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = table[np.repeat(first[number] - ends[:-1], each) + np.arange(ends[-1])].tobytes()
        cuts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)] * self.dtype.itemsize
        rest, own = iter(self._ids(other)), (flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return [next(rest if w else own) for w in whole.to_pylist()]


_LOADED: dict[str, WordTokens] = {}


def _tokens(file: str) -> WordTokens:
    if file not in _LOADED:
        _LOADED[file] = WordTokens(file)
    return _LOADED[file]


def _train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; where the sample is too small to train on, the sample itself serves as one."""
    import zstandard

    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def train_dictionary(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """The shared dictionary from the bounded sample; documents are chosen by id before any text is read."""
    chosen = (docs.select(F.col(id_col).cast("long").alias("doc_id")).dropna().distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS))

    @F.pandas_udf("binary")
    def serialised(texts: pd.Series) -> pd.Series:
        return pd.Series([b[:SAMPLE_BYTES] for b in _tokens(tokenizer_file).encode(texts.tolist())], dtype=object)

    rows = (id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id", "left_semi")
            .select("doc_id", serialised("text").alias("b")).orderBy("doc_id", "b").limit(SAMPLE_DOCS).collect())
    return _train([bytes(r.b) for r in rows if r.b])


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int | None,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the store of ``docs`` below ``path`` (two new folders); returns the dictionary's hash."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer_file, id_col, text_col)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "dict_hash string, bytes binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        own, part = _tokens(tokenizer_file), TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        end = b"" if end_id is None else np.array([end_id], dtype=own.dtype).tobytes()
        width = np.dtype(own.dtype).itemsize
        done = block = 0
        ids: list[int] = []
        counts: list[int] = []
        frames: list[bytes] = []

        def closed() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            row = [part, block, digest, width, ids[0], ids[-1], done, sum(counts), ids, counts, offsets, b"".join(frames)]
            return pa.RecordBatch.from_pylist([dict(zip(BLOCKS.names, row))], schema=ARROW)

        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), own.encode(batch.column("text"))):
                data += end
                ids.append(doc_id)
                counts.append(len(data) // width)
                frames.append(packer.compress(data))
                if sum_over(counts):
                    yield closed()
                    done, block = done + sum(counts), block + 1
                    ids, counts, frames = [], [], []
        if ids:
            yield closed()

    def sum_over(counts: list[int]) -> bool:
        return len(counts) % 64 == 0 and sum(counts) >= BLOCK_IDS or counts[-1] >= BLOCK_IDS

    rows = id_text(docs, id_col, text_col)
    (rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
     .mapInArrow(pack, BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    return digest


ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("dict_hash", pa.string()), ("width", pa.int32()), ("first_doc", pa.int64()),
    ("last_doc", pa.int64()), ("start_in_part", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("n_tokens", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary()),
])


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").head()
    if hashlib.sha256(bytes(row.bytes)).hexdigest() != row.dict_hash:
        raise ValueError(f"{path}: the dictionary doesn't match its hash")
    return row.dict_hash, bytes(row.bytes)


def _unpack(blocks: DataFrame, path: str, wanted: set[int] | None = None) -> DataFrame:
    """Per document of ``blocks`` (with a column base): doc_id, start, n_tokens, ids as little-endian uint32."""
    digest, dictionary = _dictionary(blocks.sparkSession, path)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(len(batch))):  # one block at a time
                if row["dict_hash"] != digest:
                    raise ValueError(f"{path}: a block was written with another dictionary")
                start, payload, kind = row["base"] + row["start_in_part"], row["payload"], f"<u{row['width']}"
                starts = (start + np.cumsum([0, *row["n_tokens"]])[:-1]).tolist()
                out = []
                for k, (doc_id, n) in enumerate(zip(row["doc_ids"], row["n_tokens"])):
                    if wanted is None or doc_id in wanted:
                        raw = reader.decompress(payload[row["offsets"][k]:row["offsets"][k + 1]]) if n else b""
                        out.append((doc_id, starts[k], n, np.frombuffer(raw, dtype=kind).astype("<u4").tobytes()))
                for at in range(0, len(out), 2000):
                    part = out[at:at + 2000]
                    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in part], kind_) for i, kind_ in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(opened, "doc_id long, start long, n_tokens long, ids binary")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a store: doc_id, start (ids before it in the whole store), n_tokens, ids (binary uint32)."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row for each write task
    ahead = W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("long").alias("base"))
    return _unpack(blocks.join(F.broadcast(bases), "part"), path)


def read_one(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The rows of one document: blocks are pruned by their id range, other documents stay compressed."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    return _unpack(blocks.withColumn("base", F.lit(0).cast("long")), path, {doc_id}).drop("start")
