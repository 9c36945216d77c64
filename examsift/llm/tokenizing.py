"""Encoding of a corpus with a public byte-level BPE tokenizer.

The ``tokenizers`` library does the merging. A byte-level tokenizer of this kind never joins text
across a space that stands before a non-space, so a text can be cut at those spaces, each distinct
piece be encoded once per worker and the results be put together again. Corpora repeat their pieces
(words with their punctuation) so often that this is several times as fast as encoding whole texts,
and it is exact: tests compare both ways. A tokenizer of another kind gets whole texts.

Defined results: null and empty texts have no ids (an empty array), no offsets and a count of 0.
"""

from __future__ import annotations

import importlib.util
import json
import os
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.runtime import worker_state

#: Pieces whose ids a worker keeps; beyond it the memory is emptied and filled anew.
KEPT_PIECES = 300_000
#: Texts whose pieces are held at once.
TEXTS_AT_ONCE = 256


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a vocabulary file: in the folder that EXAMSIFT_TOKENIZERS names, else among the public tokenizers installed beside Python."""
    folder = os.environ.get("EXAMSIFT_TOKENIZERS")
    if not folder:
        spec = importlib.util.find_spec("public_tokenizers")
        if not spec or not spec.origin:
            raise ValueError("give a vocabulary file, or name its folder in EXAMSIFT_TOKENIZERS")
        folder = os.path.dirname(spec.origin)
    return os.path.join(folder, name)


def cuts_at_spaces(tokenizer: Any) -> bool:
    """Whether a tokenizer never joins text across a space before a non-space: a byte-level one that splits by its own pattern
    and changes no text before."""
    parts = json.loads(tokenizer.to_str())
    split = parts.get("pre_tokenizer") or {}
    return parts.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)


class PieceEncoder:
    """Encodes texts piece by piece and remembers pieces."""

    def __init__(self, vocabulary: str, kept: int = KEPT_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text here
        self.kept, self.by_pieces = kept, cuts_at_spaces(self.tokenizer)
        self.first: dict[str, bytes] = {}  # pieces at the start of a text
        self.later: dict[str, bytes] = {}  # pieces after a space
        self.cut = re.compile(r" (?=\S)").split
        self.needs_care = re.compile(r"\s ").search

    def pieces(self, text: str) -> list[str]:
        if not self.by_pieces:
            return [text]
        return self.cut(text) if self.needs_care(text) else text.split(" ")

    def learn(self, split: list[list[str]]) -> None:
        if len(self.first) + len(self.later) > self.kept:
            self.first.clear()
            self.later.clear()
        for memory, lead, seen in ((self.first, "", {p[0] for p in split}), (self.later, " ", {x for p in split for x in p[1:]})):
            new = [x for x in seen if x not in memory]
            for start in range(0, len(new), 20_000):
                part = new[start : start + 20_000]
                for piece, done in zip(part, self.tokenizer.encode_batch_fast([lead + x for x in part], add_special_tokens=False)):
                    memory[piece] = np.asarray(done.ids, dtype=np.int32).tobytes()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self.pieces(t) for t in texts]
        self.learn(split)
        later = self.later.__getitem__
        return [self.first[p[0]] + b"".join(map(later, p[1:])) for p in split]

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) // 4 for x in self.ids(texts)]

    def offsets(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """First and past-the-last character of each token; tokens inside one character share its place."""
        return [x.offsets for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


def _encoder(vocabulary: str) -> PieceEncoder:
    return worker_state(f"pieces:{vocabulary}", lambda: PieceEncoder(vocabulary))


def _blocks(array: pa.Array) -> Iterator[list[str | None]]:
    for start in range(0, len(array), TEXTS_AT_ONCE):
        yield array.slice(start, TEXTS_AT_ONCE).to_pylist()


def token_ids(text: Column, vocabulary: str | None = None) -> Column:
    """ARRAY<INT> of the ids of ``text``, without special tokens."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for batch in batches:
            done, lengths = [], [0]
            for block in _blocks(batch):
                ids = encoder.ids([t for t in block if t])
                done.extend(ids)
                at = iter(ids)
                lengths.extend(len(next(at)) // 4 if t else 0 for t in block)
            values = pa.Array.from_buffers(pa.int32(), sum(lengths), [None, pa.py_buffer(b"".join(done))])
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), values)

    return encode(text)


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    """BIGINT number of tokens of ``text``."""
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(T.LongType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for batch in batches:
            out: list[int] = []
            for block in _blocks(batch):
                at = iter(encoder.counts([t for t in block if t]))
                out.extend(next(at) if t else 0 for t in block)
            yield pa.array(out, pa.int64())

    return count(text)


def token_offsets(text: Column, vocabulary: str | None = None) -> Column:
    """ARRAY<STRUCT<id, start, end>>: each token with the characters (code points) it covers."""
    path = vocabulary or default_vocabulary()
    kind = T.ArrayType(T.StructType([T.StructField("id", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))

    @F.arrow_udf(kind)
    def locate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        fields = pa.struct([("id", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            out = []
            for block in _blocks(batch):
                texts = [t or "" for t in block]
                for encoding in encoder.tokenizer.encode_batch(texts, add_special_tokens=False):
                    out.append([{"id": i, "start": a, "end": b} for i, (a, b) in zip(encoding.ids, encoding.offsets)])
            yield pa.array(out, pa.list_(fields))

    return locate(text)


def byte_table() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary, reversed.

    Printable Latin-1 bytes stand for themselves; the other bytes take code points from 256 on.
    """
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def decoded(ids: Column, vocabulary: str | None = None) -> Column:
    """STRING of token ids by the reversed byte table.

    Bytes are joined before they are read as UTF-8, so characters split over tokens come out whole;
    bytes that form no character become U+FFFD. Null ids give null, an empty array an empty string,
    unknown ids nothing.
    """
    path = vocabulary or default_vocabulary()

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def make() -> dict[int, bytes]:
            table = byte_table()
            return {i: bytes(table[c] for c in token) if all(c in table for c in token) else token.encode() for token, i in _encoder(path).tokenizer.get_vocab(True).items()}

        known = worker_state(f"bytes:{path}", make)
        for batch in batches:
            yield pa.array([None if x is None else b"".join(known.get(i, b"") for i in x).decode("utf-8", "replace") for x in batch.to_pylist()], pa.string())

    return decode(ids)


def encode_corpus(df: DataFrame, text: str = "text", out: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` in ``out`` (a column of that name is replaced).

    One narrow pass: nothing is shuffled, and only ``text`` goes to Python.
    """
    return df.withColumn(out, token_ids(F.col(f"`{text}`"), vocabulary))
