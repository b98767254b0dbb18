"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A byte-level vocabulary writes each byte as one printable character. Encoding therefore yields tokens
over bytes; decoding maps a token's characters back through the byte table and joins the bytes, so a
character that is split between tokens comes back whole.

Text is cut before every single space that stands between two non-space characters. The
pre-tokenizer always breaks there, so pieces can be encoded apart, and each distinct piece goes to the
library once per worker (a bounded cache).

Defined results: null and empty text give no ids, empty bytes, and offsets of length zero. Extra
columns of the input are kept by encode() and decode(); a clashing column is replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CACHED_PIECES = 400_000

_BREAK = re.compile(r"(?<=\S) (?=\S)")


def byte_table() -> dict[str, int]:
    """Character to byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """The tokenizer of one vocabulary file, as a worker holds it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per Spark task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        table = byte_table()
        self.bytes_of: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.bytes_of[k] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        self.digits = [str(k) for k in range(len(self.bytes_of))]
        self.first: dict[str, list[int]] = {}
        self.later: dict[str, list[int]] = {}

    def _learn(self, cache: dict[str, list[int]], pieces: Iterable[str], lead: str) -> None:
        new = list({p for p in pieces if p not in cache})
        if new:
            if len(cache) + len(new) > CACHED_PIECES:
                cache.clear()
                new = list(set(pieces))
            done = self.tokenizer.encode_batch_fast([lead + p for p in new], add_special_tokens=False)
            cache.update(zip(new, (x.ids for x in done), strict=True))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        head, *rest = _BREAK.split(text)
        self._learn(self.first, [head], "")
        self._learn(self.later, rest, " ")
        return list(chain(self.first[head], chain.from_iterable(map(self.later.__getitem__, rest))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def offsets(self, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last character that each token touches, in code points."""
        data = np.frombuffer(self.decode(ids), np.uint8)
        char_of = np.cumsum((data & 0xC0) != 0x80) - 1  # the character to which each byte belongs
        ends = np.cumsum([len(self.bytes_of[k]) for k in ids], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ids) else ends
        return char_of[starts], char_of[ends - 1] + 1


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _with(df: DataFrame, **new: T.DataType) -> T.StructType:
    lower = {k.lower() for k in new}
    kept = [f for f in df.schema.fields if f.name.lower() not in lower]
    return T.StructType(kept + [T.StructField(k, t) for k, t in new.items()])


def encode(df: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """df with token_ids, starts and ends (code points) of every text."""
    ints = T.ArrayType(T.IntegerType())
    schema = _with(df, token_ids=ints, starts=ints, ends=ints)
    kept = [f.name for f in schema.fields[:-3]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            ids = [c.encode(x.as_py()) for x in b.column(text_col)]
            spans = [c.offsets(x) for x in ids]
            new = [pa.array(x, pa.list_(pa.int32())) for x in (ids, [s.astype(np.int32) for s, _ in spans], [e.astype(np.int32) for _, e in spans])]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), *new], names=[*kept, "token_ids", "starts", "ends"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids_col: str = "token_ids") -> DataFrame:
    """df with decoded (binary) of every id list."""
    schema = _with(df, decoded=T.BinaryType())
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            new = pa.array([c.decode(x.as_py() or []) for x in b.column(ids_col)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), new], names=[*kept, "decoded"])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass; only digests leave the worker.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256, n_split_tokens (tokens that end inside a
    character) and exact (the decoded bytes are the text's).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            rows: list[tuple] = []
            for x in b.column("_text"):
                text = x.as_py() or ""
                ids = c.encode(text)
                data = c.decode(ids)
                if len(data) == len(text):
                    split = 0
                else:
                    ends = np.cumsum(np.fromiter((len(c.bytes_of[k]) for k in ids), np.int64, len(ids)))[:-1]
                    split = int(((np.frombuffer(data, np.uint8)[ends] & 0xC0) == 0x80).sum())
                rows.append((len(ids), sha(" ".join(map(c.digits.__getitem__, ids)).encode()), sha(data), split, data == text.encode()))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(id_col), *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "n_split_tokens", "exact"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split_tokens long, exact boolean"
    )
