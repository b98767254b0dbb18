"""Suffix-array dedup: remove every byte inside a string of LENGTH bytes that also starts elsewhere.

The suffixes of a large corpus cannot be shuffled one by one, so strings first meet by content:

1. Each string of LENGTH bytes has an anchor, the run of GRAM bytes in it with the least hash (the first of
   equals). The anchor follows from the string alone, so equal strings have equal anchors at equal
   places. Neighbouring strings mostly share an anchor, so a document falls into pieces: maximal runs of
   starts with one anchor. A piece is two hashes, of the anchor and of all its bytes.
2. An anchor hash seen once cannot repeat. Of the others, each different piece is one row with its multiplicity;
   counts aggregate partially, so copies weigh one row for each task.
3. One text for each different piece is fetched, dealt by anchor, and sorted as suffixes by the two-stage method
   (see suffix_array). Adjacent common prefixes join equal strings, and a string repeats if the multiplicities of
   its pieces add up to two or more. Work is in portions of about PORTION bytes.
4. An anchor with more than MANY different pieces falls apart by a longer common context: strings whose anchor
   stands at nearly the same place share more bytes around it than the anchor alone. Such parts of pieces are
   groups like those before, so copies collapse again, and each is sorted as in step 3. If a part is still too
   large, the places are cut finer, down to single ones, where a group is one string.
5. Repeated starts return to their documents, and the bytes they cover go.

Every stage is linear in the bytes of the input. Equal pieces meet by 128 hash bits, all else by the bytes themselves.

Defined results: null and empty texts have no bytes and lose none. Texts under LENGTH bytes stay whole.
Rows with equal ids count as separate documents. Extra columns do not matter. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.keys import number
from wakeline.llm.suffix_array import repeated_starts
from wakeline.session import settle

LENGTH = 200
GRAM = 64
PORTION = 1 << 20
MANY = 4_000
BUFFER = 1 << 19  # bytes that one pass of the anchor search takes

_PLACE_BITS = 20


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64, and a random number for each byte."""
    base, size = 0x9E3779B97F4A7C15, 1 << _PLACE_BITS
    inverse = pow(base, -1, 1 << 64)

    def powers(x: int) -> np.ndarray:
        out = np.ones(size, np.uint64)
        n = 1
        while n < size:
            out[n : 2 * n] = out[:n] * np.uint64(pow(x, n, 1 << 64))
            n *= 2
        return out

    return powers(base), powers(inverse), np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _windowed_least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of x[i : i + n] for each i."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (n - size)], x[n - size :]) if n > size else x


def pieces(data: np.ndarray, lengths: list[int], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, start, starts, anchor's place after the start, anchor hash, piece hash) of the pieces of the concatenated texts."""
    up, down, letters = _powers()
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(letters[data] * up[:n], out=sums[1:])
    grams = _mix((sums[gram:] - sums[:-gram]) * down[: n + 1 - gram])
    high = np.uint64((1 << 64) - (1 << _PLACE_BITS))
    least = _windowed_least((grams & high) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    anchor = (least & ~high).astype(np.int64)
    ends = np.cumsum(lengths)
    first = ends - lengths
    valid = np.zeros(len(anchor) + 1, np.int8)
    for f, e in zip(first.tolist(), ends.tolist(), strict=True):
        if e - f >= length:
            valid[f : e - length + 1] = 1
    valid = valid[:-1].astype(bool)
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    start = np.flatnonzero(new)
    if not len(start):
        return (np.empty(0, np.int64),) * 6
    count = np.add.reduceat(valid.astype(np.int64), start)
    text = np.searchsorted(ends, start, side="right")
    at = anchor[start]
    stop = start + count + length - 1
    whole = (sums[stop] - sums[start]) * down[start]
    whole = _mix(_mix(whole) ^ (count.astype(np.uint64) << np.uint64(20)) ^ (at - start).astype(np.uint64))
    return text, start - first[text], count, at - start, grams[at].view(np.int64), whole.view(np.int64)


def _segments(texts: Iterator[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Buffers of (row, offset, bytes): short texts together, long ones in parts that overlap by length - 1."""
    rows, at, parts, size = [], [], [], 0
    for k, text in enumerate(texts):
        for a in range(0, max(1, len(text) - length + 1), BUFFER):
            part = text[a : a + BUFFER + length - 1]
            if len(part) < length:
                continue
            if size + len(part) > BUFFER + length and parts:
                yield rows, at, parts
                rows, at, parts, size = [], [], [], 0
            rows.append(k)
            at.append(a)
            parts.append(part)
            size += len(part)
    if parts:
        yield rows, at, parts


_KEY = ["_id", "_h"]


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _h, _text: rows with equal keys have equal texts, so what holds for one holds for all."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.coalesce(number(df, id_col), F.xxhash64(text)).alias("_id"), F.hash(text).alias("_h"), text.alias("_text"), F.col(id_col).alias("_own"))


def _pieces(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, hs = (b.column(k).to_numpy(zero_copy_only=False) for k in _KEY)
            texts = (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column("_text"))
            for rows, at, parts in _segments(texts, length):
                text, start, count, _, kh, ph = pieces(np.frombuffer(b"".join(parts), np.uint8), [len(p) for p in parts], length, gram)
                row = np.array(rows)[text]
                cols = [kh, ph, ids[row], hs[row], (start + np.array(at)[text]).astype(np.int32), count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kh", "ph", "_id", "_h", "start", "n"])

    return keyed.select(*_KEY, "_text").mapInArrow(run, "kh long, ph long, _id long, _h int, start int, n int")


def _fetched(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """kh, ph, c, piece (its bytes) of the wanted pieces (kh, ph, c, rep)."""
    asked = wanted.select("rep._id", "rep._h", F.struct("kh", "ph", "c", "rep.start", "rep.n").alias("w")).groupBy(*_KEY).agg(F.collect_list("w").alias("_asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kh, ph, c, out = [], [], [], []
            for x, asked in zip(b.column("_text"), b.column("_asked"), strict=True):
                data = x.as_buffer().to_pybytes()
                for w in asked.as_py():
                    kh.append(w["kh"])
                    ph.append(w["ph"])
                    c.append(w["c"])
                    out.append(data[w["start"] : w["start"] + w["n"] + length - 1])
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (kh, ph, c)), pa.array(out, pa.binary())], names=["kh", "ph", "c", "piece"])

    # of rows with one key any text will do, and each may answer: equal answers collapse
    texts = keyed.select(*_KEY, "_text")
    return texts.join(asked, _KEY).mapInArrow(run, "kh long, ph long, c long, piece binary").dropDuplicates(["kh", "ph"])


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return [(int(p[0]), len(p)) for p in np.split(starts, cut)]


_SPANS = pa.list_(pa.struct([("o", pa.int32()), ("n", pa.int32())]))


def _sorted_groups(found: DataFrame, length: int, portion: int) -> DataFrame:
    """kh, ph, spans (runs of repeated starts) by suffix arrays over portions of whole anchor groups."""

    def solve(kh: list[int], ph: list[int], count: list[int], piece: list[bytes]) -> pa.RecordBatch:
        spans = [[{"o": o, "n": n} for o, n in _runs(s)] for s in repeated_starts(piece, length, np.array(count))]
        return pa.RecordBatch.from_arrays([pa.array(kh, pa.int64()), pa.array(ph, pa.int64()), pa.array(spans, _SPANS)], names=["kh", "ph", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("kh", "ph", "c", "piece")), strict=True):
                if size >= portion and row[0] != rows[-1][0]:
                    yield solve(*map(list, zip(*rows, strict=True)))
                    rows, size = [], 0
                rows.append(row)
                size += len(row[-1])
        if rows:
            yield solve(*map(list, zip(*rows, strict=True)))

    return found.repartition("kh").sortWithinPartitions("kh", "ph").mapInArrow(run, "kh long, ph long, spans array<struct<o:int,n:int>>")


def _parts(found: DataFrame, length: int, gram: int, width: int) -> DataFrame:
    """Pieces cut into parts whose strings have the anchor within width places: kh (hash of the bytes that all strings with
    the anchor there share), ph (of the part), the whole piece's keys of_kh and of_ph, where the part starts in it, c, piece."""

    def number(of: bytes, *more: int) -> int:
        tail = b"".join(k.to_bytes(8, "little", signed=True) for k in more)
        return int.from_bytes(hashlib.blake2b(of + tail, digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kh, ph, c = (b.column(k).to_pylist() for k in ("kh", "ph", "c"))
            for rows, _, texts in _segments((x.as_buffer().to_pybytes() for x in b.column("piece")), length):
                text, _, count, place, _, _ = pieces(np.frombuffer(b"".join(texts), np.uint8), [len(p) for p in texts], length, gram)
                out = []
                for k, n, at in zip(text.tolist(), count.tolist(), place.tolist(), strict=True):
                    x, row = texts[k], rows[k]
                    for j in range((at - n + 1) // width, at // width + 1):
                        last = at - j * width  # of the part's starts, if the piece goes so far
                        first = last - width + 1
                        lo, hi = max(first, 0), min(last, n - 1)
                        part = x[lo : hi + length]
                        shared = number(x[last : first + length], kh[row], j)
                        out.append((shared, number(part, at - lo), kh[row], ph[row], lo, c[row], part))
                cols = zip(zip(*out, strict=True), _PART_KINDS.values(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in cols], names=list(_PART_KINDS))

    return found.select("kh", "ph", "c", "piece").mapInArrow(run, "kh long, ph long, of_kh long, of_ph long, start int, c long, piece binary")


_PART_KINDS = {"kh": pa.int64(), "ph": pa.int64(), "of_kh": pa.int64(), "of_ph": pa.int64(), "start": pa.int32(), "c": pa.int64(), "piece": pa.binary()}


def _solved(found: DataFrame, length: int, gram: int, many: int, portion: int, width: int) -> DataFrame:
    """kh, ph, spans of the pieces (kh, ph, c, piece), whose anchors stand within width places."""
    large = settle(found.groupBy("kh").agg(F.count("*").alias("k")).where(F.col("k") > many).select("kh"))
    if width == 1 or large.isEmpty():
        return _sorted_groups(found, length, portion)
    width = max(1, width // 4)
    parts = settle(_parts(found.join(large, "kh", "left_semi"), length, gram, width))
    kinds = settle(parts.groupBy("kh", "ph").agg(F.sum("c").alias("c"), F.first("piece").alias("piece")))
    # written, like the parts, so that Spark can split the rows of a part that many pieces share
    spans = settle(_solved(kinds, length, gram, many, portion, width).where(F.size("spans") > 0))
    back = parts.select("kh", "ph", "of_kh", "of_ph", "start").join(spans, ["kh", "ph"]).select("of_kh", "of_ph", "start", F.explode("spans").alias("s"))
    whole = back.groupBy(F.col("of_kh").alias("kh"), F.col("of_ph").alias("ph")).agg(F.collect_list(F.struct((F.col("start") + F.col("s.o")).alias("o"), "s.n")).alias("spans"))
    return _sorted_groups(found.join(large, "kh", "left_anti"), length, portion).unionByName(whole)


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, many: int = MANY, portion: int = PORTION) -> DataFrame:
    """_id, _h, spans: for each document key the runs (start, n) of starts of strings that repeat."""
    keyed = _keyed(df, id_col, text_col)
    all_pieces = _pieces(keyed, length, gram)
    # written, so that both sides of the join are plain shuffles and Spark splits a hot anchor's rows
    anchors = settle(all_pieces.groupBy("kh").agg(F.count("*").alias("c")).where("c > 1").select("kh"))
    met = settle(all_pieces.join(anchors, "kh"))
    kinds = settle(met.groupBy("kh", "ph").agg(F.count("*").alias("c"), F.min(F.struct(*_KEY, "start", "n")).alias("rep")))
    found = settle(_fetched(keyed, kinds, length))
    # written for the same reason: a piece may have very many copies
    spans = settle(_solved(found, length, gram, many, portion, length - gram + 1).where(F.size("spans") > 0))
    hit = met.join(spans, ["kh", "ph"]).select(*_KEY, "start", F.explode("spans").alias("s"))
    return hit.groupBy(*_KEY).agg(F.collect_list(F.struct((F.col("start") + F.col("s.o")).alias("start"), F.col("s.n").alias("n"))).alias("spans"))


def removed(data: bytes, spans: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of bytes that the repeated strings cover."""
    if not spans:
        return []
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, [s["start"] for s in spans], 1)
    np.add.at(edge, [s["start"] + s["n"] + length - 1 for s in spans], -1)
    on = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    turn = np.flatnonzero(np.diff(on))
    return list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, many: int = MANY, portion: int = PORTION, keep_bytes: bool = True) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes left)."""
    spans = repeated_spans(df, id_col, text_col, length, gram, many, portion)
    joined = _keyed(df, id_col, text_col).join(spans, _KEY, "left").select("_own", "_text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for x, s in zip(b.column("_text"), b.column("spans"), strict=True):
                data = x.as_buffer().to_pybytes()
                gone = removed(data, s.as_py(), length)
                at = [0, *(k for g in gone for k in g), len(data)]
                kept = b"".join(data[a:e] for a, e in zip(at[::2], at[1::2], strict=True))
                rows.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("_own"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
