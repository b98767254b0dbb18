"""SentencePiece (BPE) encoding and decoding by merge rounds over flat symbol arrays.

Each Arrow batch of texts falls into words: a merge never crosses the place where a space mark follows
another character, nor a line end, as no piece of the vocabulary spans them (checked when the model is
loaded). The distinct words that a worker has not met yet are encoded together: one flat numpy array holds
the symbols of all of them, every round takes the minimum pair rank of each word, merges its occurrences
from the left at once and compacts the arrays, until no pair remains. A batch's ids, their decimal digits
and the decoded bytes are then gathered from flat tables.

Merging all occurrences at once gives what the library's queue gives, one merge at a time, if no piece that
starts or ends with the merged one ranks before it. Pieces of which that isn't true merge once a round.

Defined results: null and empty texts give the end id only and decode to the empty text. Characters outside
the vocabulary become byte pieces; bytes that are no UTF-8 decode to U+FFFD each. Other columns are kept by
encode() and decode(); one that clashes with a new column is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.bpe import _with

SPACE = "▁"
CACHED_WORDS = 300_000
PORTION = 1_000_000  # characters
SLICE = 100_000  # ids
NONE = np.iinfo(np.int32).max  # the rank of a pair that is no piece

_WORDS = re.compile(f"\n+|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


class Table:
    """Rows of different lengths, end to end."""

    def __init__(self, rows: Sequence[bytes]):
        self.length = np.fromiter(map(len, rows), np.int64, len(rows))
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(rows), np.uint8)

    def joined(self, rows: np.ndarray) -> bytes:
        """The chosen rows end to end, gathered in slices, as an index of each byte takes more than the bytes."""
        some = (rows[i : i + SLICE] for i in range(0, len(rows), SLICE))
        return b"".join(ragged(self.flat, self.start[x], self.length[x])[0].tobytes() for x in some)


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum(length)])
    return flat[np.repeat(start - at[:-1], length) + np.arange(at[-1])], at


def portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in order, so many at a time that their words take little memory; a longer text comes alone."""
    some, held = [], 0
    for t in texts:
        n = len(t or "")
        if some and held + n > PORTION:
            yield some
            some, held = [], 0
        some.append(t)
        held += n
    if some:
        yield some


class Pieces:
    """A model file as a worker holds it."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {x.type for x in model.pieces}
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not kinds <= {1, 2, 3, 6}:
            raise ValueError("only BPE models with byte fallback, a leading space mark and texts taken as they are")
        names = [x.piece for x in model.pieces]
        own = {x.piece: k for k, x in enumerate(model.pieces) if x.type == 1}
        if any(SPACE in x.lstrip(SPACE) or "\n" in x for x in own):
            raise ValueError("a piece spans words")
        self.end = names.index("</s>")
        self.byte_id = np.array([names.index(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.is_byte = np.zeros(len(names), bool)
        self.is_byte[self.byte_id] = True
        # symbols are pieces, then single characters that only stand inside pieces
        symbol = dict(own)
        for c in sorted({c for x in own for c in x} - own.keys()):
            symbol[c] = len(names) + len(symbol) - len(own)
        self.n_pieces = len(names)
        rank_of = {s: k for k, s in enumerate(sorted({-model.pieces[k].score for k in own.values()}))}
        rank = {x: rank_of[-model.pieces[k].score] for x, k in own.items()}
        pairs, wide, bigrams = [], np.zeros(len(names), bool), set()
        for x, k in own.items():
            for i in range(1, len(x)):
                left, right = x[:i], x[i:]
                bigrams.add(ord(x[i - 1]) << 21 | ord(x[i]))
                if left in symbol and right in symbol:
                    pairs.append((symbol[left] << 32 | symbol[right], rank[x], k))
                for part in (left, right):
                    if rank.get(part, -1) >= rank[x]:
                        wide[own[part]] = True
        pairs.sort()
        self.pair_key = np.array([p[0] for p in pairs], np.int64)
        self.pair_rank = np.array([p[1] for p in pairs], np.int32)
        self.pair_piece = np.array([p[2] for p in pairs], np.int32)
        self.once = wide  # pieces that merge once a round
        self.bigram = np.array(sorted(bigrams), np.int64)
        self.symbol_of = np.full(max(ord(c) for c in symbol if len(c) == 1) + 1, -1, np.int32)
        for c, k in symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = k
        self.decimals = Table([b"%d " % k for k in range(len(names))])
        raw = [b""] * len(names)
        for x, k in own.items():
            raw[k] = x.replace(SPACE, " ").encode()
        for b, k in enumerate(self.byte_id):
            raw[k] = bytes([b])
        for k, x in enumerate(model.pieces):
            if x.type == 2:
                raw[k] = model.trainer_spec.unk_surface.encode()
        self.raw = raw
        self.bytes = Table(raw)
        self.leads = np.array([x.startswith(SPACE) and k == own.get(x) for k, x in enumerate(names)])
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each pair of symbols."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = (self.pair_key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_rank[at], NONE), np.where(hit, self.pair_piece[at], -1)

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        known = points < len(self.symbol_of)
        symbol = np.where(known, self.symbol_of[np.where(known, points, 0)], -1)
        # words fall apart further where no piece has the two characters together
        edge = np.ones(len(points), bool)
        if len(points) > 1:
            near = points[:-1] << 21 | points[1:]
            at = np.minimum(np.searchsorted(self.bigram, near), len(self.bigram) - 1)
            edge[1:] = (self.bigram[at] != near) | (word[1:] != word[:-1])
        part, at = np.cumsum(edge), np.arange(len(points))
        done_symbol, done_at = [], []
        rank, piece = self._between(symbol, part)
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            lowest = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(symbol)))
            open_ = np.repeat(lowest != NONE, count)
            if not open_.all():  # parts without a pair are done
                done_symbol.append(symbol[~open_])
                done_at.append(at[~open_])
                symbol, part, at, rank, piece = (x[open_] for x in (symbol, part, at, rank, piece))
                keep = lowest != NONE
                lowest, count = lowest[keep], count[keep]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, count))
            # of pairs that overlap the left one merges; of a part's pairs that may merge once, the first
            run = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            k = np.arange(len(hit))
            in_run = k - np.maximum.accumulate(np.where(run, k, 0))
            alone = np.concatenate([[True], part[hit[1:]] != part[hit[:-1]]])
            hit = hit[(in_run % 2 == 0) & (alone | ~self.once[piece[hit]])]
            symbol[hit] = piece[hit]
            stays = np.ones(len(symbol), bool)
            stays[hit + 1] = False
            moved = np.zeros(len(symbol), bool)
            moved[hit] = True
            symbol, part, at, rank, piece, moved = (x[stays] for x in (symbol, part, at, rank, piece, moved))
            new = np.flatnonzero(moved)
            look = np.unique(np.concatenate([new, np.maximum(new - 1, 0)]))
            rank[look], piece[look] = self._between(symbol, part, look)
        symbol, at = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_symbol, done_at))
        order = np.argsort(at, kind="stable")
        symbol, at = symbol[order].astype(np.int32), at[order]
        whole = (symbol >= 0) & (symbol < self.n_pieces)
        if not whole.all():  # characters without a piece become bytes
            lost = np.flatnonzero(~whole)
            raw = [chr(points[at[i]]).encode("utf-8", "surrogatepass") for i in lost]
            size = np.ones(len(symbol), np.int64)
            size[lost] = [len(x) for x in raw]
            to = np.cumsum(size) - size
            out = np.empty(size.sum(), np.int32)
            out[to[whole]] = symbol[whole]
            for i, x in zip(lost, raw, strict=True):
                out[to[i] : to[i] + len(x)] = self.byte_id[list(x)]
            return out, np.bincount(word[at], weights=size, minlength=len(words)).astype(np.int64)
        return symbol, np.bincount(word[at], minlength=len(words)).astype(np.int64)

    def _between(self, symbol: np.ndarray, part: np.ndarray, where: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each symbol with the next one of its part."""
        where = np.arange(len(symbol)) if where is None else where
        nxt = np.minimum(where + 1, len(symbol) - 1)
        rank, piece = self._pairs(symbol[where], symbol[nxt])
        apart = (part[where] != part[nxt]) | (nxt == where)
        return np.where(apart, NONE, rank), piece

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with its end id, and where each text begins (one more at the end)."""
        flat, at = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for some in portions(texts):
            ids, begin = self._encode(some)
            flat.append(ids)
            at.append(begin[1:] + at[-1][-1])
        return np.concatenate(flat), np.concatenate(at)

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        words: list[str] = []
        counts = []
        for t in texts:
            before = len(words)
            if t:
                words += _WORDS.findall(SPACE + t.replace(" ", SPACE))
            counts.append(len(words) - before)
        new = {w for w in words if w not in self.index}
        if new:
            if len(self.index) + len(new) > CACHED_WORDS:
                self._clear()
                new = set(words)
            fresh = list(new)
            flat, size = self.merge(fresh)
            self.index.update(zip(fresh, range(len(self.start), len(self.start) + len(fresh)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.length = np.concatenate([self.length, size])
            self.flat = np.concatenate([self.flat, flat])
        rows = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        ids, at = ragged(self.flat, self.start[rows], self.length[rows])
        ends = at[np.cumsum(np.array(counts, np.int64))] if counts else np.empty(0, np.int64)
        ids = np.insert(ids, ends, self.end)
        return ids, np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8. A space mark at the very start is dropped, as encode() puts it there."""
        out = self.bytes.joined(ids)
        real = np.flatnonzero(self.bytes.length[ids])
        skip = int(len(real) > 0 and self.leads[ids[real[0]]])
        if len(real) and real[-1] >= len(real):  # a control piece may stand inside a run of bytes
            return self._mend(ids, skip)
        try:
            out.decode()
        except UnicodeDecodeError:
            return self._mend(ids, skip)
        return out[skip:]

    def _mend(self, ids: np.ndarray, skip: int) -> bytes:
        """Runs of byte pieces that are no UTF-8: one U+FFFD for each byte outside a whole character."""
        out, run = [], bytearray()

        def flush() -> None:
            data, i = bytes(run), 0
            while i < len(data):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(data[i : i + n].decode().encode())
                        i += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�".encode())
                    i += 1
            run.clear()

        for k in ids.tolist():
            if self.is_byte[k]:
                run += self.raw[k]
            else:
                flush()
                out.append(self.raw[k])
        flush()
        return b"".join(out)[skip:]


_held: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _held:
        _held[path] = Pieces(path)
    return _held[path]


def encode(df: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """df with token_ids of every text, the end id last."""
    schema = _with(df, token_ids=T.ArrayType(T.IntegerType()))
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            ids, at = p.encode(b.column(text_col).to_pylist())
            new = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), new], names=[*kept, "token_ids"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model: str, ids_col: str = "token_ids") -> DataFrame:
    """df with decoded, the text of every id list (null: empty)."""
    schema = _with(df, decoded=T.StringType())
    kept = [f.name for f in schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            new = pa.array([p.decode(np.array(x or [], np.int64)).decode() for x in b.column(ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), new], names=[*kept, "decoded"])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass; only digests leave the worker.

    Returns id_col, n_tokens, ids_sha256, decoded_sha256, n_byte_tokens and exact (the decoded text is the text).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in batches:
            rows = []
            for texts in portions(b.column("_text").to_pylist()):
                ids, at = p.encode(texts)
                raw = np.concatenate([[0], np.cumsum(p.is_byte[ids])])
                for text, i, j in zip(texts, at[:-1], at[1:], strict=True):
                    out = p.decode(ids[i:j])
                    digits = memoryview(p.decimals.joined(ids[i:j]))[:-1]
                    rows.append((j - i, hashlib.sha256(digits).hexdigest(), hashlib.sha256(out).hexdigest(), raw[j] - raw[i], out == (text or "").encode()))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(id_col), *(pa.array(x, k) for x, k in zip(cols, kinds, strict=True))], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "n_byte_tokens", "exact"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_byte_tokens long, exact boolean"
    )
