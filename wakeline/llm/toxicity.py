"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models, one of toxic and one of ordinary texts, are learnt by Spark aggregations over labelled documents, of
which equal texts, and equal passages of AROUND words around a bigram, count once. The top order has the counts of
bigrams, less TOP_DISCOUNT. Below it a word counts once for each
different word before it, less DISCOUNT, and below that stand the shared backoff counts: in how many different words'
company a word stands anywhere in the corpus, labelled or not. Backoff weights are common to both classes, so an
expression that is rare or unknown tells nothing either way.

A text is compared by its toxic and ordinary log-likelihoods per word: over the whole text, over its most
toxic window of WINDOW words, and over its PAIR most telling words. Discounts take almost all from a count that is just above them
and leave a class without any just below, so a passage that both classes have could tell everything; therefore no word tells more
than the odds of its own counts, one added to each, of which the stronger of word and bigram holds. A logistic curve over these numbers,
fitted on labelled documents that the models have not seen, gives a score from 0 to 1.

Only labelled rows whose crc32(id as text) modulo FOLDS is not 0 are used: the last fold for the curve, the
others for the models. Bounds (parameters): MODEL_ROWS and CURVE_ROWS labelled documents of each class,
picked by a digest of the id. They alone bound the broadcast model: it has every word of these documents and every
bigram that they have more often than TOP_DISCOUNT. The shared backoff counts take all documents, and every document is
scored, whole.

Defined results: null and empty texts get the score of a text without evidence. Without labelled rows of
both classes there is no model and every score is the share of toxic rows (0 if there are none). Of
several labels of one id the highest counts. Extra columns are kept; columns score, predicted are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.session import settle

FOLDS = 5
MODEL_ROWS = 5_000
CURVE_ROWS = 2_000
DISCOUNT = 3
TOP_DISCOUNT = 8
AROUND = 2
WINDOW = 32
PAIR = 2
HELD = 100_000
RUN = 1 << 16  # words that are looked up at a time
UNIT = 2.0**32  # evidence is held in whole parts of 1 / UNIT
PART = 1_000  # rows that a task passes on at a time
NOTHING = np.iinfo(np.int64).min
PAIRS = 1 << 20  # pairs of a task, 8 bytes each, of which equal ones fall together before they are passed on

_WORD = re.compile(r"\w+")
START = "\x02"  # stands before the first word; no word contains it


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def fold(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


class _Numbers(dict):
    """Running numbers of words, and each word's place among sorted digests (their count, if it is not there).

    At most HELD words are kept: a worker's memory is that of these and of the digests, whatever the vocabulary.
    """

    def __init__(self, known: np.ndarray):
        super().__init__()
        self.known = known
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.new: list[int] = []
        self.digest, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        self.new.append(_digest(word))
        return k

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Place and digest of each word."""
        if len(self) > HELD:
            self._empty()
        k = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            new = np.array(self.new, np.uint64)
            self.digest, self.place = np.append(self.digest, new), np.append(self.place, _places(self.known, new))
            self.new = []
        return self.place[k], self.digest[k]


def _digest(word: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def _places(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each of wanted stands in known, which rises; the length of known if it does not."""
    if not len(known):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, len(known))


def _runs(texts: Iterable[str | None]) -> Iterator[tuple[list[str], np.ndarray]]:
    """The words of many texts, START before each text's, and their numbers of words; about RUN words at a time."""
    held, n = [], []
    for text in texts:
        w = words_of(text)
        held.append(START)
        held += w
        n.append(len(w))
        if len(held) > RUN:
            yield held, np.array(n, np.int64)
            held, n = [], []
    if n:
        yield held, np.array(n, np.int64)


@dataclass
class Model:
    """Sorted digests of the words, with each class's unigram probability and backoff weight; bigrams by key, sorted."""

    words: np.ndarray
    uni: np.ndarray  # 2 x words; the last column is for unknown words
    back: np.ndarray  # weight of the unigram after that word
    keys: np.ndarray
    seen: np.ndarray  # 2 x bigrams: discounted relative counts
    curve: np.ndarray
    word_odds: np.ndarray  # log of the toxic over the ordinary count; the last is for unknown words
    pair_odds: np.ndarray  # the same of bigrams

    def __post_init__(self) -> None:
        # evidence of a word that ends no bigram of the model, and of one that ends that bigram; the backoff weight is common
        # to both classes. In whole UNITs, so that sums do not depend on their order
        low, high = np.minimum(self.word_odds, 0), np.maximum(self.word_odds, 0)
        before, now = np.divmod(self.keys, len(self.words) + 1)
        p = self.back[before] * self.uni[:, now] + self.seen
        low_of, high_of = np.minimum(low[now], self.pair_odds), np.maximum(high[now], self.pair_odds)
        units = lambda x: np.rint(x * UNIT).astype(np.int64)
        self.told = units(np.clip(np.log(self.uni[0] / self.uni[1]), low, high))
        self.pair_told = units(np.clip(np.log(p[0] / p[1]), low_of, high_of))

    def _places(self, words: list[str]) -> np.ndarray:
        return _Numbers(self.words).of([START, *words])[0]

    def ratios(self, words: list[str]) -> np.ndarray:
        """Log of the toxic over the ordinary probability of each word after the one before it."""
        k = self._places(words)
        p = self.back[k[:-1]] * self.uni[:, k[1:]]
        at = _places(self.keys, k[:-1] * (len(self.words) + 1) + k[1:])
        hit = at < len(self.keys)
        p[:, hit] += self.seen[:, at[hit]]
        return np.log(p[0] / p[1])

    def _told(self, k: np.ndarray) -> np.ndarray:
        """Evidence of all but the first of these places."""
        out = self.told[k[1:]]
        at = _places(self.keys, k[:-1] * (len(self.words) + 1) + k[1:])
        hit = at < len(self.keys)
        out[hit] = self.pair_told[at[hit]]
        return out

    def evidence(self, words: list[str]) -> np.ndarray:
        """ratios(), each within the odds of the word's and the bigram's own counts."""
        return self._told(self._places(words)) / UNIT

    def features_of(self, texts: Iterable[str | None]) -> np.ndarray:
        """Three columns for each text: evidence per word in whole, in its most toxic window, and of its PAIR words."""
        numbers, out = _Numbers(self.words), [np.empty((0, 3))]
        for words, n in _runs(texts):
            x = np.zeros((len(n), 3))
            out.append(x)
            some = np.flatnonzero(n)
            if not len(some):
                continue
            r = np.append(self._told(numbers.of(words)[0]), 0)  # r[k] is of words[k + 1]; it ends with a place to spare
            first = (np.cumsum(n + 1) - n - 1)[some]
            n = n[some]
            total = np.concatenate([[0], np.cumsum(r)])
            whole = total[first + n] - total[first]
            x[some, 0] = whole / n
            x[some, 1] = whole
            long = n >= WINDOW
            if long.any():
                # windows that start in [first, last) of each text
                sums = np.append(total[WINDOW:] - total[:-WINDOW], 0)
                spans = np.stack([first[long], (first + n)[long] - WINDOW + 1], 1).ravel()
                x[some[long], 1] = np.maximum.reduceat(sums, spans)[::2]
            x[some, 1] /= WINDOW
            # the largest of each text, taken away, and so on
            spans = np.stack([first, first + n], 1).ravel()
            own = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            for k in range(PAIR):
                most = np.maximum.reduceat(r, spans)[::2]
                x[some, 2] += np.where(n > k, most, 0)
                at = own[r[own] == np.repeat(most, n)]
                r[at[np.unique(np.searchsorted(first, at, "right"), return_index=True)[1]]] = NOTHING
            x[some, 2] /= PAIR
        return np.concatenate(out) / UNIT

    def features(self, text: str | None) -> tuple[float, float, float]:
        return tuple(self.features_of([text])[0].tolist())

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        c, x = self.curve, self.features_of(texts)
        return 1 / (1 + np.exp(-np.clip(c[0] + c[1] * x[:, 0] + c[2] * x[:, 1] + c[3] * x[:, 2], -30, 30)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def _sampled(labels: DataFrame, id_col: str, label_col: str, folds: list[int], rows: int) -> DataFrame:
    chosen = labels.where(fold(id_col).isin(folds))
    order = [F.xxhash64(id_col, F.lit(7)), F.col(id_col)]
    return chosen.where(F.col(label_col) == 1).orderBy(*order).limit(rows).unionByName(chosen.where(F.col(label_col) == 0).orderBy(*order).limit(rows))


def _bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """v, w, passage (digest of the bigram with AROUND words on each side), bits (1 ordinary, 2 toxic).

    At most HELD bigrams are held at a time, however long the texts; equal ones meet again in the aggregation.
    """
    import xxhash

    def emitted(found: dict[tuple, int]) -> pa.RecordBatch:
        v, w, passage = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v), pa.array(w), pa.array(np.array(passage, np.uint64).view(np.int64)), pa.array(found.values(), pa.int32())], names=["v", "w", "passage", "bits"])

    found: dict[tuple, int] = {}
    for b in batches:
        for text, label in zip(b.column("_text"), b.column("_label"), strict=True):
            w = words_of(text.as_py())
            bit = 1 + label.as_py()
            padded = [START] * (AROUND + 1) + w + [START] * AROUND
            for k, now in enumerate(w):
                key = (padded[k + AROUND], now, xxhash.xxh64_intdigest(" ".join(padded[k : k + 2 * AROUND + 2])))
                found[key] = found.get(key, 0) | bit
                if len(found) >= HELD:
                    yield emitted(found)
                    found = {}
    if found:
        yield emitted(found)


def _packed(rising: np.ndarray) -> bytes:
    """Whole numbers that rise, as the steps between them, seven bits a byte; a step's last byte has no high bit."""
    step = np.diff(rising, prepend=0).astype(np.uint64)
    size = np.ones(len(step), np.int64)
    for k in range(1, 9):
        size += step >= (1 << 7 * k)
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        more = np.where(size[own] > k + 1, 128, 0)
        out[at[own] + k] = ((step[own] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more.astype(np.uint8)
    return out.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(x < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(x)) - np.repeat(first, last - first + 1)
    return np.cumsum(np.add.reduceat((x & 127).astype(np.int64) << (7 * place), first))


def company(texts: DataFrame, words: list[str]) -> np.ndarray:
    """In how many different words' company (right after them) each of these words stands in all texts.

    texts: column _text. A pair is one number: the word's place in words and 32 bits of a digest of the word before it,
    so two companions of a word count as one with a chance of their number in 2^32. Pairs are dealt by the digest's
    first bits, so that no word's pairs meet in one task, and travel as packed steps of sorted numbers.
    """
    session = texts.sparkSession
    digests = np.array([_digest(w) for w in words], np.uint64)
    order = np.argsort(digests)
    shipped = session.sparkContext.broadcast(digests[order])
    top = min(14, max(8, (4 * int(session.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))
    rest, n_words = 32 - top, len(words)
    shift = rest + max(1, n_words.bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(shipped.value)
        start = np.uint64(_digest(START))
        pairs, size = [], 0

        def dealt() -> pa.RecordBatch:
            key = np.unique(np.concatenate(pairs))
            lots = np.unique(key >> shift)
            at = np.append(np.searchsorted(key, lots << shift), len(key))
            blobs = [_packed(key[i:j] - (lot << shift)) for lot, i, j in zip(lots, at[:-1], at[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(lots.astype(np.int32)), pa.array(blobs, pa.binary())], names=["lot", "pairs"])

        for w, _ in _runs(x.as_py() for b in batches for x in b.column("_text")):
            place, digest = numbers.of(w)
            # the first word of a text comes after START, which itself is in nobody's company
            known = (place[1:] < n_words) & (digest[1:] != start)
            now, before = place[1:][known], (digest[:-1][known] >> np.uint64(32)).astype(np.int64)
            pairs.append((before >> rest) << shift | now << rest | before & ((1 << rest) - 1))
            size += len(now)
            if size > PAIRS:
                yield dealt()
                pairs, size = [], 0
        if size:
            yield dealt()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, lot, held, size = np.zeros(n_words, np.int64), None, [], 0

        def done() -> None:
            if held:
                counts[:] += np.bincount(np.unique(np.concatenate(held)) >> rest, minlength=n_words)

        for b in batches:
            for own, blob in zip(b.column("lot").to_pylist(), b.column("pairs"), strict=True):
                if own != lot:
                    done()
                    lot, held, size = own, [], 0
                held.append(_unpacked(blob.as_buffer()))
                size += len(held[-1])
                if size > PAIRS:
                    held = [np.unique(np.concatenate(held))]
                    size = 0
        done()
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["w", "n"])

    out = np.zeros(n_words, np.int64)
    lots = texts.select("_text").mapInArrow(run, "lot int, pairs binary").repartition("lot").sortWithinPartitions("lot")
    found = lots.mapInArrow(counted, "w int, n long").groupBy("w").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    shipped.destroy()
    out[order[found["w"].to_numpy(np.int64)]] = found["n"]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | float:
    """The model, or the share of toxic rows if there are not both classes."""
    labels = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def sample(folds: list[int], rows: int) -> DataFrame:
        # at most 2 * rows ids: a bound that does not grow with the corpus
        few = texts.join(F.broadcast(_sampled(labels, "_id", "_label", folds, rows)), "_id")
        return few.groupBy(F.xxhash64("_text"), "_label").agg(F.first("_text").alias("_text")).select("_text", "_label")

    classes = ("toxic", "plain")
    big = sample([*range(1, FOLDS - 1)], MODEL_ROWS).mapInArrow(_bigrams, "v string, w string, passage long, bits int")
    big = big.groupBy("v", "w", "passage").agg(F.bit_or("bits").alias("bits"))
    has = lambda bit: F.count_if(F.col("bits").bitwiseAND(bit) > 0)
    big = settle(big.groupBy("v", "w").agg(has(1).alias("plain"), has(2).alias("toxic")))
    one = lambda c: F.count_if(F.col(c) > 0).alias(f"k_{c}")
    after = big.groupBy(F.col("w").alias("word")).agg(*map(one, classes))
    cut = sum((F.least(c, F.lit(TOP_DISCOUNT)) for c in classes), F.lit(0))
    before = big.groupBy(F.col("v").alias("word")).agg(F.sum("toxic").alias("c_toxic"), F.sum("plain").alias("c_plain"), F.sum(cut).alias("cut"))
    top = after.join(before, "word", "full").na.fill(0).toArrow().to_pandas()
    if not len(top) or not top["c_toxic"].sum() or not top["c_plain"].sum():
        share = labels.where(fold("_id") != 0).agg(F.avg("_label")).first()[0]
        return float(share or 0.0)

    # words stand by their digests
    top["digest"] = np.array([_digest(w) for w in top["word"]], np.uint64)
    top = top.sort_values("digest").reset_index(drop=True)
    words = top["word"].tolist()
    none = len(words)
    # one more for each word and for what no labelled text has
    shared = np.append(company(texts, words), 0) + 1
    both = shared / shared.sum()
    k = {c: top[f"k_{c}"].to_numpy(float) for c in classes}
    weight = sum(np.minimum(k[c], DISCOUNT).sum() for c in classes) / sum(k[c].sum() for c in classes)
    uni = np.stack([np.append(np.maximum(k[c] - DISCOUNT, 0), 0) / k[c].sum() + weight * both for c in classes])
    c = (top["c_toxic"] + top["c_plain"]).to_numpy(float)
    back = np.append(np.where(c > 0, top["cut"] / np.maximum(c, 1), 1.0), 1.0)
    ids = {w: i for i, w in enumerate(words)}
    often = big.where(F.greatest("toxic", "plain") > TOP_DISCOUNT).toArrow().to_pandas()
    v, w = (often[x].map(ids).to_numpy(np.int64) for x in ("v", "w"))
    keys = v * (none + 1) + w
    order = np.argsort(keys)
    seen = np.stack([np.maximum(often[x].to_numpy(float) - TOP_DISCOUNT, 0) / np.maximum(top[f"c_{x}"].to_numpy(float)[v], 1) for x in classes])
    word_odds = np.append(np.log((k["toxic"] + 1) / (k["plain"] + 1)), 0)
    pair_odds = np.log((often["toxic"].to_numpy(float) + 1) / (often["plain"].to_numpy(float) + 1))
    model = Model(top["digest"].to_numpy(), uni, back, keys[order], seen[:, order], np.zeros(4), word_odds, pair_odds[order])

    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = shipped.value.features_of(x.as_py() for x in b.column("_text"))
            yield pa.RecordBatch.from_arrays([b.column("_label"), *map(pa.array, np.ascontiguousarray(f.T))], names=["label", "whole", "window", "pair"])

    seen_rows = sample([FOLDS - 1], CURVE_ROWS).mapInArrow(measured, "label int, whole double, window double, pair double").toArrow().to_pandas()
    weight = labels.where(fold("_id") != 0).agg(F.avg("_label")).first()[0]
    model.curve = _logistic(seen_rows, weight)
    return model


def _logistic(rows, share: float) -> np.ndarray:
    """Intercept and three slopes by Newton steps; classes are weighted to the share of toxic labels."""
    x = np.column_stack([np.ones(len(rows)), rows["whole"], rows["window"], rows["pair"]])
    y = rows["label"].to_numpy(float)
    start = np.array([np.log(max(share, 1e-3) / max(1 - share, 1e-3)) - 2, 0.0, 0.0, 1.0])
    if not len(y) or y.min() == y.max():
        return start
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())) * len(y)
    weight /= weight.mean()
    # in order, so that sums do not depend on how rows arrive
    order = np.lexsort((x[:, 1], x[:, 2], x[:, 3], y))
    x, y, weight = x[order], y[order], weight[order]
    beta, ridge = start.copy(), np.diag([1e-6, 0.01, 0.01, 0.01])
    loss = lambda b: float((weight * (np.logaddexp(0, x @ b) - y * (x @ b))).sum() + 0.5 * (b - start) @ ridge @ (b - start))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, x.T @ (weight * (y - p)) - ridge @ (beta - start))
        size = 1.0
        while size > 1e-6 and loss(beta + size * step) > loss(beta):
            size /= 2
        beta = beta + size * step
        if np.abs(step).max() < 1e-9 or size <= 1e-6:
            break
    return np.round(beta, 6)


def _in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Its rows, PART at a time: the executor holds what it is passed in memory once more, texts included."""
    yield from (batch.slice(k, PART) for k in range(0, batch.num_rows, PART))


def score(df: DataFrame, model: Model | float, text_col: str = "text") -> DataFrame:
    """df with score and predicted (1 from a score of 0.5 on)."""
    df = df.drop("score", "predicted")
    if isinstance(model, float):
        return df.withColumns({"score": F.lit(model), "predicted": F.lit(int(model >= 0.5))})
    shipped = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = shipped.value.scores(x.as_py() for x in b.column(text_col))
            yield from _in_parts(pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*b.schema.names, "score", "predicted"]))

    return df.mapInArrow(run, schema)
