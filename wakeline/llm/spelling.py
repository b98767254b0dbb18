"""Spelling variants: words within one edit of each other, and the frequent form that a rare one stands for.

An edit changes the multiset of a word's letters by two elements at most (one out, one in), so as binary
vectors over (letter, how many times so far) near words have Hamming distance two, or one if a letter
comes or goes. PartEnum signatures find such vectors without loss: the dimensions are dealt into parts, and
for each choice of parts that leaves out as many as may differ, a hash of the vector on the chosen ones is a
signature; vectors within the distance share one. A signature also holds the length and the half of the word
that the edit leaves alone (an edit in the first half leaves the second, and the other way round), which every
near pair shares too. Words are joined on equal signatures and each pair is verified.

Counting is a partial sum in each task and one shuffle of distinct words. Forms are followed by pointer
jumping; each step multiplies the count, so that a few rounds end every chain.

Defined results: null and empty texts have no words; repeated rows count again; a null id reads as the empty
string where ids matter (damage). Of near words with one count the first in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.session import settle

LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
HELD_WORDS = 200_000  # distinct words of a task before they are passed on

_RUN = re.compile("[a-zÀ-ÿ]+")

#: (parts, most parts that differ): equal lengths, lengths that differ by one
SAME, ONE = (5, 2), (3, 1)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None, hold: int = HELD_WORDS) -> DataFrame:
    """word, n: runs of letters of all texts, only A-Z in lower case, with their number of occurrences.

    damage: a run loses the code point h % length if damage divides h, the CRC-32 of `<id>:<run>`. Only words of
    LEAST_LENGTH code points or more are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return done

        for b in batches:
            for key, text in zip(b.column("_id"), b.column("_text"), strict=True):
                low = (text.as_py() or "").encode().lower().decode()  # of bytes: A-Z alone
                before = zlib.crc32(f"{key.as_py() or ''}:".encode())
                for word, n in Counter(_RUN.findall(low)).items():
                    if len(word) < LEAST_LENGTH:
                        continue
                    if damage and (h := zlib.crc32(word.encode(), before)) % damage == 0:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                        if len(word) < LEAST_LENGTH:
                            continue
                    held[word] += n
                if len(held) > hold:
                    yield out()
        yield out()

    parts = docs.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _subsets(words: list[str], parts: int, differ: int) -> np.ndarray:
    """For each word a row of hashes, one for each choice of parts without `differ` of them."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    order = np.lexsort((points, word))
    points, word = points[order], word[order]
    new = np.concatenate([[True], (points[1:] != points[:-1]) | (word[1:] != word[:-1])])
    at = np.arange(len(points))
    nth = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    element = _mix(points << np.uint64(32) | nth << np.uint64(8) | np.uint64(parts))
    held = np.zeros((len(words), parts), np.uint64)
    np.add.at(held, (word, (element % np.uint64(parts)).astype(np.int64)), _mix(element))
    out = [sum(_mix(held[:, j] + np.uint64(j + 1)) for j in chosen) + np.uint64(k << 4 | parts) for k, chosen in enumerate(combinations(range(parts), parts - differ))]
    return _mix(np.stack(out, axis=1))


def signatures(words: list[str], longer: bool) -> np.ndarray:
    """A row of signatures for each word; two near words a, b share one if a stands left and b right.

    Left: for a partner of the same length, and for one that is a letter longer. Right (longer): for the same
    length, and for a partner that is a letter shorter.
    """
    half = lambda x, lead: xxhash.xxh64_intdigest(x.encode(), lead)
    same, one = [], []
    for w in words:
        k = len(w)
        same.append((half(w[: k // 2], 2 * k), half(w[k // 2 :], 2 * k + 1)))
        k -= longer  # the shorter word's length
        one.append((half(w[: k // 2], 2 * k), half(w[len(w) - (k - k // 2) :], 2 * k + 1)))
    out = []
    for halves, scheme in ((same, SAME), (one, ONE)):
        chosen, h = _subsets(words, *scheme), np.array(halves, np.uint64)
        out += [_mix(chosen ^ h[:, [0]]), _mix(chosen ^ h[:, [1]])]
    return np.concatenate(out, axis=1)


def _signed(words: DataFrame, longer: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = signatures(b.column("word").to_pylist(), longer)
                at = pa.array(np.repeat(np.arange(len(s)), s.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(s.reshape(-1).view(np.int64)), b.column("word").take(at), b.column("n").take(at)], names=["signature", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "signature long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: pairs of words (word, n) that differ by exactly one inserted, deleted or replaced code point.

    Each pair comes once; a is the shorter word, or the first in code-point order. Words must be distinct.
    Spark sizes the signatures as it does the words, of which they are many times as many rows, so the join is told to be
    a merge: neither side is ever broadcast.
    """
    left = _signed(words, False).toDF("signature", "a", "a_n")
    right = _signed(words, True).toDF("signature", "b", "b_n")
    longer = F.length("b") - F.length("a")
    near = ((longer == 1) | ((longer == 0) & (F.col("a") < F.col("b")))) & (F.levenshtein("a", "b", 1) == 1)
    pairs = left.join(right.hint("merge"), (left["signature"] == right["signature"]) & near)
    return pairs.select("a", "a_n", "b", "b_n").distinct()


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Of distinct words (word, n): form, root, n, n_near, form_n as well.

    form: the near word of largest n if that is `times` (2 or more) the word's n or more. root: where the forms of
    forms end; a word without a form is its own.
    """
    words = settle(words.select("word", "n"))
    pairs = near_pairs(words)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    counts_so = -F.col("best.less") >= times * F.col("n")
    found = settle(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(counts_so, F.col("best.near")).alias("form"), F.when(counts_so, -F.col("best.less")).alias("form_n")))
    roots = _followed(found.where("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _followed(links: DataFrame) -> DataFrame:
    """Every word's last word over the links; a link leads to a word at least twice as frequent, so there is no cycle.

    Files of words are a fraction of their rows in memory, so these joins are merges too.
    """
    links = settle(links)
    while not (links.alias("x").join(links.alias("y").hint("merge"), F.col("x.root") == F.col("y.word"), "left_semi")).isEmpty():
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = settle(links.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return links


def variants(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """forms() of the words of all documents with LEAST_COUNT occurrences or more."""
    return forms(counts(docs, damage=damage).where(F.col("n") >= LEAST_COUNT))
