"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A text's A-Z are lower-cased; its words are runs of non-space ASCII bytes; each run of four words
(repeats included) is hashed with XXH64, seed 42. A fingerprint bit is one if more than half of the
hashes have it. Fingerprints at most ``max_bits`` apart are linked.

Two fingerprints that differ in at most k bits agree on at least n - k of n blocks, so every choice of
n - k blocks is a table and close pairs meet in one of them. Work is on distinct fingerprints: copies
collapse first. Inside one block value the task walks from fingerprint to fingerprint and emits a
spanning forest, never all pairs; a block value with more than BLOCK_ROWS fingerprints is cut into
chunks, and each two chunks form a task of their own.

Defined results: null, empty and blank texts have fingerprint zero and are linked to each other and to
any fingerprint within max_bits of zero. Texts under four words are one shingle. Rows with equal ids are
rows of their own; null ids are ignored when the smallest id is taken. keep_first() keeps one row of each
component, also of repeated rows and of rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.components import connected_components
from wakeline.session import settle

MAX_BITS = 4
BLOCKS = 7
WORDS = 4
#: Distinct fingerprints of one block value that one task takes (eight bytes each).
BLOCK_ROWS = 1 << 18


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64 bits of one text, as an unsigned number."""
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[: -words]]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 32768):
        bits = np.unpackbits(h[k : k + 32768].view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """id_col and fp (the 64 bits as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), words) for x in b.column("_text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(fp)], names=[id_col, "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def forest(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph that links fingerprints at most max_bits apart."""
    left, edges = fp, []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count((left ^ x).view(np.uint64)) <= max_bits
            if near.any():
                found, left = left[near], left[~near]
                edges += [(int(x), int(y)) for y in found]
                todo += list(found)
    return edges


def _linked(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, sub): forests of the runs of equal key and sub."""
    names = ["a", "b"]
    key = sub = fp = np.empty(0, np.int64)

    def close(k: np.ndarray, s: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])]))
        size = np.diff(np.concatenate([start, [len(k)]]))
        two = start[size == 2]
        two = two[np.bitwise_count((f[two] ^ f[two + 1]).view(np.uint64)) <= max_bits]
        a, b = [f[two]], [f[two + 1]]
        for i, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            if e := forest(f[i : i + n], max_bits):
                e = np.array(e, np.int64)
                a.append(e[:, 0])
                b.append(e[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=names)

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        k, s, f = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "sub", "fp"))
        if not len(k):
            continue
        whole = np.flatnonzero((k != k[-1]) | (s != s[-1]))
        cut = int(whole[-1]) + 1 if len(whole) else 0
        same = not held or (held[0][0][0] == k[-1] and held[0][1][0] == s[-1])
        if cut or not same:
            held.append((k[:cut], s[:cut], f[:cut]))
            key, sub, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            yield close(key, sub, fp)
            held = []
        held.append((k[cut:], s[cut:], f[cut:]))
    if held:
        yield close(*(np.concatenate(x) for x in zip(*held, strict=True)))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all close pairs.

    distinct: one row for each fingerprint in column fp.
    """
    width = [64 // blocks + (k < 64 % blocks) for k in range(blocks)]
    at = [sum(width[:k]) for k in range(blocks)]
    block = [F.shiftrightunsigned("fp", at[k]).bitwiseAND(F.lit((1 << width[k]) - 1)) for k in range(blocks)]
    tables = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        key, shift = F.lit(t), 0
        for k in chosen:
            key = key.cast("long") if shift == 0 else key
            key, shift = F.shiftleft(key, width[k]).bitwiseOR(block[k]), 1
        tables.append(key)
    keys = distinct.select("fp", F.explode(F.array(*tables)).alias("key"))
    keys = keys.withColumn("sub", F.lit(0).cast("long"))
    if distinct.count() > block_rows:
        large = keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)
        chunks = F.ceil(2 * F.col("n") / block_rows)
        mine = F.pmod(F.xxhash64("fp"), chunks)
        other = F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), chunks - 1)))
        keys = keys.drop("sub").join(large, "key", "left").select("key", "fp", "n", mine.alias("mine"), other.alias("other"))
        keys = keys.select("key", "fp", F.when(F.col("n").isNull(), 0).otherwise(F.greatest("mine", "other") * (1 << 31) + F.least("mine", "other") + 1).cast("long").alias("sub"))
    run = lambda batches: _linked(batches, max_bits)
    return keys.repartition("key", "sub").sortWithinPartitions("key", "sub").mapInArrow(run, "a long, b long")


def components(prints: DataFrame, id_col: str, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, component (one of its fingerprints) and component_id (the smallest id reachable) of each distinct fingerprint."""
    distinct = settle(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    labels = connected_components(links(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    joined = distinct.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    roots = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # written, so that both sides of later joins are plain shuffles and Spark splits the rows of a hot fingerprint
    return settle(joined.join(roots, "component").select("fp", "component", "component_id"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """id_col, fp and component_id (the smallest id reachable) of each row."""
    prints = settle(fingerprints(df, id_col, text_col))
    return prints.join(components(prints, id_col, max_bits).drop("component"), "fp").select(id_col, "fp", "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of df for each component: the one with the smallest id (null last), then the smallest fingerprint; of
    rows that agree in both, any one, chosen by their text's digest.

    Fingerprints are numbered by component, so a row is judged by its fingerprint, not by its id alone.
    """
    names = df.columns
    # _n tells rows apart: it is written with them, so that it stays the same whenever they are read
    rows = settle(df.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("_n")))
    seen = rows.select("_n", F.col(f"row.`{id_col}`").alias("_id"), F.col(f"row.`{text_col}`").alias("_text"))
    marked = settle(fingerprints(seen, "_n", "_text").join(seen.select("_n", "_id", F.xxhash64("_text").alias("_h")), "_n"))
    of_print = components(marked, "_id", max_bits).select(F.col("fp").alias("_fp"), "component")
    order = F.struct(F.col("_id").isNull().alias("last"), "_id", "fp", "_h", "_n")
    first = marked.join(of_print, F.col("fp") == F.col("_fp")).groupBy("component").agg(F.min(order).alias("m")).select(F.col("m._n").alias("_n"))
    return rows.join(first, "_n", "left_semi").select("row.*")
