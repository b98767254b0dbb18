import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from wakeline.llm import suffix_array, suffix_dedup
from wakeline.llm.registry import op2_suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    """(bytes, removed, spans, digest of the rest) of each text, by a table of every string."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array_is_sorted():
    rnd = random.Random(1)
    for alphabet in (1, 2, 5, 200):
        for n in (1, 2, 50, 700):
            t = np.array([rnd.randrange(1, alphabet + 1) for _ in range(n)] + [0])
            bits = int(alphabet + 1).bit_length()
            m = 62 // bits
            words = suffix_array._packed(t, bits, m)
            sa = suffix_array.suffix_array(t, n + 1, words, m)
            assert sa.tolist() == sorted(range(n + 1), key=lambda i: t[i:].tolist())


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "\0\x01é"])
def test_repeated_starts(alphabet):
    rnd = random.Random(2)
    pieces = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))).encode() for _ in range(40)] + [b"", b"a" * 50]
    length = 70 // len(alphabet) // 3
    seen = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
    got = suffix_array.repeated_starts(pieces, length)
    for p, g in zip(pieces, got, strict=True):
        assert g.tolist() == [i for i in range(len(p) - length + 1) if seen[p[i : i + length]] > 1]
    # pieces that are there more than once stand in the sort once, with their number
    several = suffix_array.repeated_starts(pieces, length, np.array([1 + k % 3 for k in range(len(pieces))]))
    for k, (p, g) in enumerate(zip(pieces, several, strict=True)):
        seen.update({p[i : i + length]: k % 3 for i in range(len(p) - length + 1)} if k % 3 else {})
    for p, g in zip(pieces, several, strict=True):
        assert g.tolist() == [i for i in range(len(p) - length + 1) if seen[p[i : i + length]] > 1]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = dict(zip((r.doc_id for r in rows), brute([r.text for r in rows], 200), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op2_suffix_dedup(spark, SF).collect()}
    assert got == want and any(x[1] for x in want.values())


def test_small_lengths_periods_copies_and_both_ways(spark, monkeypatch):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 9)))
    passage = "".join(word() for _ in range(12))
    texts = ["".join(word() for _ in range(rnd.randint(0, 80))) for _ in range(60)]
    texts += [texts[3], texts[4] + "x", "y" + texts[4], texts[5][:100] + passage, passage + texts[6], passage, "a" * 300, "ab" * 200, "", None, passage + "tail" + passage]
    df = spark.createDataFrame([(k if k % 9 else None, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, kept string")
    want = sorted(brute(texts, 24))
    for many in (10_000, 2):
        out = suffix_dedup.deduplicate(df, length=24, gram=8, many=many, portion=500)
        assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()) == want
        assert out.where("doc_id is null").count() == sum(k % 9 == 0 for k in range(len(texts)))


def test_anchor_with_very_many_contexts(spark):
    """One run of bytes in all texts, what stands around it different, equal or equal on one side only."""
    rnd = random.Random(5)
    some = lambda n: "".join(rnd.choice("pqrstuvw") for _ in range(n))
    middle, left, right = some(8), [some(16) for _ in range(6)], [some(16) for _ in range(6)]
    texts = [rnd.choice([*left, some(16)]) + middle + rnd.choice([*right, some(16)]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(texts, 24)
    for many in (100, 20, 1):
        out = suffix_dedup.deduplicate(df, length=24, gram=8, many=many, portion=500).collect()
        assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(out, key=lambda r: r.doc_id)] == want


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 300)
    rnd = random.Random(4)
    text = bytes(rnd.randrange(97, 100) for _ in range(2_000))
    starts = set()
    for rows, at, parts in suffix_dedup._segments(iter([b"short", text, text[:40]]), 24):
        t, s, n, _, _, _ = suffix_dedup.pieces(np.frombuffer(b"".join(parts), np.uint8), [len(p) for p in parts], 24, 8)
        for k, a, c in zip(t, s, n, strict=True):
            starts |= {(rows[k], at[k] + a + j) for j in range(c)}
    assert starts == {(1, k) for k in range(2_000 - 23)} | {(2, k) for k in range(17)}


def test_no_rows(no_docs):
    assert suffix_dedup.deduplicate(no_docs).count() == 0
