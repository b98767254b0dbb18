"""Spelling variants against every pair of words, and counts against plain loops."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from wakeline.llm import spelling
from wakeline.llm.registry import queries


def damaged_counts(rows, damage=199):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                out[run] += 1
    return out


def neighbours(words):
    """By deleting each letter: words that share a deletion, checked letter by letter."""
    by = {}
    for w in words:
        for x in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(x, set()).add(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            for b in group:
                if a != b and one_edit(a, b):
                    near[a].add(b)
    return near


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(n_of):
    near = neighbours(n_of)
    form = {}
    for w, n in n_of.items():
        best = min(near[w], key=lambda x: (-n_of[x], x), default=None)
        if best is not None and n_of[best] >= 5 * n:
            form[w] = best
    rows = set()
    for w, n in n_of.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near[w]), n_of[form[w]] if w in form else None))
    return rows


def test_query_is_the_plain_form_on_whole_texts(spark):
    for sf in ("0.001", "0.01"):
        docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text").collect()
        want = expected({w: n for w, n in damaged_counts(map(tuple, docs)).items() if n >= 5})
        got = queries()["op13_spelling"](spark, f"/root/testdata/sf{sf}")
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)
        assert any(r[1] for r in want)


def test_near_words_share_a_signature():
    rng = random.Random(3)
    for _ in range(3000):
        w = "".join(rng.choice("abcé") for _ in range(rng.randint(6, 14)))
        i, c = rng.randrange(len(w)), rng.choice("abcdß")
        for x in (w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]):
            a, b = sorted((w, x), key=lambda v: (len(v), v))
            assert set(spelling.signatures([a], False)[0]) & set(spelling.signatures([b], True)[0])


@settings(max_examples=200, deadline=None)
@given(st.text("abcde", min_size=1, max_size=9), st.integers(0, 8), st.sampled_from("abz"))
def test_any_inserted_letter_keeps_a_signature(w, i, c):
    longer = w[:i] + c + w[i:]
    assert set(spelling.signatures([w], False)[0]) & set(spelling.signatures([longer], True)[0])


def test_chains_ties_and_empty_tables(spark):
    rows = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 200), ("aaabbb", 4000), ("zzzzzz", 7), ("zzzzzy", 35), ("zzzzzx", 35), ("çççççç", 9)]
    got = {r.word: r for r in spelling.forms(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert {tuple(r) for r in got.values()} == expected(dict(rows))
    assert got["aaaaaa"].root == "aaabbb" and got["zzzzzz"].form == "zzzzzx" and got["çççççç"].n_near == 0
    assert spelling.forms(spark.createDataFrame([], "word string, n long")).collect() == []


def test_odd_documents(spark, odd_docs, no_docs):
    want = damaged_counts([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert dict(map(tuple, spelling.counts(odd_docs, damage=199).collect())) == want
    assert spelling.variants(no_docs).collect() == []
    some = spark.createDataFrame([(None, "Straßen STRASSEN Étoiles étoiles"), ("k", "Étoiles")], "doc_id string, text string")
    assert dict(map(tuple, spelling.counts(some).collect())) == {"straßen": 1, "strassen": 1, "Étoiles": 2, "étoiles": 1}


def test_words_are_passed_on_when_many_are_held(spark, odd_docs):
    want = dict(map(tuple, spelling.counts(odd_docs).collect()))
    assert dict(map(tuple, spelling.counts(odd_docs.repartition(1), hold=3).collect())) == want


def test_signatures_of_few_words_are_not_broadcast(spark):
    words = spelling.settle(spark.createDataFrame([("spelling", 9), ("speling", 5)], "word string, n long"))
    pairs = spelling.near_pairs(words)
    assert [tuple(r) for r in pairs.collect()] == [("speling", 5, "spelling", 9)]
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
