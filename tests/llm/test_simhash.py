import random

import xxhash
from pyspark.sql import functions as F

from wakeline.llm import simhash
from wakeline.llm.registry import op6_simhash

SF = "/root/testdata/sf0.001"


def plain(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, max_bits=4):
    """Smallest id reachable, by looking at every two prints."""
    items = sorted(prints.items())
    label = {k: k for k, _ in items}
    changed = True
    while changed:
        changed = False
        for a, x in items:
            for b, y in items:
                if (x ^ y).bit_count() <= max_bits and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return label


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {k: plain(t) for k, t in texts.items()}
    want = classes(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash(spark, SF).collect()}
    assert got == {k: (f"{prints[k]:016x}", want[k]) for k in texts}


def test_links_lose_nothing_however_groups_are_cut(spark):
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    prints = {centre}
    for _ in range(150):
        x = centre
        for _ in range(rnd.randint(1, 9)):
            x ^= 1 << rnd.randrange(64)
        prints.add(x)
    prints |= {rnd.getrandbits(64) for _ in range(50)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = classes({x: x % (1 << 64) for x in signed})
    for block_rows in (1 << 18, 20):
        labels = simhash.connected_components(simhash.links(df, block_rows=block_rows)).collect()
        got = {x: x for x in signed} | {r.node: r.component for r in labels}
        assert got == want


def test_odd_rows(odd_docs, no_docs):
    out = simhash.near_duplicates(odd_docs)
    assert out.count() == odd_docs.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[3].fp == rows[4].fp == rows[5].fp == 0 and rows[5].component_id == 3
    assert rows[2].component_id == 1
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.where(F.col("doc_id").isin(2, 4, 5)).count() == 0 and kept.where("doc_id is null").count() == 1
    assert kept.where("doc_id = 1").count() == kept.where("doc_id = 3").count() == 1
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_first_judges_rows_not_ids(spark):
    text, other = "the quick brown fox jumps over the lazy dog again", "an unrelated text about rivers and old mills in rain"
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (2, other), (2, other), (None, text), (None, "some third text that stands here without an id at all")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in simhash.keep_first(df).collect()), key=str) == sorted([(1, text), (2, other), (None, "some third text that stands here without an id at all")], key=str)
