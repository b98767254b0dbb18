from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_simhash import classes, plain
from wakeline.llm import media, mixing
from wakeline.llm.registry import op3_media, queries
from wakeline.session import shared_folder

SF = "/root/testdata/sf0.001"


PIXELS = "image_id long, width int, height int, pixels binary"


def plain_classes(rows):
    """Class and links of each image by comparing every two of them outright."""
    found = {}
    for k, g in rows.items():
        found.setdefault((g.shape, g.tobytes()), []).append(k)
    keys = sorted(found.values())
    corners = [media.describe(rows[k[0]][None])[0] for k in keys]
    label = list(range(len(keys)))
    for i in range(len(keys)):
        for j in range(i):
            if media.votes(corners[i], corners[j]) >= media.MIN_VOTES and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    members = {}
    for k, x in zip(keys, label, strict=True):
        members.setdefault(x, []).extend(k)
    return {k: (min(m), len(m) - 1) for m in members.values() for k in m}


def grey_of(rows):
    return {r.image_id: np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width) for r in rows}


def images(spark, pictures):
    return spark.createDataFrame([(k, g.shape[1], g.shape[0], bytearray(np.ascontiguousarray(g).tobytes())) for k, g in pictures.items()], PIXELS)


def test_query_finds_the_edited_copies(spark):
    got = {r.image_id: r for r in op3_media(spark, "/root/testdata/sf0.01").collect()}
    ids = {r.vec_id for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id").collect()}
    assert got.keys() == ids
    for n, how in enumerate(media.EDITS):
        edited = [k for k in ids if k % 10 == 9 and k - 1 in ids and k // 10 % len(media.EDITS) == n]
        assert sum(got[k].class_id == got[k - 1].class_id for k in edited) >= 0.9 * len(edited), how
    of_class = Counter(r.class_id for r in got.values())
    assert all(r.n_links == of_class[r.class_id] - 1 for r in got.values())


@pytest.mark.parametrize("block_rows", [media.BLOCK_ROWS, 8])
def test_classes_equal_brute_force(spark, block_rows):
    """Also with buckets dealt to many tasks, and with a class of 40 noisy copies."""
    drawn = grey_of(media.drawn(spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 40")).collect())
    rnd = np.random.default_rng(4)
    rows = drawn | {1000 + k: (drawn[7].astype(int) + rnd.integers(-2, 3, drawn[7].shape)).clip(0, 255).astype(np.uint8) for k in range(40)} | {2000: drawn[5], 2001: drawn[5]}
    got = {r.image_id: (r.class_id, r.n_links) for r in media.copies(images(spark, rows), block_rows=block_rows).collect()}
    assert got == plain_classes(rows)
    assert got[1039] == got[7] and got[7][1] >= 40 and got[2001][1] >= 2


def test_every_edit_keeps_the_link(spark):
    grey = grey_of(media.drawn(spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 10 < 9 and vec_id < 60")).collect())
    edits = [(how, {k: media.edit(g, how, k) for k, g in grey.items()}) for how in media.EDITS] + [("small_crop", {k: g[21:, 17:] for k, g in grey.items()})]
    rows = dict(grey)
    for n, (_, e) in enumerate(edits, 1):
        rows |= {k + 1000 * n: g for k, g in e.items()}
    got = {r.image_id: r.class_id for r in media.copies(images(spark, rows)).collect()}
    for n, (how, _) in enumerate(edits, 1):
        assert sum(got[k] == got[k + 1000 * n] for k in grey) >= 0.9 * len(grey), how
    # pictures of different vectors stay apart
    assert len({got[k] for k in grey}) >= 0.9 * len(grey)


def test_many_near_copies_give_few_candidates(spark):
    grey = grey_of(media.drawn(spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id = 3")).collect())[3].astype(int)
    rnd = np.random.default_rng(6)
    rows = {k: (grey + rnd.integers(-2, 3, grey.shape)).clip(0, 255).astype(np.uint8) for k in range(200)}
    found = media.features(images(spark, rows), "image_id", "width", "height", "pixels").selectExpr("_node as node", "_corners as corners")
    pairs = media.candidates(media.tables(found)).where("b is not null").count()
    assert pairs < 60 * len(rows) < 200 * 199 / 2


@pytest.mark.parametrize("block_rows", [media.BLOCK_ROWS, 20])
def test_no_pair_of_a_large_bucket_is_left_out(spark, block_rows):
    """Sixty images with two corners in two shared buckets: every two of different classes within the bits are found."""
    rnd = np.random.default_rng(5)
    d = [[[int(sum(1 << int(b) for b in rnd.choice(60, 3, replace=False))), 0] for _ in range(2)] for _ in range(60)]
    rows = [(c, k, c, *d[k][c]) for k in range(60) for c in range(2)]
    of = {k: 0 for k in range(0, 60, 3)}
    bits = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(a, b, strict=True))
    want = {(i, j) for j in range(60) for i in range(j) if of.get(i, i) != of.get(j, j) and all(bits(d[i][c], d[j][c]) <= media.LINK_BITS for c in range(2))}
    df = spark.createDataFrame(rows, "key long, node long, at int, d0 long, d1 long")
    labels = spark.createDataFrame(list(of.items()), "node long, component long")
    got = media.across(df, labels, block_rows=block_rows).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want) > 0
    rooted = {(r.a, r.b) for r in media.candidates(df).where("b is not null").collect()}
    assert not want <= rooted


@pytest.mark.parametrize(("listed", "block_rows"), [(media.LISTED, media.BLOCK_ROWS), (media.LISTED, 40), (1, media.BLOCK_ROWS)])
def test_single_links_are_no_rows(spark, monkeypatch, listed, block_rows):
    """Eighty images share a corner; every two of them are linked by it, but few by a second one, whatever is listed."""
    monkeypatch.setattr(media, "LISTED", listed)
    both = [(k, k + 1) for k in range(0, 12, 2)]
    rows = [(1, k, 0, 5, 5) for k in range(80)] + [(100 + a, k, 1 + k % 2, a, 9) for a, b in both for k in (a, b)]
    # the same corner again by another word, and a word without a link, are no second link
    rows += [(2, k, 0, 5, 5) for k in range(40, 80)] + [(3, k, 3, (1 << 40) - 1 << k % 20, k * k * 977) for k in range(60, 80)]
    df = spark.createDataFrame(rows, "key long, node long, at int, d0 long, d1 long")
    labels = spark.createDataFrame([], "node long, component long")
    made = media.links_across(df, labels, block_rows=block_rows).collect()
    if listed > 1:
        assert {(r.a, r.b) for r in made} == set(both) and len(made) < 80
    assert {(r.a, r.b) for r in media.across(df, labels, block_rows=block_rows).collect()} == set(both)


def test_large_images_have_more_corners(spark):
    grey = grey_of(media.drawn(spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 36 and vec_id % 10 < 9")).collect())
    tiles = [g for _, g in sorted(grey.items())][:25]
    wall = np.concatenate([np.concatenate(tiles[k : k + 5], 1) for k in range(0, 25, 5)])
    assert len(media.describe(wall[None])[0]) > 15 * len(media.describe(tiles[0][None])[0])
    got = {r.image_id: r.class_id for r in media.copies(images(spark, {1: wall, 2: wall[83:191, 101:222]})).collect()}
    assert got == {1: 1, 2: 1}


def test_odd_images(spark):
    flat, tiny = bytes(64 * 64), bytes(9)
    rows = [(1, 64, 64, flat, "x"), (2, 64, 64, flat, "x"), (3, 3, 3, tiny, None), (4, None, None, None, None), (5, 2, 2, tiny, None), (6, 0, 0, b"", None), (None, 64, 64, None, None), (None, 64, 64, None, None), (7, None, None, None, None), (7, 3, 2, tiny, None)]
    df = spark.createDataFrame(rows, "image_id long, width int, height int, pixels binary, class_id string")
    got = sorted(((r.image_id, r.class_id, r.n_links) for r in media.copies(df).collect()), key=str)
    assert got == sorted([(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 0), (5, 5, 0), (6, 6, 0), (7, 7, 0), (7, 7, 0), (None, None, 0), (None, None, 0)], key=str)
    assert media.copies(df.limit(0)).count() == 0


def test_pipeline_stages_against_plain_forms(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        path = f"{shared_folder(spark)}/{name.replace(' ', '-')}-{len(kept)}-{id(out)}"
        out.write.parquet(path)
        kept.append((name, docs, spark.read.parquet(path)))
        docs = kept[-1][2]
    for name, _, after in kept[:-1]:
        assert after.columns == kept[0][1].columns, name
    (_, raw, clean), (_, _, lines), (_, before, single), (_, _, mixed), (_, last_in, coded) = kept
    assert clean.join(raw, raw.columns, "left_anti").count() == 0 and clean.count() >= 0.8 * raw.count()
    assert lines.count() == clean.count()
    want = classes({r.doc_id: plain(r.text) for r in before.collect()})
    assert {r.doc_id for r in single.collect()} == {k for k, v in want.items() if k == v}
    assert mixed.count() == mixing.mix(single).agg(F.sum("copies")).first()[0]
    assert coded.count() == last_in.count() and coded.where("not exact").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == coded.count()
    assert "pipeline" in queries()


def test_pipeline_without_rows(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_a_crowded_bucket_is_not_compared_all_with_all(monkeypatch):
    rnd = np.random.default_rng(7)
    word = rnd.integers(0, 2**32, (4000, 4), dtype=np.uint32)
    for k in range(0, 4000, 8):  # near ones: up to five bits in any of the other words, or six
        word[k + 1] = word[k]
        for bit in rnd.choice(96, 5 + k % 16 // 8, replace=False):
            word[k + 1, 1 + bit // 32] ^= np.uint32(1 << bit % 32)
    word[:, 0] = 9
    d = np.ascontiguousarray(word).view(np.int64)
    node = rnd.permutation(4000)
    columns = {"key": np.full(4000, 9), "sub": np.zeros(4000, np.int64), "node": node, "of": node, "at": np.zeros(4000, np.int32), "d0": d[:, 0], "d1": d[:, 1]}
    batch = pa.RecordBatch.from_pydict(columns)
    want = {frozenset(node[[k, k + 1]].tolist()) for k in range(0, 4000, 16)}
    seen, count = [], np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: (seen.append(x.size), count(x))[1])
    links = [r for b in media._pairs_of_buckets(iter([batch]), 5) for r in b.to_pylist()]
    assert {frozenset((r["a"], r["b"])) for r in links if r["b"] is not None} == want
    rows = [r for b in media._linked_rows(iter([batch]), 5) for r in b.to_pylist()]
    assert {r["node"] for r in rows} == set().union(*want)
    assert sum(seen) < 4000 * 4000 / 10
