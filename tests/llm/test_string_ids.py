"""Ids of real corpora are strings, and may be missing: every document operator takes them."""

import pytest
from pyspark.sql import functions as F

from wakeline.llm import bpe, mixing, pieces, pii, quality, sharding, simhash, spelling, suffix_dedup, toxicity
from wakeline.llm.registry import vocabulary


@pytest.fixture(scope="module")
def named(spark):
    """Fifty words each; the first two rows are copies, one id is missing, one text is."""
    words = "river mountain because letter window garden winter summer people morning".split()
    text = lambda k: " ".join(words[(i * (k + 3)) % 10] + str((i * k) % 7) for i in range(50))
    rows = [("https://a/1", text(1)), ("https://a/2", text(1)), (None, text(2)), ("x", None), ("y", f"mail me at ann.lee@example.org now, {text(5)}")]
    return spark.createDataFrame([(*r, "a", "en", 9) for r in rows], "doc_id string, text string, source string, lang string, n_chars long")


def test_numbers_of_whole_ids_are_the_ids(named):
    from wakeline.llm.keys import number

    whole = named.withColumn("doc_id", F.monotonically_increasing_id())
    assert whole.where(number(whole, "doc_id") != F.col("doc_id")).count() == 0
    assert named.select(number(named, "doc_id").alias("n")).where("n is null").count() == 1


def test_suffix_dedup(named):
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(named, keep_bytes=False).collect()}
    assert len(got) == 5 and got["https://a/1"].n_removed == got["https://a/1"].n_bytes > 0 and got["y"].n_removed == 0 and got["x"].n_bytes == 0


def test_pii(named):
    got = {r.doc_id: r for r in pii.digest(pii.find(named)).collect()}
    assert len(got) == 5 and got["y"].n_email == 1 and got[None].n_email == 0
    text = {r.doc_id: r.text for r in pii.redact(named).collect()}
    assert text["y"].startswith("mail me at [email] now") and text["x"] is None


def test_near_copies(named):
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(named).collect()}
    assert got["https://a/1"] == got["https://a/2"] == "https://a/1" and got["y"] == "y"
    assert simhash.keep_first(named).count() == 4


def test_the_others(spark, named):
    for df in (bpe.round_trip(named, vocabulary()), pieces.round_trip(named, vocabulary("piece_bpe_32k.model")), mixing.mix(named), quality.judge(named), sharding.place(named, "doc_id")):
        assert {r.doc_id for r in df.select("doc_id").collect()} == {"https://a/1", "https://a/2", None, "x", "y"}
    assert spelling.counts(named, damage=199).count() > 0
    labels = spark.createDataFrame([("https://a/1", 1, 1), ("y", 1, 0)], "doc_id string, quality int, toxic int")
    assert toxicity.score(named, toxicity.fit(named, labels)).where("score between 0 and 1").count() == 5
