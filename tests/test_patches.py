"""Documents patched from a report, places in the batch, row counts."""

import json

import pytest
from pyspark.sql import functions as F

from wakeline.operators import patches
from wakeline.sources import readers

DOCS = "date string, layout string, events array<struct<clip:string,n:int,media:struct<w:int>>>"
REPORT = "date string, filename string, media struct<w:int>"


def patched(spark, docs, report):
    d = spark.createDataFrame([(k, "old", [(f"/out/{k}/{c}", i, (0,)) for i, c in enumerate(clips)] if clips is not None else None) for k, clips in docs], DOCS)
    r = spark.createDataFrame([(k, c, (w,)) for k, c, w in report], REPORT)
    return patches.patched(d, r, "date", "media", {"layout": F.lit("new")})


def test_every_event_gets_its_own_entry_in_order(spark):
    got = {r.date: r for r in patched(spark, [("a", ["z", "b", "c"]), ("b", ["z"])], [("a", "b", 2), ("a", "z", 1), ("a", "c", 3), ("b", "z", 9)]).collect()}
    assert [(e.clip, e.n, e.media.w) for e in got["a"].events] == [("/out/a/z", 0, 1), ("/out/a/b", 1, 2), ("/out/a/c", 2, 3)]
    assert [e.media.w for e in got["b"].events] == [9] and {r.layout for r in got.values()} == {"new"}
    assert patched(spark, [], []).collect() == []
    assert patched(spark, [("a", None), ("b", [])], []).count() == 2


@pytest.mark.parametrize("docs,report,text", [
    ([("a", ["x", "y"])], [("a", "x", 1)], "no entry for y in a"),
    ([("a", ["x"])], [("a", "x", 1), ("a", "y", 1)], "no event for y in a"),
    ([("a", ["x"])], [("a", "x", 1), ("b", "x", 1)], "a report without a document in b"),
    ([("a", ["x"]), ("b", ["x"])], [("a", "x", 1)], "no entry for x in b"),
    ([("a", ["x"])], [("a", "x", 1), ("a", "x", 2)], "a name is there twice in a"),
    ([("a", ["x", "x"])], [("a", "x", 1)], "a name is there twice in a"),
])
def test_what_is_not_complete_in_both_directions_is_an_error(spark, docs, report, text):
    with pytest.raises(Exception, match=text):
        patched(spark, docs, report).select("layout").collect()


def test_places_in_the_batch(spark):
    rows = spark.createDataFrame([("/b/rear/2026-05-01/v1/run.json",), ("/b/front/2026-05-02/v2/run.json",), ("run.json",)], "path string")
    got = [(r.place, *r.p) for r in patches.in_path_order(rows).select("place", patches.place_in_batch(F.col("path")).alias("p")).collect()]
    assert got == [(0, "front", "2026-05-02", "v2"), (1, "rear", "2026-05-01", "v1"), (2, None, None, None)]


def test_parts_of_documents(spark):
    runs = spark.createDataFrame([(1, "s", "front", 9, (1, [2]))], "id int, source string, camera string, extra int, calibration struct<bias:int,matches:array<int>>")
    run = patches.benchmark_document(runs, ["id"]).first().run
    assert run.source == "s" and run.weights is None and list(run.asDict()) == list(patches.RUN_FIELDS)
    assert patches.without_matches(runs, "calibration").first().calibration.asDict() == {"bias": 1}


def test_rows_and_lines_are_compared(spark, tmp_path):
    for k, n in (("a", 3), ("b", 0), ("c", 2)):
        (tmp_path / f"{k}.csv").write_text("x,y\n" + "1,2\n" * n)
        (tmp_path / f"{k}.jsonl").write_text("\n".join([json.dumps({"x": 1})] * (2 if k == "c" else n)) + "\n\n" + ("" if k != "c" else "{}\n"))
    name = F.regexp_extract("path", "([a-z]).(csv|jsonl)$", 1).alias("k")
    got = readers.compared(readers.csv_counts(spark, f"{tmp_path}/*.csv").select(name, "n_rows"), readers.line_counts(spark, f"{tmp_path}/*.jsonl").select(name, "n_lines"), "k")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3, 3, True), ("b", 0, 0, True), ("c", 2, 3, False)]
