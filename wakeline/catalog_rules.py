"""Queries of the rule sets on an inventory of artefacts, with documents and files made of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.catalog import query
from wakeline.operators import artefacts
from wakeline.session import table

_ROOT = "/srv/out"


def _listed(named: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in named) + "], lambda x: x IS NOT NULL)"


_FILES = ["run.json", "events.csv", "tracks.jsonl", "progress.json", "benchmark.json"]
_CAMERA = [
    ("source", "NOT bad AND k % 53 <> 0"), ("camera", "NOT bad AND k % 31 <> 0"), ("weights", "NOT bad AND k % 29 <> 0"), ("device", "NOT bad"), ("decode", "NOT bad"), ("sample_rate", "NOT bad AND k % 23 <> 0"), ("size", "NOT bad AND k % 37 <> 0"),
    ("duration", "CASE WHEN bad THEN n <= 0.05::DOUBLE ELSE abs(n + (k % 19) / 250 - n) <= 0.05::DOUBLE END"), ("processed", "abs(CASE WHEN bad THEN 0 ELSE n - (k % 9) / 6 END - n) <= 1"), ("wall", "NOT bad AND k % 41 > 0"), ("events", "true"),
    ("event_rows", "rows = CASE WHEN bad THEN 0 ELSE k % 4 END"), ("track_lines", "k % 8 = CASE WHEN bad THEN 0 ELSE k % 8 END"), ("clips", "CASE WHEN bad OR k % 2 = 0 THEN wrong = 0 ELSE named = 0 END"), ("heartbeat", "NOT bad AND k % 43 <> 0"), ("heartbeat_source", "NOT bad"), ("benchmark_source", "NOT bad"),
    ("benchmark_seconds", "bad OR abs(n - (k % 9) / 6 + (k % 6) / 400 - (n - (k % 9) / 6)) <= 0.01::DOUBLE"), ("owner", "k % 47 <> 0"),
]


@query(f"""WITH d AS (SELECT doc_id AS k, n_chars AS n, doc_id % 59 = 0 AS bad, CASE WHEN doc_id % 61 = 0 THEN 'result_outside' END AS o1, CASE WHEN doc_id % 67 = 0 THEN 'benchmark_outside' END AS o2 FROM documents),
c AS (SELECT k, unnest(range(k % 4 + (k % 33 = 0)::INT)) AS i FROM d), s AS (SELECT k, CASE WHEN (k + i) % 13 = 0 THEN 'path' WHEN (k + i) % 11 = 0 THEN 'missing' WHEN (k + i) % 17 = 0 THEN 'empty' ELSE 'there' END AS state, (k + i) % 13 <> 0 OR (k + i) % 26 = 0 AS named FROM c),
t AS (SELECT k, count(*) AS rows, count(*) FILTER (named) AS named, count(*) FILTER (state <> 'there') AS wrong, list_sort(list_distinct(list('clip_' || state) FILTER (state <> 'there'))) AS states FROM s GROUP BY k),
m AS (SELECT k, list_sort(list_filter([{', '.join(f"CASE WHEN k % {71 + 2 * i} = 0 THEN '{n}' END" for i, n in enumerate(_FILES))}], lambda x: x IS NOT NULL)) AS lacking FROM d),
j AS (SELECT d.*, coalesce(rows, 0) AS rows, coalesce(named, 0) AS named, coalesce(wrong, 0) AS wrong, coalesce(states, []::VARCHAR[]) AS states, list_concat(list_filter([o1, o2], lambda x: x IS NOT NULL), list_transform(lacking, lambda x: 'missing ' || x)) AS early FROM d LEFT JOIN t USING (k) JOIN m USING (k)),
e AS (SELECT *, CASE WHEN len(early) > 0 THEN early ELSE list_concat(CASE WHEN bad THEN ['unreadable'] ELSE []::VARCHAR[] END, {_listed(_CAMERA)}) END AS errors,
 CASE WHEN len(early) > 0 THEN []::VARCHAR[] ELSE list_concat(CASE WHEN bad OR k % 2 = 0 THEN states ELSE []::VARCHAR[] END, CASE WHEN k % 47 = 0 THEN ['owner of events.csv'] ELSE []::VARCHAR[] END) END AS details FROM j)
SELECT k AS key, errors, details, len(errors) = 0 AS valid, CASE WHEN len(early) = 0 AND (bad OR k % 3 = 0) THEN 'no_telemetry' END AS warning FROM e""")
def camera_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("key"), F.col("n_chars")
    text = lambda *parts: F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "n_chars")
    d = d.withColumns({"result_dir": text(F.when(k % 61 == 0, "/srv/outer").otherwise(_ROOT), "/b/", k), "benchmark_dir": text(F.when(k % 67 == 0, "/srv/out/../x").otherwise(_ROOT), "/bench/", k), "source": text("s", k)})
    manifest = d.select("key", F.lit("rear").alias("camera"), "source", n.cast("double").alias("duration"), n.alias("size"), "result_dir", "benchmark_dir")
    unreadable = (k % 59 == 0).alias("unreadable")
    processed = n - (k % 9) / 6
    runs = d.select(
        "result_dir", F.when(k % 53 == 0, "other").otherwise(F.col("source")).alias("run_source"), F.when(k % 31 == 0, "front").otherwise("rear").alias("run_camera"), F.when(k % 29 == 0, "old").otherwise("new").alias("weights"), F.lit("0").alias("device"), F.lit("hw").alias("decode"),
        F.when(k % 23 == 0, 4.0).otherwise(5.0).alias("sample_fps"), (n + (k % 37 == 0).cast("int")).alias("run_size"), (n + (k % 19) / 250).alias("run_duration"), processed.alias("processed_seconds"), (k % 41).cast("double").alias("wall_seconds"), (k % 4).alias("n_events"), (k % 4).alias("candidate_events"),
        (k % 8).alias("completed_tracks"), (k % 2 == 0).alias("clips_enabled"), unreadable,
    )
    beats = d.select("result_dir", F.when(k % 43 == 0, "processing").otherwise("complete").alias("heartbeat"), F.col("source").alias("heartbeat_source"), F.lit(False).alias("unreadable"))
    bench = d.select("benchmark_dir", F.col("source").alias("benchmark_source"), (processed + (k % 6) / 400).alias("benchmark_seconds"), (k % 3).alias("samples"), F.lit(None).cast("boolean").alias("telemetry_available"), F.lit(None).cast("boolean").alias("unreadable"))
    lines = d.select("result_dir", (k % 8).alias("n_lines"))
    many = k % 4 + (k % 33 == 0).cast("int")
    clips = d.where(many > 0).select("key", "result_dir", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)).alias("i")).withColumn("j", k + F.col("i"))
    name = text("/clips/", k, "_", F.col("i"), ".mp4")
    rows = clips.select("result_dir", F.when(F.col("j") % 26 == 0, text("/tmp", name)).when(F.col("j") % 13 == 0, "").otherwise(text("/output", name)).alias("clip"))
    clip_files = clips.where("j % 11 <> 0").select(text(_ROOT, name).alias("path"), F.when(F.col("j") % 17 == 0, 0).otherwise(9).alias("bytes"), F.lit(1000).alias("uid"))
    inventory = clip_files
    for i, f in enumerate(_FILES):
        folder = "benchmark_dir" if f == artefacts.BENCHMARK else "result_dir"
        owner = F.when((k % 47 == 0) & F.lit(f == "events.csv"), 0).otherwise(1000)
        inventory = inventory.unionByName(d.where(k % (71 + 2 * i) != 0).select(text(F.col(folder), f"/{f}").alias("path"), F.lit(5).alias("bytes"), owner.alias("uid")))
    return artefacts.camera_results(manifest, runs, beats, bench, rows, lines, inventory, _ROOT, 1000, "new", "0", "hw", 5.0)


_HEAD = [("root", "d % 31 <> 0"), ("evidence", "there"), ("readable", "NOT unread"), ("schema", "good AND d % 9 > 0"), ("method", "good AND d % 13 <> 0"), ("layout", "good AND st <> 'P'"), ("tolerance", "good AND d % 26 > 0 AND d % 26 <= 20"), ("accepted", "good AND n - (d % 17 = 0)::INT >= n OR NOT good"), ("clip_count", "true"), ("attempted", "true"), ("all_skipped", "NOT good OR n + d % 3 = 0 OR n > 0"), ("progress", "good AND d % 19 <> 0")]
_ROW = [("clip_missing", "state NOT IN ('missing', 'empty')"), ("clip_outside", "state <> 'outside'"), ("dimensions", "state <> 'there' OR l_suppkey % 31 <> 0"), ("event_method", "l_partkey % 211 <> 0"), ("front_track", "l_suppkey % 50 <> 0"), ("owner", "state <> 'there' OR l_partkey % 79 <> 0"), ("residual", "res IS NULL OR abs(res) <= tol"), ("residual_evidence", "res IS NOT NULL"), ("short", "state <> 'there' OR l_quantity / 2 >= 5")]


@query(f"""WITH e AS (SELECT l_orderkey AS d, l_partkey, l_suppkey, l_quantity, CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_discount * 12 - 0.5::DOUBLE END AS res,
 CASE WHEN l_partkey % 97 = 0 THEN 'outside' WHEN l_partkey % 89 = 0 THEN 'missing' WHEN l_partkey % 83 = 0 THEN 'empty' ELSE 'there' END AS state FROM lineitem),
c AS (SELECT d, count(*) AS n FROM e GROUP BY d), h AS (SELECT o_orderkey AS d, o_orderstatus AS st, o_orderkey % 41 <> 0 AS there, o_orderkey % 41 <> 0 AND o_orderkey % 43 = 0 AS unread, o_orderkey % 41 <> 0 AND o_orderkey % 43 <> 0 AS good, coalesce(n, 0) AS n, o_orderkey % 26 / 10 AS tol FROM orders LEFT JOIN c ON d = o_orderkey),
x AS (SELECT e.d, unnest({_listed(_ROW)}) AS b FROM e JOIN h ON e.d = h.d WHERE good), b AS (SELECT d, list_sort(list_distinct(list(b))) AS below FROM x GROUP BY d),
r AS (SELECT h.d, list_concat({_listed(_HEAD).replace('(d ', '(h.d ').replace(' d ', ' h.d ')}, coalesce(below, []::VARCHAR[])) AS errors FROM h LEFT JOIN b ON h.d = b.d) SELECT d AS date, errors, len(errors) = 0 AS valid FROM r""")
def combined_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("date")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("date"), "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").withColumn("date", F.col("l_orderkey"))
    dates = o.select("date", F.concat(F.when(d % 31 == 0, "/elsewhere").otherwise(_ROOT), F.lit("/combined/"), d.cast("string")).alias("result_dir"))
    n = li.groupBy("date").agg(F.count("*").alias("c"))
    heads = o.join(n, "date", "left").withColumn("n", F.coalesce("c", F.lit(0)))
    documents = heads.select("date", (2 + (d % 9 > 0).cast("int")).alias("schema_version"), F.when(d % 13 == 0, "v1").otherwise("clock_v2").alias("method"), F.when(F.col("o_orderstatus") == "P", "old").otherwise("left_right").alias("layout"), (d % 26 / 10).alias("tolerance"), (F.col("n") - (d % 17 == 0).cast("int")).alias("accepted"), F.col("n").alias("combined_clips"), (F.col("n") + d % 3).alias("attempted"), (d % 3).alias("n_skipped"), F.lit(False).alias("unreadable"))
    progress = o.select("date", F.when(d % 19 == 0, "encoding").otherwise("complete").alias("progress"), (d % 43 == 0).alias("unreadable"))
    p = F.col("l_partkey")
    part = F.concat(p.cast("string"), F.lit(".mp4"))
    clip = F.when(p % 97 == 0, F.concat(F.lit("/tmp/"), part)).otherwise(F.concat(F.lit("/output/clips/"), part))
    events = li.select("date", F.when(p % 211 == 0, "v1").otherwise("clock_v2").alias("event_method"), (F.col("l_suppkey") % 50).alias("front_track_id"), F.when(p % 37 != 0, F.col("l_discount") * 12 - 0.5).alias("residual"), clip.alias("clip"), F.lit(2560).alias("width"), (720 - (F.col("l_suppkey") % 31 == 0).cast("int")).alias("height"), (F.col("l_quantity") / 2).alias("seconds"))
    files = li.select("l_partkey").distinct().where(p % 89 != 0).select(F.concat(F.lit(f"{_ROOT}/clips/"), part).alias("path"), F.when(p % 83 == 0, 0).otherwise(7).alias("bytes"), F.when(p % 79 == 0, 0).otherwise(1000).alias("uid"))
    for name in ("combined.json", "progress.json"):
        lacking = d % 41 == 0 if name == "progress.json" else F.lit(False)
        files = files.unionByName(dates.where(~lacking).select(F.concat("result_dir", F.lit(f"/{name}")).alias("path"), F.lit(3).alias("bytes"), F.lit(1000).alias("uid")))
    return artefacts.combined_results(dates, documents, progress, events, files, _ROOT, 1000, "clock_v2", "left_right")


@query("""SELECT event_id, CASE WHEN event_type = 'view' THEN value >= 5 AND value <= 20 + 3 AND event_id % 3 > 0 ELSE value >= 5 AND event_id % 3 > 0 AND event_id % 5 > 0 END AS good,
 event_type <> 'error' AND event_id % 7 > 0 AND event_id % 11 > 0 AND event_id % 13 > 0 AS published FROM events""")
def clip_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    size = F.when(k % 3 > 0, 10)
    good = F.when(F.col("event_type") == "view", artefacts.valid_rear_only(F.lit(1920), F.lit(1080), F.lit("h264"), F.col("value"), size, F.lit(20.0))).otherwise(artefacts.valid_media(F.when(k % 5 > 0, 2560), F.lit(720), F.col("value"), size))
    layouts = [F.when(k % 11 > 0, "left_right"), F.when(k % 13 > 0, "left_right").otherwise("old")]
    published = artefacts.publishable(F.when(F.col("event_type") != "error", True), F.when(k % 7 == 0, "v1").otherwise("clock_v2"), layouts, "clock_v2", "left_right")
    return table(spark, sf_dir, "events").select("event_id", good.alias("good"), published.alias("published"))


@query("""WITH r AS (SELECT event_id AS k, event_type = 'click' AS c FROM events WHERE event_type <> 'error'), x AS (SELECT count(*) AS reviewed, count(*) FILTER (c) AS confirmed, count(*) FILTER (c AND k % 50 = 0) AS lost, count(*) FILTER (c AND k % 50 <> 0 AND k % 70 = 0) AS foreign_ FROM r)
SELECT reviewed, confirmed, reviewed - confirmed AS rejected, list_filter([CASE WHEN reviewed <> (SELECT count(*) FROM events) THEN 'reviewed' END, CASE WHEN lost > 0 THEN 'clips' END, CASE WHEN foreign_ > 0 THEN 'owner' END], lambda x: x IS NOT NULL) AS errors, reviewed = (SELECT count(*) FROM events) AND lost = 0 AND foreign_ = 0 AS valid FROM x""")
def review_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    clip = F.concat(F.lit("/srv/out/"), k.cast("string"))
    reviews = e.where("event_type <> 'error'").select((F.col("event_type") == "click").alias("confirmed"), clip.alias("clip"))
    files = e.where("event_id % 50 <> 0").select(clip.alias("path"), F.lit(1).alias("bytes"), F.when(k % 70 == 0, 0).otherwise(1000).alias("uid"))
    return artefacts.review_results(e, reviews, files, 1000)
