"""All queries of the library, bound to the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators import boxes, clocks, matching, rollup, signals, tracks
from wakeline.plans import fixtures as fx
from wakeline.session import new_folder, table
from wakeline.sources import readers, writers
from wakeline.streaming import replay

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
CHECKS = [f"ok_{c}" for c in ("detections", "duration", "peak_area", "area_ratio", "side_offset", "trajectory")]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


_TRACK_COLUMNS = ["source", "session", "camera", "detections", "side", "peak_index", *CHECKS, "centreline_consistent", "candidate"]


@query(f"WITH {fx.TRACKS_SQL} SELECT {', '.join(_TRACK_COLUMNS)}, round(duration, 3) AS duration, round(peak_area, 6) AS peak_area FROM tracks")
def track_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks.summarize(fx.observations(spark, sf_dir))
    return t.select(*_TRACK_COLUMNS, F.round("duration", 3).alias("duration"), F.round("peak_area", 6).alias("peak_area"))


@query(f"WITH {fx.OBSERVATIONS_SQL} SELECT source, session, count(*) AS n, min(obs_id) AS first_obs, max(obs_id) AS last_obs FROM obs GROUP BY source, session")
def sessionize_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observations(spark, sf_dir).groupBy("source", "session").agg(F.count("*").alias("n"), F.min("obs_id").alias("first_obs"), F.max("obs_id").alias("last_obs"))


@query(f"""WITH {fx.OBSERVATIONS_SQL}, g AS (SELECT source, obs_id, ts, CASE WHEN ts - 0.2::DOUBLE - lag(ts) OVER (PARTITION BY source ORDER BY ts, obs_id) > 1.0 THEN 1 ELSE 0 END AS fresh FROM obs),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY source ORDER BY ts, obs_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM g) SELECT source, session, count(*) AS n, min(obs_id) AS first_obs, max(obs_id) AS last_obs FROM s GROUP BY source, session""")
def sessionize_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = tracks.sessionize(fx.observations(spark, sf_dir).drop("session"), 1.0, frame=0.2)
    return framed.groupBy("source", "session").agg(F.count("*").alias("n"), F.min("obs_id").alias("first_obs"), F.max("obs_id").alias("last_obs"))


@query(f"WITH {fx.TRACKS_SQL} SELECT source, session, class_id::INT AS class_id, round(peak_area, 6) AS peak_area, peak_index, sign(round(slope, 6))::INT AS trend FROM tracks")
def track_peak_and_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks.summarize(fx.observations(spark, sf_dir))
    return t.select("source", "session", "class_id", F.round("peak_area", 6).alias("peak_area"), "peak_index", F.signum(F.round("slope", 6)).cast("int").alias("trend"))


@query(f"""WITH RECURSIVE {fx.TRACKS_SQL},
c AS (SELECT source, session, source * 100000 + session AS track_id, camera, source // 10 AS grp, side, round(peak_time, 3) AS peak_time, round(first_seen, 3) AS first_seen, round(last_seen, 3) AS last_seen, detections, duration, peak_area FROM tracks WHERE detections >= 2),
n AS (SELECT *, row_number() OVER (PARTITION BY camera, grp ORDER BY peak_time, track_id) AS i FROM c),
s AS (SELECT camera, grp, i, side, peak_time, last_seen, detections, duration, peak_area, track_id AS alive, NULL::BIGINT AS lost FROM n WHERE i = 1
 UNION ALL SELECT n.camera, n.grp, n.i,
  CASE WHEN near AND NOT wins THEN s.side ELSE n.side END, CASE WHEN near AND NOT wins THEN s.peak_time ELSE n.peak_time END, CASE WHEN near AND NOT wins THEN s.last_seen ELSE n.last_seen END,
  CASE WHEN near AND NOT wins THEN s.detections ELSE n.detections END, CASE WHEN near AND NOT wins THEN s.duration ELSE n.duration END, CASE WHEN near AND NOT wins THEN s.peak_area ELSE n.peak_area END,
  CASE WHEN near AND NOT wins THEN s.alive ELSE n.track_id END, CASE WHEN NOT near THEN NULL WHEN wins THEN s.alive ELSE n.track_id END
 FROM s JOIN n ON s.camera = n.camera AND s.grp = n.grp AND n.i = s.i + 1,
 LATERAL (SELECT n.side = s.side AND n.peak_time - s.peak_time <= 1.0 AND n.first_seen <= s.last_seen + 0.25 AS near, (n.detections, n.duration, n.peak_area) > (s.detections, s.duration, s.peak_area) AS wins))
SELECT c.source, c.session, s.lost IS NULL AS survivor, s.alive AS duplicate_of FROM c LEFT JOIN s ON s.lost = c.track_id""")
def candidate_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks.summarize(fx.observations(spark, sf_dir)).where("detections >= 2")
    t = t.withColumns({"track_id": F.col("source") * 100000 + F.col("session"), "grp": F.floor(F.col("source") / 10)})
    t = t.select("source", "session", "track_id", "camera", "grp", "side", "peak_time", "first_seen", "last_seen", "detections", "duration", "peak_area")
    return tracks.deduplicate(t, ("camera", "grp")).select("source", "session", "survivor", "duplicate_of")


@query(f"""WITH {fx.LANES_SQL}, m AS (SELECT r.key, rear_id, front_id, f.t - r.t AS delta, row_number() OVER (PARTITION BY r.key, rear_id ORDER BY abs(f.t - r.t), f.t, front_id) AS k
FROM r JOIN f ON r.key = f.key AND abs(f.t - r.t) <= 6) SELECT key, rear_id, front_id, round(delta, 6) AS delta FROM m WHERE k = 1""")
def nearest_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.nearest(*fx.lanes(spark, sf_dir), 6.0).withColumn("delta", F.round("delta", 6))


@query(f"""WITH RECURSIVE {fx.RANKED_SQL}, tasks AS (SELECT key, 0.0::DOUBLE AS bias FROM fl),{fx.greedy_sql('g', 'tasks', 6.0)}
SELECT key, rear_id, front_id, round(o, 6) AS "offset" FROM g WHERE front_id IS NOT NULL""")
def greedy_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.greedy_pairs(*fx.lanes(spark, sf_dir), 6.0).withColumn("offset", F.round("offset", 6))


@query(f"WITH {fx.LANES_SQL} SELECT key, count(*) AS n, min(bias) AS least, max(bias) AS most FROM (SELECT DISTINCT r.key, round(r.t - f.t, 1) AS bias FROM r JOIN f ON r.key = f.key AND abs(r.t - f.t) <= 120 UNION SELECT key, 0.0 FROM r) GROUP BY key")
def bias_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.candidates(*fx.lanes(spark, sf_dir), 120.0).groupBy("key").agg(F.count("*").alias("n"), F.min("bias").alias("least"), F.max("bias").alias("most"))


@query(f"""WITH RECURSIVE {fx.RANKED_SQL}, tasks AS (SELECT DISTINCT r.key, round(r.t - f.t, 1) AS bias FROM r JOIN f ON r.key = f.key AND abs(r.t - f.t) <= 120 UNION SELECT key, 0.0::DOUBLE FROM r),{fx.greedy_sql('g', 'tasks', 1.5)},
s AS (SELECT key, bias, count(front_id) AS matches, coalesce(round(sum(abs(o - bias)), 6), 0) AS residue, coalesce(median(o), 0) AS refined FROM g GROUP BY key, bias)
SELECT key, bias, matches, round(refined, 6) AS refined FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY matches DESC, residue, abs(bias), bias) AS k FROM s) WHERE k = 1""")
def bias_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.best_bias(*fx.lanes(spark, sf_dir), 1.5, 120.0).withColumn("refined", F.round("refined", 6))


@query(f"""WITH {fx.LANES_SQL}, o AS (SELECT r.key, round(r.t - f.t, 3) AS o, round(round(r.t - f.t, 3) * 1e6)::BIGINT AS u FROM r JOIN f ON r.key = f.key AND abs(r.t - f.t) <= 12), c AS (SELECT DISTINCT key, u AS c FROM o),
g AS (SELECT c.key, c, count(*) AS n, median(o) AS modal FROM c JOIN o ON c.key = o.key AND abs(u - c) <= 1500000 GROUP BY c.key, c),
s AS (SELECT g.key, g.c, g.n, g.modal, round(sum(abs(o - g.modal)), 6) AS spread FROM g JOIN o ON g.key = o.key AND abs(u - g.c) <= 1500000 GROUP BY g.key, g.c, g.n, g.modal)
SELECT key, n, round(modal, 6) AS modal FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, spread, round(abs(modal), 6), abs(c), c) AS k FROM s) WHERE k = 1""")
def modal_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rear, front = fx.lanes(spark, sf_dir)
    b = F.floor(F.col("t") / 12.0)
    r = rear.select("key", F.col("t").alias("rt"), F.explode(F.array(b - 1, b, b + 1)).alias("b"))
    pairs = r.join(front.select("key", "t", b.alias("b")), ["key", "b"]).where(F.abs(F.col("rt") - F.col("t")) <= 12)
    return matching.modal_offset(pairs.select("key", F.round(F.col("rt") - F.col("t"), 3).alias("offset")), 1.5).withColumn("modal", F.round("modal", 6))


@query(f"""WITH {fx.LANES_SQL}, m AS (SELECT r.key, rear_id, r.t AS rt, f.t - r.t AS d, row_number() OVER (PARTITION BY r.key, rear_id ORDER BY abs(f.t - r.t), f.t, front_id) AS k FROM r JOIN f ON r.key = f.key AND abs(f.t - r.t) <= 6),
p AS (SELECT r.key, r.rear_id, r.t - 473352 AS rt, -d AS o FROM r LEFT JOIN m ON r.key = m.key AND r.rear_id = m.rear_id AND k = 1),
a AS (SELECT *, greatest(0, rt - 3) AS rs FROM p), b AS (SELECT *, rs - o AS fs FROM a), c AS (SELECT key, rear_id, rt, o, rs + greatest(0, -fs) AS rs, greatest(0, fs) AS fs FROM b),
d AS (SELECT *, least(least(700, rt + 4) - rs, 700 - fs) AS s FROM c)
SELECT key, rear_id, round(rs, 3) AS rear_start, round(fs, 3) AS front_start, round(s, 3) AS seconds, CASE WHEN o IS NULL THEN 'no_match' WHEN s < 5 THEN 'too_short' END AS reason FROM d""")
def clip_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rear, front = fx.lanes(spark, sf_dir)
    pairs = rear.join(matching.nearest(rear, front, 6.0).select("key", "rear_id", (-F.col("delta")).alias("offset")), ["key", "rear_id"], "left")
    p = matching.clip_plan(pairs.select("key", "rear_id", (F.col("t") - 473352).alias("rear_time"), "offset"), 700.0, 700.0)
    blank = lambda c: F.when(F.col("offset").isNotNull(), F.round(c, 3))
    return p.select("key", "rear_id", blank("rear_start").alias("rear_start"), blank("front_start").alias("front_start"), blank("seconds").alias("seconds"), F.when(F.col("offset").isNull(), "no_match").otherwise(F.col("reason")).alias("reason"))


ORACLE_SQL["clip_plan"] = ORACLE_SQL["clip_plan"].replace("round(rs, 3) AS", "CASE WHEN o IS NOT NULL THEN round(rs, 3) END AS").replace("round(fs, 3) AS", "CASE WHEN o IS NOT NULL THEN round(fs, 3) END AS").replace("round(s, 3) AS", "CASE WHEN o IS NOT NULL THEN round(s, 3) END AS")


@query(f"""WITH {fx.FILES_SQL}, g AS (SELECT CASE WHEN grouping(camera) = 1 THEN 'overall' ELSE camera END AS lane, count(*) AS files, count(*) FILTER (status = 'completed') AS completed, sum(media_seconds)::BIGINT AS expected_seconds,
coalesce(sum(media_seconds) FILTER (status = 'completed'), 0)::BIGINT AS processed_seconds, coalesce(sum(wall_seconds) FILTER (status = 'completed'), 0)::BIGINT AS wall_seconds, coalesce(sum(events) FILTER (status = 'completed'), 0)::BIGINT AS events FROM files GROUP BY GROUPING SETS ((), (camera)))
SELECT *, round(processed_seconds / nullif(wall_seconds, 0), 6) AS real_time_factor, round((expected_seconds - processed_seconds) / (processed_seconds / nullif(wall_seconds, 0)), 3) AS seconds_left FROM g""")
def batch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.batch_rollup(fx.files(spark, sf_dir))


@query(f"WITH {fx.FILES_SQL} SELECT doc_id, status FROM files")
def status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.files(spark, sf_dir).select("doc_id", "status")


_METRICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("""WITH s AS (SELECT nullif(l_quantity, 7) AS l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, l_tax FROM lineitem WHERE l_shipdate BETWEEN '1996-01-01' AND '1998-12-31'),
u AS (UNPIVOT s ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME metric VALUE value), n AS (SELECT metric, value, row_number() OVER (PARTITION BY metric ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY metric) AS n FROM u)
SELECT metric, any_value(n) AS n, min(value) AS least, max(value) AS most, round(avg(value), 3) AS mean, max(value) FILTER (i = round_even(0.95 * (n - 1), 0)) AS p95 FROM n GROUP BY metric""")
def telemetry_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").where("l_shipdate between timestamp_ntz'1996-01-01' and timestamp_ntz'1998-12-31'")
    s = s.select(F.nullif("l_quantity", F.lit(7.0)).alias("l_quantity"), "l_extendedprice", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax")
    return rollup.telemetry_stats(s, _METRICS)


@query(f"""WITH {fx.TRACKS_SQL} SELECT source, session, candidate AND class_id IN (2, 3, 5, 7) AND max_confidence >= 0.80 AND detections >= 5 AND duration >= 1.0 AND peak_area >= 0.01 AS strong,
candidate AND max_confidence >= 0.60 AS confirmed FROM tracks""")
def review_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks.summarize(fx.observations(spark, sf_dir))
    strong = F.col("candidate") & F.col("class_id").isin(2, 3, 5, 7) & (F.col("max_confidence") >= 0.80) & (F.col("detections") >= 5) & (F.col("duration") >= 1.0) & (F.col("peak_area") >= 0.01)
    return t.select("source", "session", strong.alias("strong"), (F.col("candidate") & (F.col("max_confidence") >= 0.60)).alias("confirmed"))


@query("SELECT o_orderkey, count(l_orderkey) AS lines, count(l_orderkey) > 0 AS found FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey")
def authoritative_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    lines = F.coalesce("n", F.lit(0))
    return table(spark, sf_dir, "orders").join(n, "o_orderkey", "left").select("o_orderkey", lines.alias("lines"), (lines > 0).alias("found"))


@query("""WITH n AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS a, count(*) FILTER (o_orderstatus = 'O') AS b, max(o_orderkey) FILTER (o_orderstatus = 'F') AS first_value, max(o_orderkey) FILTER (o_orderstatus = 'O') AS second_value FROM orders GROUP BY o_custkey)
SELECT o_custkey, first_value, second_value FROM n WHERE a = 1 AND b = 1""")
def pair_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.pair_pivot(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", ("F", "O"), "o_orderkey")


@query("""SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%') AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def schedulable(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = lambda c: o.where(c).select("o_custkey")
    return rollup.schedulable(o.select("o_custkey").distinct(), key("o_totalprice > 400000"), key("o_orderpriority like '1%'"), key("o_orderstatus = 'F'"), "o_custkey")


@query("""SELECT 'click' AS lane, event_id, '' AS detail, event_type AS state FROM events WHERE event_type = 'click' UNION ALL SELECT 'error', event_id, props, 'failed' FROM events WHERE event_type = 'error'""")
def attempt_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ok = e.where("event_type = 'click'").select("event_id", F.col("event_type").alias("state"))
    bad = e.where("event_type = 'error'").select("event_id", F.col("props").alias("detail"), F.lit("failed").alias("state"))
    return rollup.attempt_union({"click": ok, "error": bad})


@query("""SELECT user_id, count(*) FILTER (event_type = 'error' AND starts_with(props, '{"k": 1')) AS failures, count(*) FILTER (event_type = 'error' AND starts_with(props, '{"k": 1')) >= 3 AS blocked FROM events GROUP BY user_id""")
def retry_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("state"), F.col("props").alias("detail"))
    return rollup.retry_guard(e, "user_id", 3, '{"k": 1')


@query("""SELECT l_orderkey, l_linenumber, l_quantity <= 40 AND l_discount < 0.08 AND l_tax > 0 AS valid,
list_filter([CASE WHEN l_quantity > 40 THEN 'quantity' END, CASE WHEN l_discount >= 0.08 THEN 'discount' END, CASE WHEN l_tax <= 0 THEN 'tax' END], lambda x: x IS NOT NULL) AS errors FROM lineitem""")
def rule_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"quantity": F.col("l_quantity") <= 40, "discount": F.col("l_discount") < 0.08, "tax": F.col("l_tax") > 0}
    return rollup.validated(table(spark, sf_dir, "lineitem"), rules).select("l_orderkey", "l_linenumber", "valid", "errors")


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All boxes of ten users of a day as one frame."""
    o = fx.observations(spark, sf_dir).withColumns({"source": F.floor(F.col("source") / 10), "frame": F.floor("ts")})
    return o.select("source", "frame", "class_id", F.col("obs_id").alias("box_id"), F.col("confidence").alias("score"), *boxes.SIDES)


_FRAMES_SQL = f"""{fx.OBSERVATIONS_SQL}, fr AS (SELECT source // 10 AS source, floor(ts)::BIGINT AS frame, class_id, obs_id AS box_id, confidence AS score, "left" AS l, top AS t, "right" AS r, bottom AS m FROM obs)"""


@query(f"""WITH {_FRAMES_SQL}, p AS (SELECT x.box_id AS a, y.box_id AS b, greatest(0, least(x.r, y.r) - greatest(x.l, y.l)) * greatest(0, least(x.m, y.m) - greatest(x.t, y.t)) AS i, (x.r - x.l) * (x.m - x.t) AS p, (y.r - y.l) * (y.m - y.t) AS q
FROM fr x JOIN fr y ON x.source = y.source AND x.frame = y.frame AND x.class_id = y.class_id AND x.box_id < y.box_id) SELECT a, b, round(i / greatest(p + q - i, 1e-9), 6) AS iou FROM p""")
def box_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _frames(spark, sf_dir)
    side = lambda p: f.select("source", "frame", "class_id", F.col("box_id").alias(p), *(F.col(s).alias(f"{p}_{s}") for s in boxes.SIDES))
    return side("a").join(side("b"), ["source", "frame", "class_id"]).where("a < b").select("a", "b", F.round(boxes.iou("a_", "b_"), 6).alias("iou"))


@query(f"""WITH RECURSIVE {_FRAMES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY source, frame, class_id ORDER BY score DESC, box_id) AS i FROM fr),
s AS (SELECT source, frame, class_id, i, box_id AS kept, [{{'l': l, 't': t, 'r': r, 'm': m}}] AS ks FROM n WHERE i = 1
 UNION ALL SELECT n.source, n.frame, n.class_id, n.i, CASE WHEN stays THEN n.box_id END, CASE WHEN stays THEN list_append(ks, {{'l': n.l, 't': n.t, 'r': n.r, 'm': n.m}}) ELSE ks END
 FROM s JOIN n ON s.source = n.source AND s.frame = n.frame AND s.class_id = n.class_id AND n.i = s.i + 1,
 LATERAL (SELECT list_transform(ks, lambda k: {{'o': greatest(0, least(k.r, n.r) - greatest(k.l, n.l)) * greatest(0, least(k.m, n.m) - greatest(k.t, n.t)), 'a': (k.r - k.l) * (k.m - k.t) + (n.r - n.l) * (n.m - n.t)}}) AS os) x,
 LATERAL (SELECT len(list_filter(os, lambda v: v.o / greatest(v.a - v.o, 1e-9) > 0.45)) = 0 AS stays) y)
SELECT source, frame, class_id, kept AS box_id FROM s WHERE kept IS NOT NULL""")
def nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes.nms(_frames(spark, sf_dir)).select("source", "frame", "class_id", "box_id")


@query("""WITH e AS (SELECT vec_id, unnest(range(4)) AS side, embedding FROM embeddings), v AS (SELECT vec_id, side, list_transform(embedding[side * 16 + 1:side * 16 + 16], lambda x: exp(x::DOUBLE)) AS w FROM e)
SELECT vec_id, side::INT AS side, round(list_sum(list_transform(w, lambda x, i: x * (i - 1))) / list_sum(w), 6) AS expected, round(list_max(w) / list_sum(w), 6) AS top FROM v""")
def box_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    parts = []
    for k in range(4):
        w = F.transform(F.slice("v", k * 16 + 1, 16), F.exp)
        parts.append(F.struct(F.lit(k).alias("side"), F.round(boxes.expectation(F.col("v"), 16, k), 6).alias("expected"), F.round(F.array_max(w) / total(w), 6).alias("top")))
    return e.select("vec_id", F.inline(F.array(*parts)))


@query(f"WITH {fx.hourly_sql('h', 'click')} SELECT idx, round(x - sum(x) OVER (ORDER BY idx ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) / 25, 6) AS detrended FROM h")
def detrend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.detrend(fx.hourly(spark, sf_dir, "click"), 25).select("idx", F.round("detrended", 6).alias("detrended"))


@query(f"WITH {fx.hourly_sql('h', 'view')} SELECT idx, d AS diff FROM (SELECT idx, x - lag(x) OVER (ORDER BY idx) AS d FROM h) WHERE d IS NOT NULL")
def first_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.first_difference(fx.hourly(spark, sf_dir, "view")).select("idx", "diff")


@query(f"WITH {fx.hourly_sql('a', 'click')}, {fx.hourly_sql('b', 'view')}, l AS (SELECT unnest(range(-24, 25)) AS lag) SELECT lag::INT AS lag, round(sum(a.x * b.x) / count(*), 6) AS score FROM l, b, a WHERE a.idx = b.idx + lag GROUP BY lag")
def xcorr_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals.xcorr(fx.hourly(spark, sf_dir, "click"), fx.hourly(spark, sf_dir, "view"), 24).withColumn("score", F.round("score", 6))


@query("""WITH t AS (SELECT event_id, 'CAM ' || CASE WHEN (props->>'$.k')::INT % 10 = 0 THEN strftime(ts, '%d/45/%Y %H:%M:%S') ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END || ' 52.0' AS text FROM events)
SELECT event_id, epoch(try_strptime(regexp_extract(text, '([0-9]{2}/[0-9]{2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2})', 1), '%d/%m/%Y %H:%M:%S'))::BIGINT AS clock_seconds FROM t""")
def overlay_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    odd = F.get_json_object("props", "$.k").cast("int") % 10 == 0
    text = F.concat(F.lit("CAM "), F.when(odd, F.date_format("ts", "dd/'45'/yyyy HH:mm:ss")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss")), F.lit(" 52.0"))
    return e.select("event_id", clocks.written(text).alias("clock_seconds"))


@query("""SELECT conv_id, min(turn) AS turn, arg_min(length(text), turn)::BIGINT AS n FROM conversations WHERE role = 'assistant' GROUP BY conv_id""")
def first_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return c.groupBy("conv_id").agg(F.min("turn").alias("turn"), F.min_by(F.length("text").cast("long"), "turn").alias("n"))


@query("""WITH o AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) > 86400000000 THEN 1 ELSE 0 END AS fresh FROM o),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id AS source, count(*) AS n, min(event_id) AS first_obs, max(event_id) AS last_obs FROM s GROUP BY user_id, k""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), "event_id", F.col("ts").cast("timestamp").alias("ts"))
    stream = replay.staged(replay.with_last_row(e, "ts", "10 days"))
    found = [F.count("*").alias("n"), F.min("event_id").alias("first_obs"), F.max("event_id").alias("last_obs")]
    return replay.replay(spark, replay.gap_sessions(stream, "source", "ts", "1 day", "1 hour", found)).drop("span")


@query("""SELECT r.user_id AS key, r.event_id AS rear_id, f.event_id AS front_id FROM events r JOIN events f ON r.user_id = f.user_id AND abs(epoch_us(r.ts) - epoch_us(f.ts)) <= 21600000000
WHERE r.event_type = 'click' AND f.event_type = 'view'""")
def stream_lane_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "event_id", "event_type", F.col("ts").cast("timestamp").alias("t"))
    side = lambda kind, name: replay.staged(e.where(F.col("event_type") == kind).select("key", F.col("event_id").alias(name), "t"))
    return replay.replay(spark, replay.interval_matches(side("click", "rear_id"), side("view", "front_id"), "6 hours", "1 hour"))


@query("""WITH o AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events), g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) > 172800000000 THEN 1 ELSE 0 END AS fresh FROM o),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id AS worker, count(*) AS beats, max(t) AS last_seen, max(t) + 172800000000 AS stale_at FROM s GROUP BY user_id, k""")
def stream_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    beats = table(spark, sf_dir, "events").select(F.col("user_id").alias("worker"), F.col("ts").cast("timestamp").alias("ts"))
    stream = replay.staged(replay.with_last_row(beats, "ts", "10 days"))
    found = replay.replay(spark, replay.timeouts(stream, "worker", "ts", "2 days", "1 hour"))
    return found.select("worker", "beats", F.unix_micros("last_seen").alias("last_seen"), F.unix_micros("stale_at").alias("stale_at"))


@query("""SELECT DISTINCT c.user_id AS key, epoch_us(date_trunc('day', c.ts)) AS day FROM events c JOIN events v ON c.user_id = v.user_id AND date_trunc('day', c.ts) = date_trunc('day', v.ts)
WHERE c.event_type = 'click' AND v.event_type = 'view' AND c.value > 20 AND v.value > 20""")
def stream_both_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("value > 20").select(F.col("user_id").alias("key"), "event_type", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"))
    side = lambda kind: replay.staged(e.where(F.col("event_type") == kind).select("key", "day"))
    ready = replay.replay(spark, replay.both_ready(side("click"), side("view"), ["key"], "day", "1 hour"))
    return ready.select("key", F.unix_micros("day").alias("day"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END::INT AS run FROM events")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    work, source, place = table(spark, sf_dir, "events").select("event_id"), new_folder(spark), new_folder(spark)
    stream = lambda run: spark.readStream.schema(work.schema).parquet(source).withColumn("run", F.lit(run))
    work.where("event_id % 3 = 0").write.parquet(source)
    first = replay.replay(spark, stream(1), place)
    replay.pending(work, first, ["event_id"]).write.mode("append").parquet(source)
    return replay.replay(spark, stream(2), place)


@query(f"WITH {fx.FILES_SQL} SELECT * FROM files")
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    files = fx.files(spark, sf_dir)
    writers.delimited(files, path, files.columns, "\t")
    return readers.manifest(spark, path)


@query(f"WITH {fx.OBSERVATIONS_SQL} SELECT source, camera, session, count(*) AS n FROM obs GROUP BY source, camera, session")
def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    sessions = fx.observations(spark, sf_dir).groupBy("source", "camera", "session").agg(F.count("*").alias("n"))
    writers.json_lines(sessions.groupBy("source", "camera").agg(F.collect_list(F.struct("session", "n")).alias("events")), path)
    docs = readers.json_lines(spark, path, "source long, camera string, events array<struct<session:long,n:long>>")
    return readers.events_of(docs, ["source", "camera"])


@query(f"""SELECT key, count(*) FILTER (reason IS NULL) AS accepted, count(*) FILTER (reason = 'no_match') AS no_match, count(*) FILTER (reason = 'too_short') AS too_short FROM ({ORACLE_SQL["clip_plan"]}) GROUP BY key""")
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.col("reason")
    counts = [F.count_if(reason.isNull()).alias("accepted"), F.count_if(reason == "no_match").alias("no_match"), F.count_if(reason == "too_short").alias("too_short")]
    return clip_plan(spark, sf_dir).groupBy("key").agg(*counts)


@query(f"""SELECT count(*) FILTER (confirmed) AS confirmed, count(*) FILTER (NOT confirmed) AS rejected, count(*) FILTER (strong) AS strong FROM ({ORACLE_SQL["review_evidence"]})""")
def review_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = review_evidence(spark, sf_dir)
    return r.agg(F.count_if("confirmed").alias("confirmed"), F.count_if(~F.col("confirmed")).alias("rejected"), F.count_if("strong").alias("strong"))


@query("""SELECT l_orderkey, l_linenumber, 'combined' AS origin FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT l_orderkey, l_linenumber, 'review' FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 30 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')""")
def publish_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    items = table(spark, sf_dir, "lineitem").withColumn("confirmed", (F.col("l_returnflag") == "N") & (F.col("l_quantity") > 30))
    valid = lambda s: o.withColumn("valid", F.col("o_orderstatus") == s)
    return rollup.publish_list(items, valid("F"), items, valid("O"), "l_orderkey", ("l_linenumber",))


@query("""WITH b AS (SELECT l_orderkey, list_sort(list_distinct(list(e))) AS below FROM (SELECT l_orderkey, unnest([CASE WHEN l_quantity > 45 THEN 'quantity' END, CASE WHEN l_discount >= 0.09 THEN 'discount' END]) AS e FROM lineitem) WHERE e IS NOT NULL GROUP BY l_orderkey)
SELECT o_orderkey AS l_orderkey, errors, len(errors) = 0 AS valid FROM (SELECT o_orderkey, list_concat(CASE WHEN o_totalprice <= 400000 THEN []::VARCHAR[] ELSE ['price'] END, coalesce(below, []::VARCHAR[])) AS errors FROM orders LEFT JOIN b ON o_orderkey = l_orderkey)""")
def combined_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rules = {"quantity": F.col("l_quantity") <= 45, "discount": F.col("l_discount") < 0.09}
    return rollup.validated_groups(o, table(spark, sf_dir, "lineitem"), "l_orderkey", {"price": F.col("o_totalprice") <= 400000}, rules)


@query("""WITH l AS (SELECT user_id, max(epoch_us(ts)) FILTER (event_type = 'view') / 3600e6 AS last_beat, min(epoch_us(ts)) / 3600e6 AS started FROM events GROUP BY user_id)
SELECT user_id AS key, round(last_beat, 6) AS last_beat, 474000 - coalesce(last_beat, started) > 300 AS silent FROM l""")
def heartbeat_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.expr(fx._MICROS).alias("us"), "event_type")
    starts = e.groupBy("key").agg((F.min("us") / 3600e6).alias("started"))
    beats = e.where("event_type = 'view'").select("key", (F.col("us") / 3600e6).alias("at"))
    return rollup.watchdog(starts, beats, "key", F.lit(474000.0), 300.0).withColumn("last_beat", F.round("last_beat", 6))


from wakeline import catalog_batch, catalog_more, catalog_rules, catalog_signals  # noqa: E402, F401  register the rest
