"""The tables of the test data as the operators' inputs, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.tracks import sessionize, with_box
from wakeline.session import table

_MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as boxes that grow with the value; a day of a user is a second of a source."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    v = F.col("value")
    cx, bottom = (F.col("k") + 0.5) / 100, F.least(F.lit(0.95), 0.45 + v / 200)
    w, h = F.least(F.lit(0.4), 0.03 + v / 250), F.least(F.lit(0.45), 0.04 + v / 220)
    e = e.select(
        F.col("user_id").alias("source"), F.when(F.col("user_id") % 2 == 0, "front").otherwise("rear").alias("camera"), F.col("event_id").alias("obs_id"),
        (F.expr(_MICROS) / 86400e6).alias("ts"), F.element_at(F.array(*map(F.lit, (2, 3, 5, 7))), (F.col("k") % 4 + 1).cast("int")).alias("class_id"), (v / 100).alias("confidence"),
        (cx - w / 2).alias("left"), (bottom - h).alias("top"), (cx + w / 2).alias("right"), bottom.alias("bottom"),
    )
    return sessionize(with_box(e), 1.0)


OBSERVATIONS_SQL = """
e0 AS (SELECT user_id AS source, CASE WHEN user_id % 2 = 0 THEN 'front' ELSE 'rear' END AS camera, event_id AS obs_id, epoch_us(ts) / 86400e6 AS ts,
  (props->>'$.k')::INT AS k, value FROM events),
e1 AS (SELECT *, (k + 0.5::DOUBLE) / 100 AS x, least(0.95::DOUBLE, 0.45::DOUBLE + value / 200) AS bottom, least(0.4::DOUBLE, 0.03::DOUBLE + value / 250) AS w, least(0.45::DOUBLE, 0.04::DOUBLE + value / 220) AS h FROM e0),
e2 AS (SELECT source, camera, obs_id, ts, ([2, 3, 5, 7])[k % 4 + 1] AS class_id, value / 100 AS confidence, x - w / 2 AS "left", bottom - h AS top, x + w / 2 AS "right", bottom FROM e1),
e3 AS (SELECT *, ("left" + "right") / 2 AS cx, greatest(0.0::DOUBLE, "right" - "left") * greatest(0.0::DOUBLE, bottom - top) AS area,
  CASE WHEN ts - lag(ts) OVER (PARTITION BY source ORDER BY ts, obs_id) > 1.0 THEN 1 ELSE 0 END AS fresh FROM e2),
obs AS (SELECT * EXCLUDE fresh, sum(fresh) OVER (PARTITION BY source ORDER BY ts, obs_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM e3)"""

TRACKS_SQL = (
    OBSERVATIONS_SQL
    + """,
t0 AS (SELECT *, row_number() OVER (PARTITION BY source, session ORDER BY ts, obs_id) - 1 AS idx, greatest(area, 1e-9::DOUBLE) AS f FROM obs),
t1 AS (SELECT *, first_value(idx) OVER (PARTITION BY source, session ORDER BY f DESC, idx) AS peak FROM t0),
t2 AS (SELECT source, session, any_value(camera) AS camera, count(*) AS detections, min(ts) AS first_seen, max(ts) AS last_seen, max(confidence) AS max_confidence, max(peak) AS peak_index,
  arg_min(class_id, idx) AS class_id, max(ts) FILTER (idx = peak) AS peak_time, max(cx) FILTER (idx = peak) AS pcx, max(bottom) FILTER (idx = peak) AS pb, max(f) FILTER (idx = peak) AS peak_area,
  arg_min(cx, idx) AS cx1, arg_min(bottom, idx) AS b1, arg_min(f, idx) AS f1, arg_max(cx, idx) AS cx2, arg_max(bottom, idx) AS b2, arg_max(f, idx) AS f2,
  count(*) FILTER (CASE WHEN camera = 'front' THEN idx >= peak ELSE idx <= peak END) AS used,
  regr_slope(ln(f), ts) FILTER (CASE WHEN camera = 'front' THEN idx >= peak ELSE idx <= peak END) AS s FROM t1 GROUP BY source, session),
t3 AS (SELECT *, CASE WHEN used < 2 OR s IS NULL OR isnan(s) THEN 0 ELSE s END AS slope, last_seen - first_seen AS duration, abs(pcx - 0.5) AS side_offset, CASE WHEN pcx < 0.5 THEN 'left' ELSE 'right' END AS side,
  CASE WHEN camera = 'front' THEN cx2 ELSE cx1 END AS ex, CASE WHEN camera = 'front' THEN b2 ELSE b1 END AS eb, CASE WHEN camera = 'front' THEN f2 ELSE f1 END AS ef, peak_index / greatest(1, detections - 1) AS peak_fraction FROM t2),
t4 AS (SELECT *, peak_area / ef AS area_ratio, pb - eb AS vertical_travel, abs(ex - 0.5) AS endpoint_offset, abs(pcx - ex) AS lateral_travel FROM t3),
t5 AS (SELECT *, vertical_travel / greatest(lateral_travel, 1e-6::DOUBLE) AS radial_ratio, ((pcx - 0.5) * (ex - 0.5) >= 0 OR endpoint_offset <= 0.04) AS centreline_consistent FROM t4),
t6 AS (SELECT *, detections >= 4 AS ok_detections, duration >= 0.8 AS ok_duration, peak_area >= 0.006 AS ok_peak_area, area_ratio >= 1.7 AS ok_area_ratio, side_offset >= 0.08 AS ok_side_offset,
  (CASE WHEN camera = 'front' THEN peak_fraction <= 0.45 AND slope < 0 ELSE peak_fraction >= 0.45 AND slope > 0 END) AND vertical_travel >= 0.06 AND centreline_consistent
  AND endpoint_offset <= side_offset + 0.03 AND radial_ratio >= 0.30 AS ok_trajectory FROM t5),
tracks AS (SELECT *, ok_detections AND ok_duration AND ok_peak_area AND ok_area_ratio AND ok_side_offset AND ok_trajectory AS candidate FROM t6)"""
)


def lanes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clicks as rear events and views as front events, in hours, by user."""
    e = table(spark, sf_dir, "events").withColumn("t", F.expr(_MICROS) / 3600e6)
    rear = e.where("event_type = 'click'").select(F.col("user_id").alias("key"), F.col("event_id").alias("rear_id"), "t")
    return rear, e.where("event_type = 'view'").select(F.col("user_id").alias("key"), F.col("event_id").alias("front_id"), "t")


LANES_SQL = """
r AS (SELECT user_id AS key, event_id AS rear_id, epoch_us(ts) / 3600e6 AS t FROM events WHERE event_type = 'click'),
f AS (SELECT user_id AS key, event_id AS front_id, epoch_us(ts) / 3600e6 AS t FROM events WHERE event_type = 'view')"""


#: Rear events with their place in the key, front events as one list of each key.
RANKED_SQL = (
    LANES_SQL
    + """,
rn AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t, rear_id) AS i FROM r),
fl AS (SELECT key, list({'t': t, 'id': front_id} ORDER BY t, front_id) AS fs FROM f GROUP BY key)"""
)


def greedy_sql(name: str, tasks: str, tolerance: float) -> str:
    """A recursive table of the greedy matching of each (key, bias) in tasks: rear_id, front_id, o, and a null row for each task."""
    return f"""
{name} AS (SELECT key, bias, 0::BIGINT AS i, []::BIGINT[] AS used, NULL::BIGINT AS rear_id, NULL::BIGINT AS front_id, NULL::DOUBLE AS o FROM {tasks} JOIN fl USING (key)
 UNION ALL SELECT g.key, g.bias, rn.i, CASE WHEN hit IS NULL THEN used ELSE list_append(used, hit) END, rn.rear_id, fs[hit].id, rn.t - fs[hit].t
 FROM {name} g JOIN rn ON rn.key = g.key AND rn.i = g.i + 1 JOIN fl ON fl.key = g.key,
 LATERAL (SELECT rn.t - g.bias AS goal) t,
 LATERAL (SELECT len(list_filter(fs, lambda x: x.t < goal)) AS p) q,
 LATERAL (SELECT list_filter(range(greatest(1, p - 1), least(len(fs), p + 3) + 1), lambda k: NOT list_contains(used, k)) AS ks) w,
 LATERAL (SELECT list_sort(list_transform(ks, lambda k: {{'d': abs(fs[k].t - goal), 'k': k}}))[1] AS b) v,
 LATERAL (SELECT CASE WHEN b.d <= {tolerance} THEN b.k END AS hit) h)"""


def hourly(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Events of a kind in each hour, counted from the first one of 2024, that the events of all kinds span; at least in the 720 hours of the SQL."""
    hour = F.floor((F.expr(_MICROS) - F.lit(1704067200000000)) / 3600e6)
    events = table(spark, sf_dir, "events")
    e = events.where(F.col("event_type") == kind).groupBy(hour.alias("idx")).agg(F.count("*").alias("n"))
    ends = events.agg(F.min(hour).alias("first"), F.max(hour).alias("last"))
    hours = ends.select(F.explode(F.sequence(F.least(F.lit(0).cast("long"), "first"), F.greatest(F.lit(719).cast("long"), "last"))).alias("idx"))
    return hours.join(e, "idx", "left").select(F.lit(kind).alias("key"), "idx", F.coalesce("n", F.lit(0)).cast("double").alias("x"))


def hourly_sql(name: str, kind: str) -> str:
    hour = "floor((epoch_us(ts) - 1704067200000000) / 3600e6)::BIGINT"
    return f"""
{name} AS (SELECT g.i AS idx, coalesce(n, 0)::DOUBLE AS x FROM (SELECT unnest(range(least(0, min({hour})), greatest(719, max({hour})) + 1)) AS i FROM events) g LEFT JOIN
  (SELECT {hour} AS i, count(*) AS n FROM events WHERE event_type = '{kind}' GROUP BY 1) c ON g.i = c.i)"""


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as recordings in a lane for each language, with what their labels make of them."""
    from wakeline.operators.rollup import status

    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("camera"), F.col("n_chars").alias("media_seconds"))
    d = d.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    run = F.col("quality").isNotNull()
    return d.select("doc_id", "camera", "media_seconds", status(run, run & (F.col("doc_id") % 7 != 0), F.col("quality") == 1).alias("status"), (F.col("media_seconds") % 97 + 1).alias("wall_seconds"), F.coalesce("toxic", F.lit(0)).cast("long").alias("events"))


FILES_SQL = """
files AS (SELECT d.doc_id, lang AS camera, n_chars AS media_seconds, CASE WHEN quality IS NULL THEN 'pending' WHEN d.doc_id % 7 = 0 THEN 'awaiting_benchmark' WHEN quality = 1 THEN 'completed' ELSE 'awaiting_validation' END AS status,
  n_chars % 97 + 1 AS wall_seconds, coalesce(toxic, 0)::BIGINT AS events FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def minutes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Events of a kind in each minute from the first event of any kind on (key, idx, x); minutes without one have no row."""
    events = table(spark, sf_dir, "events").select(F.floor(F.expr(_MICROS) / 60e6).alias("minute"), "event_type")
    start = events.agg(F.min("minute").alias("start"))  # one row
    own = events.where(F.col("event_type") == kind).groupBy("minute").agg(F.count("*").cast("double").alias("x"))
    return own.crossJoin(F.broadcast(start)).select(F.lit("all").alias("key"), (F.col("minute") - F.col("start")).alias("idx"), "x")


def minutes_sql(name: str, kind: str) -> str:
    return f"""
{name} AS (SELECT floor(epoch_us(ts) / 60e6)::BIGINT - (SELECT min(floor(epoch_us(ts) / 60e6)::BIGINT) FROM events) AS idx, count(*)::DOUBLE AS x FROM events WHERE event_type = '{kind}' GROUP BY 1)"""


def balances(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Clicks less views of every minute by a quarter of the users, and the same 137 minutes later for each quarter's number, upside down for odd ones."""
    e = table(spark, sf_dir, "events").where("event_type in ('click', 'view')")
    e = e.select((F.col("user_id") % 4).alias("key"), F.floor((F.expr(_MICROS) - F.lit(1704067200000000)) / 60e6).alias("idx"), F.when(F.col("event_type") == "click", 1.0).otherwise(-1.0).alias("x"))
    front = e.where("idx >= 0").groupBy("key", "idx").agg(F.sum("x").alias("x"))
    return front, front.select("key", (F.col("idx") + 137 * F.col("key")).alias("idx"), F.when(F.col("key") % 2 == 0, F.col("x")).otherwise(-F.col("x")).alias("x"))


BALANCES_SQL = """
fr AS (SELECT user_id % 4 AS key, floor((epoch_us(ts) - 1704067200000000) / 60e6)::BIGINT AS idx, sum(CASE event_type WHEN 'click' THEN 1.0 ELSE -1.0 END)::DOUBLE AS x FROM events WHERE event_type IN ('click', 'view') AND epoch_us(ts) >= 1704067200000000 GROUP BY 1, 2),
re AS (SELECT key, idx + 137 * key AS idx, CASE WHEN key % 2 = 0 THEN x ELSE -x END AS x FROM fr)"""
