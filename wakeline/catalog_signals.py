"""Queries of long correlations, recordings' sound and frames, and the detector's head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.catalog import query
from wakeline.operators import boxes, correlation, signals
from wakeline.plans import fixtures as fx
from wakeline.session import new_folder, table
from wakeline.sources import readers, recordings

_LAGS = 4000


def _scores_sql(keyed: str, most: int) -> str:
    """Tables fr and re (key, idx, x) as scores by lag."""
    return f"""
n AS (SELECT key, front_n, rear_n FROM (SELECT key, max(idx) + 1 AS front_n FROM fr GROUP BY key) JOIN (SELECT key, max(idx) + 1 AS rear_n FROM re GROUP BY key) USING (key)),
p AS (SELECT fr.key, re.idx - fr.idx AS lag, sum(fr.x * re.x) AS total FROM fr JOIN re ON fr.key = re.key AND re.idx BETWEEN fr.idx - {most} AND fr.idx + {most} GROUP BY 1, 2),
g AS (SELECT key, unnest(range(-{most}, {most} + 1)) AS lag, front_n, rear_n FROM n),
{keyed} AS (SELECT g.key, g.lag, coalesce(total, 0) AS total, greatest(1, least(front_n, rear_n - greatest(g.lag, 0), front_n + least(g.lag, 0))) AS overlap FROM g LEFT JOIN p ON p.key = g.key AND p.lag = g.lag)"""


@query(f"""WITH {fx.minutes_sql('a', 'click')}, {fx.minutes_sql('b', 'view')}, fr AS (SELECT 'all' AS key, * FROM a), re AS (SELECT 'all' AS key, * FROM b), {_scores_sql('s', _LAGS)}
SELECT lag, overlap, round(total, 3) AS total, round(total / overlap, 9) AS score FROM s""")
def correlation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = correlation.cross_correlation(fx.minutes(spark, sf_dir, "click"), fx.minutes(spark, sf_dir, "view"), _LAGS)
    return s.select("lag", "overlap", (F.round("total", 3) + F.lit(0.0)).alias("total"), (F.round("score", 9) + F.lit(0.0)).alias("score"))


def _best_sql(worth: str) -> str:
    return f"""WITH {fx.BALANCES_SQL}, {_scores_sql('s', 600)}, w AS (SELECT *, round(total / overlap, 9) AS score, {worth} AS worth FROM s),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY worth DESC, lag) AS i FROM w) WHERE i = 1), o AS (SELECT w.key, max(w.worth) AS second FROM w JOIN m ON w.key = m.key AND abs(w.lag - m.lag) > 20 GROUP BY w.key)
SELECT m.key, round(m.lag / 2, 3) AS offset_seconds, m.worth AS score, CASE WHEN m.score >= 0 THEN 1 ELSE -1 END AS polarity, CASE WHEN second > 0 THEN round(m.worth / second, 3) END AS score_ratio FROM m LEFT JOIN o ON o.key = m.key"""


def _balance_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = correlation.cross_correlation(*fx.balances(spark, sf_dir), 600)
    return s.withColumn("score", F.round("score", 9) + F.lit(0.0))


@query(_best_sql("round(abs(total / overlap), 9)"))
def correlation_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.best_offset(_balance_scores(spark, sf_dir), 2.0, absolute=True)


@query(_best_sql("round(total / overlap, 9)"))
def correlation_upright(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.best_offset(_balance_scores(spark, sf_dir), 2.0)


_BYTES = "list_transform(embedding[1:48], lambda x: greatest(0, least(255, floor((x::DOUBLE + 1) * 128)))::BIGINT)"
_FRAMES_SQL = f"v AS (SELECT 's' || (vec_id % 8) AS source, vec_id // 8 AS frame, vec_id // 8 / 5 AS ts, upper(list_aggregate(list_transform({_BYTES}, lambda b: printf('%02x', b)), 'string_agg', '')) AS pixels FROM embeddings)"


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames of 4 x 4 pixels of eight sources."""
    level = lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1) * 128))).cast("long")
    pixels = F.unhex(F.array_join(F.transform(F.slice("embedding", 1, 48), lambda x: F.lpad(F.hex(level(x)), 2, "0")), ""))
    return table(spark, sf_dir, "embeddings").select(F.concat(F.lit("s"), F.col("vec_id") % 8).alias("source"), F.floor(F.col("vec_id") / 8).alias("frame"), pixels.alias("data"))


def _recorded_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames, five a second, written as raw files and read back."""
    path = new_folder(spark)
    recordings.write_segments(_pixels(spark, sf_dir), path, 48, 100)
    return recordings.frames(spark, path, 4, 4, 5.0)


@query(f"WITH {_FRAMES_SQL} SELECT source, frame, round(ts, 3) AS ts, pixels FROM v WHERE source IN ('s1', 's4', 's6') AND ts >= 2 AND ts < 9")
def frame_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _recorded_frames(spark, sf_dir).where("source in ('s1', 's4', 's6') and ts >= 2D and ts < 9D")
    return f.select("source", "frame", F.round("ts", 3).alias("ts"), F.hex("data").alias("pixels"))


@query(f"WITH {_FRAMES_SQL}, w AS (SELECT DISTINCT 's' || (doc_id % 8) AS source, (doc_id % 60) / 7 AS t FROM labels) SELECT v.source, round(t, 6) AS t, frame, substr(pixels, 73, 12) AS clock_pixels FROM w JOIN v ON w.source = v.source AND frame = ceil(round(t * 5, 6))::BIGINT")
def frame_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "labels").select(F.concat(F.lit("s"), F.col("doc_id") % 8).alias("source"), ((F.col("doc_id") % 60) / 7).alias("t")).distinct()
    found = recordings.frames_at(_recorded_frames(spark, sf_dir), wanted, 5.0)
    return found.select("source", F.round("t", 6).alias("t"), "frame", F.hex(recordings.lower_left(F.col("data"), 4, 4)).alias("clock_pixels"))


@query("""WITH s AS (SELECT 'mic' || (vec_id % 4) AS key, vec_id // 4 * 64 + j - 1 AS i, greatest(-32768, least(32767, floor(embedding[j]::DOUBLE * 9000))) AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS j)),
b AS (SELECT key, i // 50 AS idx, ln(1 + sqrt(sum(x * x) / 50 + 1)) AS x FROM s GROUP BY 1, 2 HAVING count(*) = 50),
d AS (SELECT key, idx, x - sum(x) OVER (PARTITION BY key ORDER BY idx ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING) / 10 AS x FROM b), e AS (SELECT key, stddev_pop(x) AS sd FROM d GROUP BY key)
SELECT d.key, idx, round(x / sd, 6) AS envelope FROM d JOIN e ON d.key = e.key""")
def sound_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = lambda x: F.greatest(F.lit(-32768), F.least(F.lit(32767), F.floor(x.cast("double") * 9000)))
    little = lambda v: F.concat(F.substring(v, 3, 2), F.substring(v, 1, 2))
    word = lambda x: little(F.lpad(F.hex(F.pmod(sample(x), F.lit(65536)).cast("long")), 4, "0"))
    e = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("mic"), F.col("vec_id") % 4).alias("source"), (F.floor(F.col("vec_id") / 4) * 64).alias("frame"), F.unhex(F.array_join(F.transform("embedding", word), "")).alias("data"))
    path = new_folder(spark)
    recordings.write_segments(e, path, 2)
    blocks = recordings.sound_blocks(spark, path, 50, least_samples=1000, samples_per_task=777)
    return signals.normalised(blocks, 10, strict=True).select("key", "idx", F.round("envelope", 6).alias("envelope"))


@query(f"WITH {_FRAMES_SQL} SELECT source, frame, repeat('72', 72) || pixels || repeat('72', 72) AS square FROM v")
def letterbox_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _recorded_frames(spark, sf_dir)  # 48 bytes are 8 x 2 pixels as well
    return f.select("source", "frame", F.hex(boxes.letterboxed(F.col("data"), 8, 2, 8)).alias("square"))


_CLASSES, _CHANNELS = 10, 74


@query(f"""WITH RECURSIVE g AS (SELECT unnest([8, 16, 32]) AS stride), c AS (SELECT stride, 64 // stride AS side, unnest(range((64 // stride) * (64 // stride))) AS cell FROM g),
e AS (SELECT vec_id, stride, side, cell, list_transform(range({_CHANNELS}), lambda j: embedding[(cell * 31 + j * 7 + stride) % 64 + 1]::DOUBLE * CASE WHEN j < 64 THEN 40 ELSE 12 END) AS v FROM embeddings, c),
s AS (SELECT * EXCLUDE v, v[65:] AS k, v FROM e), t AS (SELECT *, 1 / (1 + exp(-list_max(k))) AS score, list_position(k, list_max(k))::INT - 1 AS class_id FROM s),
w AS (SELECT *, list_transform(range(4), lambda q: list_transform(v[q * 16 + 1:q * 16 + 16], lambda x: exp(x - list_max(v[q * 16 + 1:q * 16 + 16])))) AS ws FROM t WHERE score >= 0.6 AND class_id IN (2, 3, 5, 7)),
d AS (SELECT *, list_transform(ws, lambda a: list_sum(list_transform(a, lambda x, i: x * (i - 1))) / list_sum(a)) AS d, cell % side + 0.5::DOUBLE AS ax, cell // side + 0.5::DOUBLE AS ay FROM w),
b AS (SELECT vec_id, class_id, score, stride * 4294967296 + cell AS box_id, (ax - d[1]) * stride AS l, (ay - d[2]) * stride AS t, (ax + d[3]) * stride AS r, (ay + d[4]) * stride AS m FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY vec_id, class_id ORDER BY score DESC, box_id) AS i FROM b),
z AS (SELECT vec_id, class_id, i, box_id AS kept, [{{'l': l, 't': t, 'r': r, 'm': m}}] AS ks FROM n WHERE i = 1
 UNION ALL SELECT n.vec_id, n.class_id, n.i, CASE WHEN stays THEN n.box_id END, CASE WHEN stays THEN list_append(ks, {{'l': n.l, 't': n.t, 'r': n.r, 'm': n.m}}) ELSE ks END
 FROM z JOIN n ON z.vec_id = n.vec_id AND z.class_id = n.class_id AND n.i = z.i + 1,
 LATERAL (SELECT list_transform(ks, lambda k: {{'o': greatest(0, least(k.r, n.r) - greatest(k.l, n.l)) * greatest(0, least(k.m, n.m) - greatest(k.t, n.t)), 'a': (k.r - k.l) * (k.m - k.t) + (n.r - n.l) * (n.m - n.t)}}) AS os) x,
 LATERAL (SELECT len(list_filter(os, lambda v: v.o / greatest(v.a - v.o, 1e-9) > 0.45)) = 0 AS stays) y),
o AS (SELECT b.vec_id, b.class_id, score, box_id, least(1280::DOUBLE, greatest(0, l / 0.05::DOUBLE)) AS x1, least(720::DOUBLE, greatest(0, (t - 14) / 0.05::DOUBLE)) AS y1, least(1280::DOUBLE, greatest(0, r / 0.05::DOUBLE)) AS x2, least(720::DOUBLE, greatest(0, (m - 14) / 0.05::DOUBLE)) AS y2 FROM b JOIN z ON z.vec_id = b.vec_id AND z.class_id = b.class_id AND z.kept = b.box_id)
SELECT vec_id, class_id, CASE class_id WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' ELSE 'truck' END AS class_name, round(score, 5) AS confidence, round(x1, 2) AS x1, round(y1, 2) AS y1, round(x2, 2) AS x2, round(y2, 2) AS y2,
 round(x1 / 1280, 5) AS u1, round(y1 / 720, 5) AS v1, round(x2 / 1280, 5) AS u2, round(y2 / 720, 5) AS v2, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id, box_id) AS place FROM o WHERE x2 > x1 AND y2 > y1""")
def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")

    def features(stride: int) -> Column:
        def value(i: Column) -> Column:
            place = (F.floor(i / _CHANNELS) * 31 + i % _CHANNELS * 7 + stride).cast("int") % 64 + 1
            return F.element_at("embedding", place).cast("double") * F.when(i % _CHANNELS < 64, 40).otherwise(12)

        return F.transform(F.sequence(F.lit(0), F.lit((64 // stride) ** 2 * _CHANNELS - 1)), value)

    maps = [e.select("vec_id", F.lit(s).alias("stride"), features(s).alias("features")) for s in (8, 16, 32)]
    return boxes.detections(maps[0].unionByName(maps[1]).unionByName(maps[2]), ["vec_id"], (1280, 720), 0.05, 0.0, 14.0, 64, 16, _CLASSES, confidence=0.6)


@query("SELECT 's' || (vec_id % 8) AS date, count(*) * 48 AS size_bytes FROM embeddings GROUP BY 1")
def recording_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of recordings that were written, found by walking their folders."""
    path = new_folder(spark)
    recordings.write_segments(_pixels(spark, sf_dir), path, 48, 100)
    return readers.recordings(spark, path, ".raw").groupBy("date").agg(F.sum("size_bytes").alias("size_bytes"))
