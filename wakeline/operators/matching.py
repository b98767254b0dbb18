"""Two event lists matched in time: nearest, greedy one to one, and the search for their clock bias."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.groups import whole_groups
from wakeline.operators.ranges import gap_groups
from wakeline.session import settle


def nearest(rear: DataFrame, front: DataFrame, tolerance: float, key: str = "key") -> DataFrame:
    """Each rear row (key, rear_id, t) with the front row (key, front_id, t) nearest within tolerance.

    The band becomes an equi-join on time buckets one tolerance wide, so a key's rows meet only neighbours.
    """
    bucket = F.floor(F.col("t") / tolerance)
    r = rear.select(key, "rear_id", F.col("t").alias("rt"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    f = front.select(key, "front_id", F.col("t").alias("ft"), bucket.alias("b"))
    delta = F.abs(F.col("ft") - F.col("rt"))
    best = r.join(f, [key, "b"]).where(delta <= tolerance).groupBy(key, "rear_id", "rt").agg(F.min(F.struct(delta.alias("d"), "ft", "front_id")).alias("m"))
    return best.select(key, "rear_id", F.col("m.front_id").alias("front_id"), (F.col("m.ft") - F.col("rt")).alias("delta"))


#: Free rows are looked for this many places around the target (fixed value).
REACH = 2


def greedy(rear: list[tuple[float, int]], front: list[tuple[float, int]], bias: float, tolerance: float) -> list[tuple[int, int, float]]:
    """(rear id, front id, rear time - front time): rear rows in order each take the free front row nearest to their
    target, within REACH places of where it would stand; of equally near ones the earlier."""
    order, out = sorted(front), []
    times = [t for t, _ in order]
    free = [True] * len(order)
    for t, k in sorted(rear):
        goal = t - bias
        at = bisect_left(times, goal)
        least, chosen = tolerance, -1
        for j in range(max(0, at - REACH), min(len(order), at + REACH + 1)):
            apart = abs(times[j] - goal)
            if free[j] and (apart < least or (chosen < 0 and apart == least)):
                least, chosen = apart, j
        if chosen >= 0:
            free[chosen] = False
            out.append((k, order[chosen][1], t - times[chosen]))
    return out


def _both(rear: DataFrame, front: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both sides, with the bias that each is to be matched at."""
    r = rear.select(*keys, F.col("rear_id").alias("id"), F.lit(True).alias("is_rear"), "t", F.col("bias").alias("_bias"), (F.col("t") - F.col("bias")).alias("target"))
    return r.unionByName(front.select(*keys, F.col("front_id").alias("id"), F.lit(False).alias("is_rear"), "t", F.col("bias").alias("_bias"), F.col("t").alias("target")))


def _matched(rows: DataFrame, keys: list[str], tolerance: float, spread: bool = False) -> DataFrame:
    """keys, rear_id, front_id, offset of the greedy matching in each group of keys.

    Rows further apart than the tolerance cannot compete, so keys fall at such gaps into groups, and keys
    with very many rows are matched by many tasks. Rows between two gaps are matched in one task. With spread the
    gaps are found in ranges of a key.
    """
    rows = gap_groups(rows, keys, ["target", "is_rear", "id"], "target", tolerance, "_group", spread=spread).drop("target")
    own = [*keys, "_group"]
    sides = [F.count_if(s).over(Window.partitionBy(*own)) for s in (F.col("is_rear"), ~F.col("is_rear"))]
    rows = rows.withColumns({"_rear": sides[0], "_front": sides[1]}).where("_rear > 0 and _front > 0").drop("_rear", "_front")

    def match(batches):
        for g, at in whole_groups(batches, own):
            out = []
            cols = [g[c].tolist() for c in ("t", "id", "is_rear", "_bias")]
            names = list(zip(*(g[k].tolist() for k in keys), strict=True))
            for i, j in zip(at[:-1], at[1:], strict=True):
                here = list(zip(*(c[i:j] for c in cols), strict=True))
                lists = [[(t, k) for t, k, is_rear, _ in here if is_rear == s] for s in (True, False)]
                out += [(*names[i], *m) for m in greedy(*lists, cols[3][i], tolerance)]
            yield pd.DataFrame(out, columns=[*keys, "rear_id", "front_id", "offset"])

    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.repartition(*own).sortWithinPartitions(*own).mapInPandas(match, f"{kinds}, rear_id long, front_id long, offset double")


def greedy_pairs(rear: DataFrame, front: DataFrame, tolerance: float, bias: float = 0.0, key: str = "key", spread: bool = False) -> DataFrame:
    """key, rear_id, front_id, offset of the greedy one-to-one matching in each key."""
    sides = [x.withColumn("bias", F.lit(float(bias))) for x in (rear, front)]
    return _matched(_both(*sides, [key]), [key], tolerance, spread)


def candidates(rear: DataFrame, front: DataFrame, bound: float, key: str = "key", seeds: tuple[float, ...] = (0.0,)) -> DataFrame:
    """Distinct biases (to a tenth) of each key's pairs within the bound, and the seeds, which may lie beyond it.

    Pairs come from buckets one bound wide. Spark takes exploded rows for as few as there were before, so they are merged.
    """
    bucket = F.floor(F.col("t") / bound)
    r = rear.select(key, F.col("t").alias("rt"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    f = front.select(key, F.col("t").alias("ft"), bucket.alias("b"))
    bias = F.col("rt") - F.col("ft")
    found = r.join(f.hint("merge"), [key, "b"]).where(F.abs(bias) <= bound).select(key, F.round(bias, 1).alias("bias"))
    return found.unionByName(rear.select(key, F.explode(F.array(*map(F.lit, seeds))).alias("bias"))).distinct()


def _reach(rear: DataFrame, front: DataFrame, tolerance: float, bound: float, key: str) -> DataFrame:
    """key, cell, most: how many rear rows a matching at a bias in a cell, one tolerance wide, can have at most.

    A match at a bias needs a pair within the tolerance of it; a pair is that near to biases of four cells or fewer.
    """
    wide = bound + tolerance
    bucket = F.floor(F.col("t") / wide)
    r = rear.select(key, "rear_id", F.col("t").alias("rt"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    f = front.select(key, F.col("t").alias("ft"), bucket.alias("b"))
    o = F.col("rt") - F.col("ft")
    # a little to spare on each side, as the bias itself is rounded
    cells = F.sequence(F.floor((o - tolerance) / tolerance - 1e-6), F.floor((o + tolerance) / tolerance + 1e-6))
    near = r.join(f.hint("merge"), [key, "b"]).where(F.abs(o) <= wide).select(key, "rear_id", F.explode(cells).alias("cell")).distinct()
    return near.groupBy(key, "cell").agg(F.count("*").alias("most"))


def _searched(rear: DataFrame, front: DataFrame, tolerance: float, bound: float, key: str, preferred: float = 0.0, seeds: tuple[float, ...] = (0.0,)) -> tuple[DataFrame, DataFrame]:
    """The best bias of each key (key, bias, matches, refined), and the pairs at all biases tried (key, bias, rear_id, front_id, offset).

    The bias that can reach most is matched first; of the others only those that can still reach as many.
    """
    limit, bound = bound, max(bound, *map(abs, seeds))
    tasks = candidates(rear, front, limit, key, seeds).join(front.select(key).distinct(), key, "left_semi").withColumn("cell", F.floor(F.col("bias") / tolerance))
    tasks = settle(tasks.join(_reach(rear, front, tolerance, bound, key), [key, "cell"], "left").na.fill({"most": 0}).drop("cell"))

    def matched(own: DataFrame) -> DataFrame:
        # Events come in as few partitions as they alone fill, but leave the join once for each bias: dealt anew, a task has what
        # it can sort. A whole number deals them, as Spark deals by doubles once more before a window.
        own = own.select(key, "bias", F.round(F.col("bias") * 10).cast("long").alias("_tenths"))
        keys = [key, "_tenths", "bias"]
        rows = _both(rear.join(own, key), front.join(own, key), keys).repartition(key, "_tenths")
        return settle(_matched(rows, keys, tolerance).drop("_tenths"))

    first = tasks.groupBy(key).agg(F.max_by("bias", F.struct("most", -F.abs(F.col("bias") - preferred), -F.col("bias"))).alias("bias"))
    pairs = matched(first)
    least = first.join(pairs.groupBy(key).agg(F.count("*").alias("least")), key, "left").na.fill({"least": 0}).withColumnRenamed("bias", "_first")
    others = tasks.hint("merge").join(least, key).where((F.col("bias") != F.col("_first")) & (F.col("most") >= F.col("least")))
    tried = first.select(key, "bias").unionByName(others.select(key, "bias"))
    pairs = pairs.unionByName(matched(others))
    size = F.round(F.sum(F.abs(F.col("offset") - F.col("bias"))), 6)
    scored = pairs.groupBy(key, "bias").agg(F.count("*").alias("matches"), size.alias("residue"), F.median("offset").alias("refined"))
    done = tried.join(scored, [key, "bias"], "left").na.fill({"matches": 0, "residue": 0.0, "refined": 0.0})
    rank = F.struct(-F.col("matches"), F.col("residue"), F.round(F.abs(F.col("bias") - preferred), 6), F.abs("bias"), F.col("bias"))
    return done.groupBy(key).agg(F.min_by(F.struct("bias", "matches", "refined"), rank).alias("m")).select(key, "m.*"), pairs


def best_bias(rear: DataFrame, front: DataFrame, tolerance: float, bound: float, key: str = "key") -> DataFrame:
    """key, bias, matches, refined: the bias with most greedy matches, then least residue, then least size.

    Candidates are matched as rows of their key and bias, which fall apart at gaps: no list of a key's events is made.
    """
    return _searched(rear, front, tolerance, bound, key)[0]


def event_offset(rear: DataFrame, front: DataFrame, transition: float, tolerance: float, bound: float, fallback: float, key: str = "key") -> DataFrame:
    """key, offset, matches, anchor_rear, anchor_front, method of each key of rear, where an event takes `transition` from front to rear.

    Candidates are the pairs' offsets within the bound, the fallback, 10 and 0; the one nearest to the fallback wins among
    equals. A key without events on one side has the fallback, by method duration_fallback.
    """
    moved = rear.withColumn("t", F.col("t") + transition)
    best, tried = _searched(moved, front, tolerance, bound, key, fallback, tuple(sorted({round(fallback, 1), 10.0, 0.0})))
    best = settle(best)
    kept = tried.join(best.select(key, "bias"), [key, "bias"], "left_semi").join(moved.select(key, "rear_id", "t"), [key, "rear_id"])
    off = F.round(F.abs(F.col("offset") - F.col("bias")), 6)
    anchors = kept.groupBy(key).agg(F.min_by(F.struct("rear_id", "front_id"), F.struct(off, "t", "rear_id")).alias("a"))
    out = rear.select(key).distinct().join(best, key, "left").join(anchors, key, "left")
    method = F.when(F.col("bias").isNull(), "duration_fallback").otherwise("event_sequence")
    return out.select(key, F.coalesce("bias", F.lit(float(fallback))).alias("offset"), F.coalesce("matches", F.lit(0)).alias("matches"), F.col("a.rear_id").alias("anchor_rear"), F.col("a.front_id").alias("anchor_front"), method.alias("method"))


def composed(plan: DataFrame, size: tuple[int, int] = (2560, 720)) -> DataFrame:
    """plan (of clip_plan, with key, rear_id, front_id, offset, residual) as nested rows: what a composer is to make, and why.

    media are the facts that a dry run states in place of a clip's own. Rows with a reason are not composed.
    """
    sync = F.struct(F.lit("clock").alias("method"), F.col("offset").alias("physical_offset"), F.col("residual").alias("clock_residual"))
    media = F.struct(F.lit(size[0]).alias("width"), F.lit(size[1]).alias("height"), F.col("seconds").alias("duration"), F.lit(True).alias("planned"))
    cut = lambda side: F.struct(F.col(f"{side}_id").alias("track_id"), F.col(f"{side}_start").alias("start")).alias(side)
    return plan.where("reason is null").select("key", cut("rear"), cut("front"), "seconds", sync.alias("synchronization"), media.alias("media"))


def alignment(rear: DataFrame, front: DataFrame, tolerance: float, bound: float, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """The whole way from two event lists to their handoffs: best bias, its anchor, matches at the median, offsets of the media.

    rear, front: key, rear_id or front_id, t (the clock), media (the moment in the medium). Returns pairs (key, rear_id,
    front_id, offset, residual, physical) and, for each key of rear, bias, accepted, max_residual, min_physical,
    max_physical, anchor_rear, anchor_front. The anchor is the pair at the best bias nearest to it, the earlier of equals.
    Keys without matches have bias 0, zeros and no anchor.
    """
    best, tried = _searched(rear, front, tolerance, bound, key)
    best = settle(best)
    kept = tried.join(best.select(key, "bias"), [key, "bias"], "left_semi")
    off = F.round(F.abs(F.col("offset") - F.col("bias")), 6)
    kept = kept.join(rear.select(key, "rear_id", "t"), [key, "rear_id"])
    anchors = kept.groupBy(key).agg(F.min_by(F.struct("rear_id", "front_id"), F.struct(off, "t", "rear_id")).alias("a"))
    refined = settle(best.where("matches > 0").select(key, F.col("refined").alias("bias")))
    pairs = _matched(_both(rear.join(refined, key), front.join(refined, key), [key]), [key], tolerance)
    media = lambda side, name: side.select(key, f"{name}_id", F.col("media").alias(f"_{name}"))
    pairs = pairs.join(media(rear, "rear"), [key, "rear_id"]).join(media(front, "front"), [key, "front_id"]).join(refined, key)
    pairs = settle(pairs.select(key, "rear_id", "front_id", "offset", (F.col("offset") - F.col("bias")).alias("residual"), (F.col("_rear") - F.col("_front")).alias("physical")))
    ends = pairs.groupBy(key).agg(F.count("*").alias("accepted"), F.max(F.abs("residual")).alias("max_residual"), F.min("physical").alias("min_physical"), F.max("physical").alias("max_physical"))
    heads = rear.select(key).distinct().join(refined, key, "left").join(ends, key, "left").join(anchors, key, "left")
    heads = heads.na.fill({"bias": 0.0, "accepted": 0, "max_residual": 0.0, "min_physical": 0.0, "max_physical": 0.0})
    return pairs, heads.select(key, "bias", "accepted", "max_residual", "min_physical", "max_physical", F.col("a.rear_id").alias("anchor_rear"), F.col("a.front_id").alias("anchor_front"))


def modal_offset(offsets: DataFrame, tolerance: float, key: str = "key", preferred: float = 0.0) -> DataFrame:
    """key, n, modal: the median of the largest cluster of values within tolerance of one of them.

    Of clusters of one size the one with the least spread about its median wins, then the one nearest to preferred,
    then the one of the smallest value. Sizes come from a window over sorted values, so only the largest
    clusters of a key are laid out in full.
    """
    # whole millionths, so that sums and differences are exact
    band = round(tolerance * 1e6)
    offsets = offsets.select(key, "offset", F.round(F.col("offset") * 1e6).cast("long").alias("u"))
    at = Window.partitionBy(key).orderBy("u")
    sized = offsets.withColumn("n", F.count("*").over(at.rangeBetween(-band, band)))
    most = sized.withColumn("_most", F.max("n").over(Window.partitionBy(key))).where("n = _most").select(key, F.col("u").alias("c")).distinct()
    bucket = lambda c: F.floor(F.col(c) / band)
    a = most.select(key, "c", F.explode(F.array(bucket("c") - 1, bucket("c"), bucket("c") + 1)).alias("b"))
    near = a.join(offsets.select(key, "offset", "u", bucket("u").alias("b")), [key, "b"]).where(F.abs(F.col("u") - F.col("c")) <= band)
    groups = near.groupBy(key, "c").agg(F.count("*").alias("n"), F.median("offset").alias("modal"))
    spread = near.join(groups.select(key, "c", "modal"), [key, "c"]).groupBy(key, "c").agg(F.round(F.sum(F.abs(F.col("offset") - F.col("modal"))), 6).alias("spread"))
    rank = F.struct(-F.col("n"), F.col("spread"), F.round(F.abs(F.col("modal") - preferred), 6), F.abs("c"), F.col("c"))
    return groups.join(spread, [key, "c"]).groupBy(key).agg(F.min_by(F.struct("n", "modal"), rank).alias("m")).select(key, "m.*")


def aligned(rear: DataFrame, front: DataFrame, bias: DataFrame, tolerance: float, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Matches (key, rear_id, front_id, offset, residual) and, for each key, bias, accepted, max_residual, min_offset, max_offset.

    Rows are matched at each key's first bias (key, bias), then once more at the median of what that found; residuals
    are against that median. Keys without matches have their first bias and zeros.
    """

    def matched(at: DataFrame) -> DataFrame:
        return _matched(_both(rear.join(at, key), front.join(at, key), [key]), [key], tolerance)

    first = settle(matched(bias))
    refined = settle(bias.join(first.groupBy(key).agg(F.median("offset").alias("m")), key, "left").select(key, F.coalesce("m", "bias").alias("bias")))
    pairs = settle(matched(refined).join(refined, key).withColumn("residual", F.col("offset") - F.col("bias")).drop("bias"))
    ends = pairs.groupBy(key).agg(F.count("*").alias("accepted"), F.max(F.abs("residual")).alias("max_residual"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset"))
    return pairs, refined.join(ends, key, "left").na.fill({"accepted": 0, "max_residual": 0.0, "min_offset": 0.0, "max_offset": 0.0})


def clip_plan(pairs: DataFrame, rear_length: float, front_length: float, before: float = 3.0, after: float = 4.0, least: float = 5.0) -> DataFrame:
    """Windows of a pair (rear_time, offset) in both media; too short ones carry a reason.

    The front window starts where the rear one does, shifted by the offset; if that is before the front
    medium, both move right.
    """
    start = F.greatest(F.lit(0.0), F.col("rear_time") - before)
    p = pairs.withColumn("rear_start", start).withColumn("front_start", F.col("rear_start") - F.col("offset"))
    lack = F.greatest(F.lit(0.0), -F.col("front_start"))
    p = p.withColumn("rear_start", F.col("rear_start") + lack).withColumn("front_start", F.greatest(F.lit(0.0), "front_start"))
    end = F.least(F.lit(rear_length), F.col("rear_time") + after)
    length = F.least(end - F.col("rear_start"), F.lit(front_length) - F.col("front_start"))
    return p.withColumn("seconds", length).withColumn("reason", F.when(F.col("seconds") < least, "too_short"))
