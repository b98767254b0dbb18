"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the expected number of copies of each of its documents. The whole
part is taken at once; the fractional part is rounded by pivotal sampling: two documents with
fractional parts meet, and words move from one to the other, at random and without bias, until one of
them is at zero or one copy. Words, not probabilities, move, so each meeting leaves the source's total
of words as it was, and what a source is given differs from its target by at most one document.

Meetings form a reduction tree: documents are dealt by a digest of their id into blocks of about
BLOCK, a fold over each block settles all but one document, and these residuals meet in the next level.

Targets: sources in order of code points, null last, weigh 1, 2, 3, repeating, and share the words of
all sources; a target stops at CAP times its source's size and the rest is shared again by weight. That is
target = min(CAP * size, level * weight) with one level for all sources, found from running sums over
the sources by size per weight.

Defined results: documents without words take none. Rows of equal id, source and text collapse to one item
with a multiplicity; the copies that it is given are shared out evenly among them. Other rows with equal ids
are documents of their own. One source, or one repeated row, may hold any part of the rows. No words at all give targets of zero; no rows give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.session import settle

CAP = 3
BLOCK = 200
WEIGHTS = (1, 2, 3)
SPACES = " \t\n\x0b\f\r"


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII space; null has none."""
    flat = F.btrim(F.translate(text, SPACES, " " * len(SPACES)))
    parts = F.size(F.split(flat, " +"))
    return F.when(F.coalesce(flat, F.lit("")) == "", 0).otherwise(parts).cast("long")


def _sums_before(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with the sums over all rows that come earlier in this order, which leaves no ties.

    Rows are dealt by ranges of the order; each range has its own window, and the ranges' totals (a row for each of
    the shuffle's partitions) carry over. So no task holds all rows.
    """
    dealt = settle(df.withColumns(sums).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    ranges = dealt.groupBy("_part").agg(*(F.sum(c).alias(c) for c in sums))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_0") for c in sums))
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumns({c: F.coalesce(F.sum(c).over(own), F.lit(0)) for c in sums}).join(ranges, "_part")
    return out.withColumns({c: F.col(c) + F.col(f"{c}_0") for c in sums}).drop("_part", *(f"{c}_0" for c in sums))


def targets(sizes: DataFrame, source_col: str = "source", cap: int = CAP) -> DataFrame:
    """_source, source_size, _docs and target from rows of (source_col, size). Only single totals come to the driver."""
    total = sizes.groupBy(F.col(source_col).alias("_source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("_docs"))
    by_name = F.col("_source").asc_nulls_last()
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), F.col("_place") % len(WEIGHTS)).cast("long")
    total = _sums_before(total, [by_name], {"_place": F.lit(1)}).withColumn("_weight", weight).drop("_place")
    # sources fill up in the order of size per weight; sizes and weights are whole numbers, so sums are exact
    ratio = F.col("source_size") / F.col("_weight")
    total = settle(_sums_before(total, [ratio.asc(), by_name], {"_full": F.col("source_size"), "_light": F.col("_weight")}))
    words, weights = total.agg(F.sum("source_size"), F.sum("_weight")).first()
    level = (F.lit(words) - cap * F.col("_full")) / (F.lit(weights) - F.col("_light"))
    # the first source that its cap does not hold sets the level for itself and all after it
    held = cap * F.col("source_size") <= level * F.col("_weight")
    first = total.where(~held).agg(F.min(F.struct(ratio.alias("r"), level.alias("x"))).alias("m")).first()["m"]
    target = F.least(cap * F.col("source_size").cast("double"), F.lit(first["x"] if first else math.inf) * F.col("_weight"))
    return total.select("_source", "source_size", "_docs", target.alias("target"))


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) from a digest of the keys: 52 bits."""
    text = F.concat_ws("\x1f", *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _settle_blocks(rows: DataFrame) -> DataFrame:
    """One level: _source, _block -> _done (settled documents) and _left (the one still open).

    rows: _source, _block, _id (struct that names a row), _size, _p (open part), _u (random number).
    """
    item = F.struct("_u", "_id", "_size", "_p")
    open_type = rows.select(F.struct("_u", "_id", "_size", "_p").alias("x")).schema["x"].dataType
    done_type = f"array<struct<_id:{rows.schema['_id'].dataType.simpleString()},_more:bigint>>"

    def meet(state: Column, b: Column) -> Column:
        a = state["open"]
        ma, mb = a["_p"] * a["_size"], b["_p"] * b["_size"]
        ra, rb = a["_size"] - ma, b["_size"] - mb
        up, down = F.least(ra, mb), F.least(ma, rb)  # words that may move to a, or from a
        to_a = b["_u"] * (up + down) < down

        def closed(x: Column, more: int) -> Column:
            return F.array(F.struct(x["_id"].alias("_id"), F.lit(more).cast("long").alias("_more")))

        def opened(x: Column, p: Column) -> Column:
            return F.struct(x["_u"].alias("_u"), x["_id"].alias("_id"), x["_size"].alias("_size"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)).alias("_p"))

        def then(done: Column, still: Column) -> Column:
            return F.struct(F.concat(state["done"], done).alias("done"), still.alias("open"))

        return (
            F.when(a.isNull(), F.struct(state["done"].alias("done"), b.alias("open")))
            .when(to_a & (ra <= mb), then(closed(a, 1), opened(b, (mb - ra) / b["_size"])))
            .when(to_a, then(closed(b, 0), opened(a, (ma + mb) / a["_size"])))
            .when(ma <= rb, then(closed(a, 0), opened(b, (mb + ma) / b["_size"])))
            .otherwise(then(closed(b, 1), opened(a, (ma - rb) / a["_size"])))
        )

    start = F.struct(F.array().cast(done_type).alias("done"), F.lit(None).cast(open_type).alias("open"))
    blocks = rows.groupBy("_source", "_block").agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return blocks.select("_source", "_block", F.aggregate("_items", start, meet).alias("_state")).select("_source", "_block", F.col("_state.done").alias("_done"), F.col("_state.open").alias("_open"))


def _numbered(df: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """row, _source, size and _id of each row of df. _id (id, digest of id, source and text, ordinal) names one row.

    Equal rows are told apart by an ordinal; which of them has which makes no difference, as they are equal.
    They may be any part of the table, so they are first dealt into parts: the ordinal is part and place in the part.
    """
    names = df.columns
    rows = df.select(F.struct(*names).alias("row")).withColumns({"_source": F.col(f"row.`{source_col}`"), "size": n_words(F.col(f"row.`{text_col}`"))})
    mark = F.xxhash64(F.col(f"row.`{id_col}`"), F.col("_source"), F.col(f"row.`{text_col}`"))
    return rows.select("row", "_source", "size", F.struct(F.col(f"row.`{id_col}`").alias("id"), mark.alias("t")).alias("_key"))


def plan(rows: DataFrame, cap: int = CAP, seed: int = 0) -> DataFrame:
    """_key, _source, size, source_size, target, n (equal rows) and total: the copies that they are given together.

    rows: _key (id, t), _source, size. Equal rows collapse to one item with a multiplicity: a whole number of
    them is taken at once, and only the fraction that is left, less than one copy, is rounded.
    """
    sizes = settle(rows.groupBy("_key", "_source", "size").agg(F.count("*").alias("n")))
    goal = settle(targets(sizes.select("_source", (F.col("size") * F.col("n")).alias("size"), "n"), "_source", cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.select(F.col("_source").alias("_s"), "source_size", "target", rate.alias("_rate"), F.greatest(F.lit(1), F.ceil(F.col("_docs") / BLOCK)).alias("_blocks"))
    items = sizes.join(goal, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    due = F.when(F.col("size") > 0, F.col("_rate") * F.col("n")).otherwise(0.0)
    items = items.withColumns({"_whole": F.floor(due), "_part": due - F.floor(due)})

    u = uniform(F.lit(seed), F.col("_id.id"), F.col("_id.t"))
    todo = items.where("_part > 0").select("_source", F.pmod(F.xxhash64("_key", F.lit(seed)), F.col("_blocks")).alias("_block"), F.col("_key").alias("_id"), F.col("size").cast("double").alias("_size"), F.col("_part").alias("_p")).withColumn("_u", u)
    levels = 1 + math.ceil(math.log(max(2, goal.agg(F.max("_blocks")).first()[0] or 2), BLOCK))
    done = None
    for k in range(levels):
        state = settle(_settle_blocks(todo))
        now = state.select("_source", F.explode("_done").alias("d")).select("_source", "d.*")
        done = now if done is None else done.unionByName(now)
        left = state.where("_open is not null").select("_source", F.floor(F.col("_block") / BLOCK).alias("_block"), "_open.*")
        todo = left.withColumn("_u", uniform(F.lit(seed + k + 1), F.col("_id.id"), F.col("_id.t")))
    last = todo.select("_source", "_id", (F.col("_u") < F.col("_p")).cast("long").alias("_more"))
    done = done.unionByName(last).select(F.col("_id").alias("_k"), F.col("_source").alias("_s"), "_more")
    out = items.join(done, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
    total = F.when(F.col("size") > 0, F.col("_whole") + F.coalesce(F.col("_more"), F.lit(0))).otherwise(0).cast("long")
    return settle(out.select("_key", "_source", "size", "source_size", "target", "n", total.alias("total")))


def _with_copies(rows: DataFrame, planned: DataFrame, seed: int) -> DataFrame:
    """rows with their source's figures and copies: what equal rows are given together is shared out evenly."""
    p = planned.select(F.col("_key").alias("_k"), F.col("_source").alias("_s"), "source_size", "target", "n", "total")
    joined = rows.join(p, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_source").eqNullSafe(F.col("_s"))).drop("_k", "_s")
    single = F.when(F.col("n") == 1, F.col("total"))
    alone = joined.where("n = 1").withColumn("copies", single)
    many = joined.where("n > 1")
    # places of equal rows: parts of rows numbered apart, each after the parts before it
    many = settle(many.withColumn("_part", F.spark_partition_id()))
    before = many.groupBy("_key", "_source", "_part").agg(F.count("*").alias("_c"))
    w = Window.partitionBy("_key", "_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select(F.col("_key").alias("_k"), F.col("_source").alias("_s"), F.col("_part").alias("_q"), F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_key", "_source", "_part").orderBy(F.lit(0)))
    many = many.withColumn("_place", place).join(before, F.col("_key").eqNullSafe(F.col("_k")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_q")))
    at = F.col("_before") + F.col("_place")
    # the i-th of n rows takes floor(i * total / n) - floor((i - 1) * total / n): at most one more than another
    share = lambda i: F.expr("cast(floor(cast({} as decimal(38,0)) * total div n) as long)".format(i))
    many = many.withColumn("_at", at.cast("long"))
    many = many.withColumn("copies", share("_at") - share("_at - 1"))
    return alone.unionByName(many.select(alone.columns))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cap: int = CAP, seed: int = 0) -> DataFrame:
    """id_col, size, source_size, target and copies of each row. Only ids, sources and sizes are shuffled."""
    rows = settle(_numbered(df.select(*dict.fromkeys([id_col, source_col, text_col])), id_col, source_col, text_col).drop("row"))
    out = _with_copies(rows, plan(rows, cap, seed), seed)
    return out.select(F.col("_key.id").alias(id_col), "size", "source_size", "target", "copies")


def _hashable(df: DataFrame) -> list[Column]:
    """The columns of row as what a digest takes; maps and variants as JSON."""
    of = lambda c: F.col(f"row.`{c}`")
    return [F.to_json(F.struct(of(c).alias("c"))) if "map<" in kind or "variant" in kind else of(c) for c, kind in df.dtypes]


def take(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cap: int = CAP, seed: int = 0) -> DataFrame:
    """The rows of df, each as many times as the mix takes it.

    Copies are shared out among equal rows without their texts. Rows that are equal in all columns then go as one, as
    often as they are taken together, so that each different row is shuffled once.
    """
    rows = _numbered(df, id_col, source_col, text_col)
    rows = rows.withColumns({"_t": F.col("_key.t"), "_kind": F.xxhash64(F.lit(seed), *_hashable(df))})
    light = settle(rows.drop("row"))
    given = _with_copies(light, plan(light.drop("_t", "_kind"), cap, seed).where("total > 0"), seed)
    given = given.groupBy("_t", "_kind").agg(F.sum("copies").alias("copies")).where("copies > 0")
    different = rows.groupBy("_t", "_kind").agg(F.first("row").alias("row"))
    out = different.join(given, ["_t", "_kind"])
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_i")).select("row.*")
