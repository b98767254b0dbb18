"""Order-dependent columns of long keys: rows lie in ranges of (key, order), ranges carry what came before them.

A window over a whole key sorts the key in one task. Here a window holds a key's rows of one range, and what
crosses ranges is one row for each range that a key touches.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.operators.groups import whole_groups
from wakeline.session import settle


def _same(a: DataFrame, b: DataFrame, names: list[str]):
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return out


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """df with the place of each row among those of its key in the order, from 0; order must tell rows apart."""
    rows = settle(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    sizes = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = Window.partitionBy(*(F.col(f"a.{c}") for c in [*keys, "_part"])).orderBy(*(F.col(f"a.{c}") for c in order))
    both = rows.alias("a").join(sizes.alias("b"), _same(rows, sizes, [*keys, "_part"]))
    return both.select(*(F.col(f"a.{c}") for c in df.columns), (F.col("b._before") + F.row_number().over(own) - 1).alias(name))


def after_first(df: DataFrame, keys: list[str], order: list[str], skip: int) -> DataFrame:
    """df without the first rows of each key in the order, which must tell rows apart.

    The last row to skip of each key comes from a limited window, of which tasks hold `skip` rows a key before any shuffle.
    """
    if skip < 1:
        return df
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    last = df.select(*keys, *order).withColumn("_place", place).where(F.col("_place") <= skip)
    last = last.groupBy(*keys).agg(F.max("_place").alias("_n"), F.max(F.struct(*order)).alias("_last")).where(F.col("_n") == skip)
    both = df.alias("a").join(last.alias("b"), _same(df, last, keys))
    return both.where(F.struct(*(F.col(f"a.{c}") for c in order)) > F.col("b._last")).select(*(F.col(f"a.{c}") for c in df.columns))


def neighbours(df: DataFrame, before: int, after: int, block: int, idx: str = "idx") -> DataFrame:
    """df with _block: each row in the block of its index, and also in others whose rows look back or ahead to it."""
    first, last = F.floor((F.col(idx) - after) / block), F.floor((F.col(idx) + before) / block)
    return df.withColumn("_block", F.explode(F.sequence(first, last)))


def fold(df: DataFrame, keys: list[str], order: list[str], symbol: str, steps: list[list[int]], first: int = 0, name: str = "state") -> DataFrame:
    """df with the state before each row of a machine that each key runs in the order, which must tell rows apart.

    steps[symbol][state] is the next state; symbols and states count from 0. A range's rows make one map from state
    to state, so a key that spans ranges is run in all of them at once: only the maps are followed one by one.
    """
    rows = settle(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    own, columns = [*keys, "_part"], df.columns
    touched = rows.select(*own).distinct()
    spread = touched.withColumn("_parts", F.count("*").over(Window.partitionBy(*keys))).where("_parts > 1").drop("_parts")

    def maps(batches):
        for g, at in whole_groups(batches, own):
            symbols, made = g[symbol].tolist(), []
            for i, j in zip(at[:-1], at[1:], strict=True):
                state = list(range(len(steps[0])))
                for s in symbols[i:j]:
                    state = [steps[s][x] for x in state]
                made.append(state)
            yield g.iloc[at[:-1]][own].assign(_map=made)

    def before(batches):
        for g, at in whole_groups(batches, own):
            symbols, enters, states = g[symbol].tolist(), g["_entry"].tolist(), []
            for i, j in zip(at[:-1], at[1:], strict=True):
                state = first if pd.isna(enters[i]) else int(enters[i])
                for s in symbols[i:j]:
                    states.append(state)
                    state = steps[s][state]
            yield g[columns].assign(**{name: states})

    def entries(g):
        g, state, out = g.sort_values("_part"), first, []
        for m in g["_map"]:
            out.append(state)
            state = m[state]
        return g[own].assign(_entry=out)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in own)
    sort = lambda x: x.repartition(*own).sortWithinPartitions(*own, *order)
    long = rows.alias("a").join(spread.alias("b"), _same(rows, spread, own), "left_semi").select(*own, *(c for c in order if c not in own), symbol)
    entry = sort(long).mapInPandas(maps, f"{kinds}, _map array<int>").groupBy(*keys).applyInPandas(entries, f"{kinds}, _entry int")
    both = rows.alias("a").join(entry.alias("b"), _same(rows, entry, own), "left").select(*(F.col(f"a.{c}") for c in rows.columns), "b._entry")
    schema = df.withColumn(name, F.lit(0)).schema
    return sort(both).mapInPandas(before, schema)


def gap_groups(df: DataFrame, keys: list[str], order: list[str], at: str, gap: float, name: str, shift: float = 0.0, spread: bool = True) -> DataFrame:
    """df with the number (from 0) of each row's group: a new one starts where at - shift is more than gap after the row before.

    order must tell a key's rows apart, and at must not fall in it. With spread a key's rows lie in ranges, of which the
    last row and the number of starts are carried on; without, a window sorts each key in one task and nothing is written.
    """

    def starts(w, before=None):
        was = F.lag(at).over(w) if before is None else F.coalesce(F.lag(at).over(w), before)
        return F.coalesce((F.col(at) - shift - was > gap).cast("int"), F.lit(0))

    if not spread:
        w = Window.partitionBy(*keys).orderBy(*order)
        rows = df.withColumn("_new", starts(w))
        return rows.withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")).drop("_new")
    own = [*keys, "_part"]
    rows = settle(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    parts = Window.partitionBy(*keys).orderBy("_part")
    last = rows.groupBy(*own).agg(F.max(at).alias("_last"))
    last = last.withColumn("_before", F.lag("_last").over(parts)).drop("_last")
    rows = rows.alias("a").join(last.alias("b"), _same(rows, last, own)).select(*(F.col(f"a.{c}") for c in rows.columns), "b._before")
    w = Window.partitionBy(*own).orderBy(*order)
    rows = settle(rows.withColumn("_new", starts(w, F.col("_before"))).withColumn("_so_far", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_before"))
    count = rows.groupBy(*own).agg(F.sum("_new").alias("_n"))
    count = count.withColumn("_base", F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    both = rows.alias("a").join(count.alias("b"), _same(rows, count, own))
    return both.select(*(F.col(f"a.{c}") for c in df.columns), (F.col("a._so_far") + F.col("b._base")).cast("long").alias(name))
