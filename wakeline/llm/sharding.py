"""Sharding by a permutation-filled lookup table.

Each shard orders the slots of a prime-sized table by its own permutation (an offset and a skip from a
digest of its name). Shards take turns; in its turn a shard claims the first slot of its order that is
still free, until no slot is free. Every shard then holds the same number of slots, give or take one,
and few slots change owner when a shard comes or goes. A row's slot is a digest of its key modulo the
table size, so placement is one look-up in a broadcast table of fixed size: SLOTS rows whatever the data.

Defined results: a null key counts as the empty string. Rows with equal keys share a shard; for keys
that may hold a large part of the rows, pass more columns, whose values then spread them. No shards is
an error; no rows give no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))


def fill(shards: tuple[str, ...], slots: int = SLOTS) -> list[int]:
    """The owner of each slot, as an index into shards."""
    if not shards or len(shards) > slots:
        raise ValueError("between one shard and as many as there are slots are needed")
    digest = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    at = [digest(f"offset:{s}") % slots for s in shards]
    skip = [digest(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            owner[at[k]] = k
            free -= 1
            if not free:
                break
    return owner


def slot(*keys: str | Column, slots: int = SLOTS) -> Column:
    """The slot of a row: 60 bits of a digest of its keys, modulo the table size."""
    text = F.concat_ws("\x1f", *(F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots))


def lookup(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """slot, shard: the filled table as a DataFrame of fixed size."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",")
    names = F.array(*map(F.lit, shards))
    rows = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.get(names, F.col("owner").cast("int")).alias("shard"))


def place(df: DataFrame, *keys: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """df with columns slot and shard (columns of these names are replaced)."""
    df = df.drop("slot", "shard").withColumn("slot", slot(*keys, slots=slots))
    return df.join(F.broadcast(lookup(df.sparkSession, shards, slots)), "slot")


def write(df: DataFrame, path: str, *keys: str, shards: tuple[str, ...] = SHARDS, files: int = 4) -> None:
    """One folder for each shard; a digest of the whole row spreads a shard over several files."""
    placed = place(df, *keys, shards=shards)
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    placed.repartition("shard", part).write.mode("overwrite").partitionBy("shard").parquet(path)


def sql(table: str = "documents", key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    owners = ",".join(map(str, fill(shards, slots)))
    names = ", ".join(f"'{s}'" for s in shards)
    return f"""
WITH o AS (SELECT string_split('{owners}', ',') AS owners, [{names}] AS names),
l AS (SELECT unnest(range({slots})) AS slot, unnest(owners)::INT AS k, names FROM o),
d AS (SELECT {key}, ('0x' || md5(coalesce({key}::VARCHAR, ''))[1:15])::BIGINT % {slots} AS slot FROM {table})
SELECT d.{key}, d.slot, names[k + 1] AS shard FROM d JOIN l ON d.slot = l.slot"""
