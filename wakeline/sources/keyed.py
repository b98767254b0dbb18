"""A table with one row for each key, kept by merging batches: the last writer of a key wins.

Keys are dealt into buckets. A merge rewrites only the buckets that its batch touches, under the batch's number, and
then appends to a log which buckets it wrote; a reader takes each bucket as the last batch in the log left it. What
is not in the log is not seen, so a merge that breaks off changes nothing and can be given again; a batch whose
number is in the log is passed over. Earlier states can be read until their files are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOG = "batch long, bucket int"


@dataclass(frozen=True)
class KeyedTable:
    """keys name a row; of rows with one key that with the greatest order columns stays, of equal ones the one with greatest other values."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    buckets: int = 64

    def create(self, spark: SparkSession) -> KeyedTable:
        spark.createDataFrame([], _LOG).write.mode("error").parquet(f"{self.path}/log")
        return self

    def _latest(self, spark: SparkSession, as_of: int | None = None) -> dict[int, int]:
        """Bucket to the last batch that wrote it; a row for each bucket comes to the driver."""
        log = spark.read.schema(_LOG).parquet(f"{self.path}/log")
        log = log if as_of is None else log.where(F.col("batch") <= as_of)
        return {r["bucket"]: r["batch"] for r in log.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}

    def _rows(self, spark: SparkSession, at: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/rows/batch={b}/bucket={k}" for k, b in sorted(at.items())]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def read(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """The rows, now or as they were after a batch."""
        return self._rows(spark, self._latest(spark, as_of))

    def _last(self, rows: DataFrame) -> DataFrame:
        names = self.schema.names
        rank = [*self.order, *(c for c in names if c not in self.order and c not in self.keys)]
        best = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*names), F.struct(*rank)).alias("row"))
        return best.select(*(F.col("row")[c].alias(c) for c in names))

    def merge(self, rows: DataFrame, batch: int) -> bool:
        """Merge rows; False if the batch was merged before. As foreachBatch calls it, one merge runs at a time."""
        spark = rows.sparkSession
        if not spark.read.schema(_LOG).parquet(f"{self.path}/log").where(F.col("batch") == batch).isEmpty():
            return False
        bucket = F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")
        new = self._last(rows.select(*self.schema.names))
        touched = sorted(r[0] for r in new.select(bucket).distinct().collect())  # at most the number of buckets
        if not touched:
            return False
        latest = self._latest(spark)
        old = self._rows(spark, {k: latest[k] for k in touched if k in latest})
        merged = self._last(old.unionByName(new)).withColumn("bucket", bucket)
        # a key has one row, so buckets are even
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/batch={batch}")
        spark.createDataFrame([(batch, k) for k in touched], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return True


def updated(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """base with the columns of changes put in by key; rows without a change keep their own (null for new columns).

    A key that changes twice, or whose row is not in base, is an error when the rows are read.
    """
    new = [c for c in changes.columns if c not in keys]
    once = changes.groupBy(*keys).agg(F.count("*").alias("_n"), F.any_value(F.struct(*new)).alias("_new"))
    both = base.withColumn("_own", F.lit(True)).join(once, keys, "full")
    wrong = F.when(F.col("_own").isNull(), "a change of a row that is not there: ").when(F.col("_n") > 1, "a row changes more than once: ")
    text = F.concat(wrong, F.to_json(F.struct(*keys)))
    checked = both.where(F.when(wrong.isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    value = lambda c: F.when(F.col("_n").isNotNull(), F.col("_new")[c]).otherwise(F.col(c) if c in base.columns else F.lit(None))
    kept = [value(c).alias(c) if c in new else F.col(c) for c in base.columns]
    return checked.select(*kept, *(value(c).alias(c) for c in new if c not in base.columns))
