"""Writers: tables with a fixed column list, JSON lines, append-only ledgers, staged promotion.

Spark's committer makes a table visible as a whole, so none of these needs temporary names of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.rollup import validated
from wakeline.session import settle


def delimited(df: DataFrame, path: str, columns: list[str], sep: str = ",") -> None:
    """The named columns with a header; tab-separated fields are not quoted."""
    writer = df.select(*columns).write.mode("overwrite").option("header", True).option("sep", sep)
    (writer.option("quote", "") if sep == "\t" else writer).csv(path)


def json_lines(df: DataFrame, path: str) -> None:
    """A document a line, fields in the order of their names."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def append_attempts(df: DataFrame, path: str, lane: str = "lane") -> None:
    """Add rows to a ledger; each lane has files of its own, so writers need no lock."""
    df.write.mode("append").partitionBy(lane).parquet(path)


def promote(staged: DataFrame, path: str, rules: dict[str, Column], by: str = "date") -> DataFrame:
    """Replace those partitions of the table at path whose staged rows are all valid; the others stay as they were.

    by, n, n_invalid and promoted of each staged partition. Doing it again gives the same table.
    """
    judged = settle(validated(staged, rules))
    report = judged.groupBy(by).agg(F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("n_invalid"))
    report = settle(report.withColumn("promoted", F.col("n_invalid") == 0))
    bad = report.where("not promoted").select(F.col(by).alias("_by"))
    good = judged.join(bad, F.col(by).eqNullSafe(F.col("_by")), "left_anti").drop("errors", "valid")
    good.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return report
