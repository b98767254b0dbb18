"""The gate of a batch: all clips are staged and judged in one pass, and nothing is promoted unless all is right.

Counts come from an Observation on the staged rows as they are written; dates are judged from the staged table's
narrow columns. A batch that fails stays staged, with its errors; promotion replaces whole dates.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.rollup import validated

FIRST_ERRORS = 10


class BatchRejected(RuntimeError):
    """The batch is not promoted; the message has its first errors."""


@dataclass(frozen=True)
class Verdict:
    """dates: by, clips, expected, errors, valid (judged by a date's own errors). valid: no error of any kind."""

    path: str
    by: str
    valid: bool
    n_dates: int
    n_clips: int
    errors: list[str]
    dates: DataFrame

    def summary(self) -> str:
        """One JSON document, as a program prints it at its end."""
        return json.dumps({"valid": self.valid, "dates": self.n_dates, "clips": self.n_clips, "errors": self.errors}, indent=2)


def check_inputs(documents: DataFrame, method: str, layouts: tuple[str, ...], expected_dates: int | None = None, expected_clips: int | None = None) -> DataFrame:
    """documents (date, valid, method, layout, clips: a count) as they are; a document that may not be worked on, or other totals, are errors.

    The error names the first document by date. Expected totals of None hold for any.
    """
    wrong = F.when(~F.coalesce(F.col("valid"), F.lit(False)), "input is not valid").when(~F.coalesce(F.col("method") == method, F.lit(False)), f"input method is not {method}")
    wrong = wrong.when(~F.coalesce(F.col("layout").isin(*layouts), F.lit(False)), "unsupported input layout")
    found = documents.agg(F.count("*").alias("dates"), F.coalesce(F.sum("clips"), F.lit(0)).alias("clips"), F.min_by(F.struct("date", wrong.alias("wrong")), F.when(wrong.isNotNull(), F.col("date").cast("string"))).alias("first")).first()
    if found["first"] is not None and found["first"]["wrong"] is not None:
        raise BatchRejected(f"{found['first']['wrong']}: {found['first']['date']}")
    for what, want in (("dates", expected_dates), ("clips", expected_clips)):
        if want is not None and found[what] != want:
            raise BatchRejected(f"expected {want} {what}, found {found[what]}")
    return documents


def stage(clips: DataFrame, planned: DataFrame, path: str, rules: dict[str, Column], by: str, name: str, expected_dates: int | None = None, expected_clips: int | None = None) -> Verdict:
    """Write clips with their failed rules under path, and judge them against planned (by, expected: the number of clips).

    Errors: totals that differ, dates with another number of clips than planned, clips of dates that are not planned,
    and each clip that fails a rule, in the order of date and name; the first FIRST_ERRORS are kept. A date is valid by
    its number of clips and its own clips' rules.
    """
    spark = clips.sparkSession
    seen = Observation()
    judged = validated(clips, rules).observe(seen, F.count("*").alias("clips"), F.count_if(~F.col("valid")).alias("broken"))
    judged.write.mode("overwrite").partitionBy(by).parquet(path)
    counts = seen.get
    staged = spark.read.schema(judged.schema).parquet(path)
    have = staged.groupBy(by).agg(F.count("*").alias("clips"), F.count_if(~F.col("valid")).alias("broken"))
    dates = planned.withColumn("_planned", F.lit(True)).join(have, by, "full").na.fill({"clips": 0, "broken": 0})
    unplanned = F.col("_planned").isNull()
    errors = F.array_compact(F.array(F.when(unplanned, F.lit("unplanned")), F.when(~unplanned & (F.col("clips") != F.col("expected")), F.lit("count")), F.when(F.col("broken") > 0, F.lit("broken"))))
    dates = dates.select(by, "clips", "expected", errors.alias("errors")).withColumn("valid", F.size("errors") == 0)
    totals = dates.agg(F.count("expected").alias("dates"), F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"), F.count_if(~F.col("valid")).alias("bad")).first()
    first = [f"expected {want} {what}, found {have}" for what, want, have in (("dates", expected_dates, totals["dates"]), ("clips", expected_clips if expected_clips is not None else totals["expected"], counts["clips"])) if want is not None and want != have]
    if totals["bad"] or counts["broken"]:
        shown = F.concat(F.col(by).cast("string"), F.lit(": "))
        of_dates = dates.where("not valid").select(by, F.lit("").alias("_name"), F.concat(shown, F.array_join("errors", ", ")).alias("_text"))
        of_clips = staged.where("not valid").select(by, F.col(name).cast("string").alias("_name"), F.concat(shown, F.col(name).cast("string"), F.lit(" "), F.array_join("errors", ", ")).alias("_text"))
        first += [r["_text"] for r in of_dates.unionByName(of_clips).orderBy(by, "_name").limit(FIRST_ERRORS).collect()]
    return Verdict(path, by, not first, totals["dates"], counts["clips"], first[:FIRST_ERRORS], dates)


def promote(verdict: Verdict, spark: SparkSession, final: str) -> DataFrame:
    """The final table after the staged dates took their places; a batch that is not valid is an error and changes nothing.

    Doing it again gives the same table. Dates that the batch doesn't have stay as they are.
    """
    if not verdict.valid:
        raise BatchRejected("stage validation failed: " + "; ".join(verdict.errors))
    staged = spark.read.parquet(verdict.path).drop("errors", "valid")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(verdict.by).parquet(final)
    return spark.read.schema(staged.schema).parquet(final)
