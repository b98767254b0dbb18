"""Readers of the files around a batch: manifests, run documents, ledgers, telemetry, recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "doc_id long, camera string, media_seconds long, status string, wall_seconds long, events long"

_PROBE = "streams array<struct<codec_type:string,width:int,height:int,avg_frame_rate:string>>, format struct<duration:string,size:string>"


def manifest(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """A tab-separated table with a header; no field is quoted."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, quote="")


def run_documents(spark: SparkSession, path: str, schema: str, camera: str | None = None) -> DataFrame:
    """One JSON document a file, with its path; a document of another camera ends the read with an error."""
    docs = spark.read.schema(schema).json(path, multiLine=True).withColumn("path", F.col("_metadata.file_path"))
    if camera is None:
        return docs
    right = F.coalesce(F.col("camera") == camera, F.lit(False))
    message = F.concat(F.lit("not a document of this camera: "), F.col("path"))
    # a filter, as a guarded column that nobody reads would be pruned together with its guard
    return docs.where(F.when(right, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A document a line; blank lines give no row."""
    return spark.read.schema(schema).json(path)


def telemetry(spark: SparkSession, path: str, schema: str, time_col: str, start, end) -> DataFrame:
    """Samples from start to end, both included."""
    return spark.read.csv(path, header=True, schema=schema).where(F.col(time_col).between(F.lit(start), F.lit(end)))


def recordings(spark: SparkSession, root: str, suffix: str = ".mp4") -> DataFrame:
    """path, date (the folder), stem and size_bytes of the files with a suffix at any depth; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(root)
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    stem = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    return files.select("path", F.try_element_at(parts, F.lit(-2)).alias("date"), stem.alias("stem"), F.col("length").alias("size_bytes"))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """path and n_lines (lines that are not empty) of each text file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    return lines.groupBy("path").agg(F.count_if(F.length("value") > 0).alias("n_lines"))


def rational(text: Column) -> Column:
    """A rate written as num/den, or as one number; null if it is neither or den is zero."""
    part = F.split(text, "/")
    below = F.when(F.size(part) == 1, 1.0).when(F.size(part) == 2, F.get(part, 1).try_cast("double"))
    return F.try_divide(F.get(part, 0).try_cast("double"), below)


def media_facts(probe: Column) -> Column:
    """width, height, rate, duration and size of a recording from its probe's JSON: the first video stream counts."""
    doc = F.from_json(probe, _PROBE)
    video = F.get(F.filter(doc["streams"], lambda s: s["codec_type"] == "video"), 0)
    return F.struct(
        video["width"].alias("width"), video["height"].alias("height"), rational(video["avg_frame_rate"]).alias("rate"),
        doc["format"]["duration"].try_cast("double").alias("duration"), doc["format"]["size"].try_cast("long").alias("size"),
    )


def events_of(documents: DataFrame, keys: list[str], events: str = "events") -> DataFrame:
    """A row for each event in the documents; documents without events give none."""
    return documents.select(*keys, F.explode(events).alias("_event")).select(*keys, "_event.*")


def csv_counts(spark: SparkSession, path: str) -> DataFrame:
    """path and n_rows (without the header) of each CSV file that has rows."""
    rows = spark.read.csv(path, header=True).select(F.col("_metadata.file_path").alias("path"))
    return rows.groupBy("path").agg(F.count("*").alias("n_rows"))


def compared(rows: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """key, n_rows, n_lines (0 where there are none) and whether they are the same."""
    both = rows.groupBy(key).agg(F.sum("n_rows").alias("n_rows")).join(lines.groupBy(key).agg(F.sum("n_lines").alias("n_lines")), key, "full")
    return both.na.fill({"n_rows": 0, "n_lines": 0}).withColumn("same", F.col("n_rows") == F.col("n_lines"))
