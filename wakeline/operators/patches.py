"""Nested documents patched from a report: every event finds its entry by file name, every entry its event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.ranges import numbered


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def place_in_batch(path: Column) -> Column:
    """camera, date, stem of a path .../camera/date/stem/file; the parts that are not there are null."""
    parts = F.split(path, "/")
    part = lambda k: F.try_element_at(parts, F.lit(-k))
    return F.struct(part(4).alias("camera"), part(3).alias("date"), part(2).alias("stem"))


def in_path_order(df: DataFrame, path: str = "path") -> DataFrame:
    """Rows in the order of their paths, with their place from 0; for lists of documents, which a batch has few of."""
    return numbered(df.withColumn("_all", F.lit(0)), ["_all"], [path], "place").drop("_all").orderBy("place")


def patched(documents: DataFrame, report: DataFrame, key: str, value: str, heads: dict[str, Column] | None = None, events: str = "events", clip: str = "clip") -> DataFrame:
    """documents (key, events: an array of structs with clip and value, ...) with each event's value from the report.

    report: key, filename, value. Events keep their order and other fields. In every document each event's file name
    must be in the report once, each entry of the report must be an event's, and no two events may share a name; a
    document that the report doesn't know, or the other way round, is the same kind of error when the rows are read.
    heads are columns of the document to set.
    """
    entry = F.struct(F.col("filename"), F.col(value).alias("value"))
    known = report.groupBy(F.col(key).alias("_key")).agg(F.collect_list(entry).alias("_report"), F.count_distinct("filename").alias("_names"), F.count("*").alias("_n"))
    both = documents.withColumn("_own", F.lit(True)).join(known, F.col(key).eqNullSafe(F.col("_key")), "full")
    names = F.transform(F.coalesce(events, F.array()), lambda e: file_name(e[clip]))
    listed = F.transform(F.coalesce("_report", F.array()), lambda r: r["filename"])
    shown = lambda text, what: F.concat(F.lit(text), F.coalesce(F.get(what, 0), F.lit("null")))
    lacking, idle = F.array_except(names, listed), F.array_except(listed, names)
    wrong = (
        F.when(F.col("_own").isNull(), F.lit("a report without a document"))
        .when(F.size(lacking) > 0, shown("no entry for ", lacking))
        .when(F.size(idle) > 0, shown("no event for ", idle))
        .when(F.coalesce(F.col("_names") < F.col("_n"), F.lit(False)) | (F.size(F.array_distinct(names)) < F.size(names)), F.lit("a name is there twice"))
    )
    text = F.concat(wrong, F.lit(" in "), F.coalesce(F.coalesce(F.col(key), F.col("_key")).cast("string"), F.lit("null")))
    checked = both.where(F.when(wrong.isNull(), F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    lookup = F.map_from_arrays(listed, F.transform(F.coalesce("_report", F.array()), lambda r: r["value"]))
    checked = checked.withColumn("_lookup", lookup)
    new = F.transform(events, lambda e: e.withField(value, F.element_at("_lookup", file_name(e[clip]))))
    return checked.withColumns({events: new, **(heads or {})}).select(*documents.columns, *(c for c in (heads or {}) if c not in documents.columns))


def without_matches(df: DataFrame, column: str, field: str = "matches") -> DataFrame:
    """df with a struct column that lacks one field."""
    return df.withColumn(column, F.col(column).dropFields(field))


#: What a benchmark keeps of its run (fixed values).
RUN_FIELDS = ("source", "camera", "weights", "device", "sample_fps", "processed_source_seconds", "wall_seconds", "candidate_events")


def benchmark_document(runs: DataFrame, keys: list[str]) -> DataFrame:
    """keys and run, the part of each run document that its benchmark keeps; fields that a run lacks are null."""
    part = lambda c: (F.col(c) if c in runs.columns else F.lit(None).cast("string")).alias(c)
    return runs.select(*keys, F.struct(*(part(c) for c in RUN_FIELDS)).alias("run"))
