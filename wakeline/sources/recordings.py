"""Raw recordings as Spark data sources: video frames and mono sound, in segment files of fixed-size units.

A recording is a folder of its source's name with files `<first unit>.raw`; a unit is a frame (width x height x
channels bytes) or a 16-bit sample. Tasks read byte ranges of files, so that one long recording is read by many.
Limits on source and time reach the reader: files and ranges outside them are not opened. Paths may be of any
store that pyarrow's file systems open.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

FRAMES = "source string, frame long, ts double, data binary"
SAMPLES = "source string, block long, squares long, n long"
SEGMENT_UNITS = 1 << 20  # of sound; frames have their own limit


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _Range(InputPartition):
    source: str
    path: str
    offset: int  # bytes in the file
    first: int  # the first unit's number in the recording
    units: int


class _SegmentReader(DataSourceReader):
    """Lists segment files and cuts what the filters leave into ranges."""

    def __init__(self, options: dict, unit: int, per_task: int):
        self.path, self.unit, self.per_task = options["path"], unit, per_task
        self.sources: set[str] | None = None
        self.low, self.high = 0.0, float("inf")  # units, both included

    def unit_of(self, ts: float) -> float:
        """The unit's number at a time, not rounded."""
        raise NotImplementedError

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            match f:
                case EqualTo(("source",), v):
                    self.sources = {v} if self.sources is None else self.sources & {v}
                case In(("source",), v):
                    self.sources = set(v) if self.sources is None else self.sources & set(v)
                case EqualTo(("ts",), v):
                    self._within(v, v)
                case GreaterThan(("ts",), v) | GreaterThanOrEqual(("ts",), v):
                    self._within(v, None)
                case LessThan(("ts",), v) | LessThanOrEqual(("ts",), v):
                    self._within(None, v)
            yield f  # ranges are cut with a unit to spare; Spark keeps the filter

    def _within(self, low: float | None, high: float | None) -> None:
        if low is not None:
            self.low = max(self.low, np.floor(self.unit_of(low)) - 1)
        if high is not None:
            self.high = min(self.high, np.ceil(self.unit_of(high)) + 1)

    def partitions(self) -> list[_Range]:
        store, root = _opened(self.path)
        out = []
        for f in store.get_file_info(fs.FileSelector(root, recursive=True)):
            if not f.is_file or not f.path.endswith(".raw"):
                continue
            source, first = f.path.rsplit("/", 2)[1], int(f.base_name.removesuffix(".raw"))
            if self.sources is not None and source not in self.sources:
                continue
            if f.size % self.unit:
                raise ValueError(f"short unit at the end of {f.path}: {f.size % self.unit} of {self.unit} bytes")
            low, high = max(first, self.low), min(first + f.size // self.unit - 1, self.high)
            for k in range(int(low), int(high) + 1, self.per_task):
                out.append(_Range(source, f.path, (k - first) * self.unit, k, min(self.per_task, int(high) + 1 - k)))
        return sorted(out, key=lambda r: (r.source, r.first))

    def _bytes(self, part: _Range, units: int) -> Iterator[tuple[int, bytes]]:
        """The range, so many units at a time."""
        store, _ = _opened(self.path)
        with store.open_input_file(part.path) as f:
            for k in range(0, part.units, units):
                n = min(units, part.units - k) * self.unit
                data = f.read_at(n, part.offset + k * self.unit)
                if len(data) != n:
                    raise ValueError(f"short read of {part.path}: {len(data)} of {n} bytes")
                yield part.first + k, data


class FrameReader(_SegmentReader):
    def __init__(self, options: dict):
        self.rate = float(options["rate"])
        self.start = float(options.get("start", 0))
        super().__init__(options, int(options["width"]) * int(options["height"]) * int(options.get("channels", 3)), int(options.get("frames_per_task", 256)))

    def unit_of(self, ts: float) -> float:
        return (ts - self.start) * self.rate

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        for first, data in self._bytes(part, max(1, (16 << 20) // self.unit)):
            n = len(data) // self.unit
            frame = np.arange(first, first + n)
            cells = [data[k * self.unit : (k + 1) * self.unit] for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array([part.source] * n, pa.string()), pa.array(frame, pa.int64()), pa.array(self.start + frame / self.rate), pa.array(cells, pa.binary())], names=["source", "frame", "ts", "data"])


class SoundReader(_SegmentReader):
    """Sums of squares of blocks of samples; a block that lies in two ranges comes in two parts."""

    def __init__(self, options: dict):
        self.block = int(options.get("block", 50))
        super().__init__(options, 2, int(options.get("samples_per_task", 1 << 22)))

    def unit_of(self, ts: float) -> float:
        return ts

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        for first, data in self._bytes(part, 1 << 20):
            x = np.frombuffer(data, "<i2").astype(np.int64)
            block = np.arange(first, first + len(x)) // self.block
            at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            squares, n = np.add.reduceat(x * x, at), np.diff(np.append(at, len(x)))
            yield pa.RecordBatch.from_arrays([pa.array([part.source] * len(at), pa.string()), *(pa.array(v, pa.int64()) for v in (block[at], squares, n))], names=["source", "block", "squares", "n"])


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class SegmentWriter(DataSourceArrowWriter):
    """source, frame (the number of the first unit), data (whole units): runs of units that follow each other become files.

    Files appear under their names when all tasks have ended. Rows come by source and frame.
    """

    def __init__(self, options: dict):
        self.path, self.unit, self.most = options["path"], int(options["unit"]), int(options.get("segment_units", SEGMENT_UNITS))
        self.job = uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _opened(self.path)
        files: list[tuple[str, str]] = []
        out, source, first, held = None, None, 0, 0
        folder = f"{root}/.{self.job}"
        store.create_dir(folder)
        for b in batches:
            for name, frame, data in zip(*(b.column(b.schema.get_field_index(c)) for c in ("source", "frame", "data")), strict=True):
                name, frame, data = name.as_py(), frame.as_py(), data.as_py()
                if len(data) % self.unit:
                    raise ValueError(f"short unit of {name}: {len(data)} bytes, units have {self.unit}")
                if out is None or name != source or frame != first + held or held >= self.most:
                    if out is not None:
                        out.close()
                    source, first, held = name, frame, 0
                    files.append((f"{folder}/{uuid.uuid4().hex}", f"{root}/{name}/{frame:012d}.raw"))
                    out = store.open_output_stream(files[-1][0])
                out.write(data)
                held += len(data) // self.unit
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        store, root = _opened(self.path)
        for old, new in (pair for m in messages if m for pair in m.files):
            store.create_dir(new.rsplit("/", 1)[0])
            store.move(old, new)
        store.delete_dir(f"{root}/.{self.job}")

    def abort(self, messages: list[_Written | None]) -> None:
        store, root = _opened(self.path)
        store.delete_dir(f"{root}/.{self.job}")


class RawFrames(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_frames"

    def schema(self) -> str:
        return FRAMES

    def reader(self, schema) -> FrameReader:
        return FrameReader(self.options)


class RawSound(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_sound"

    def schema(self) -> str:
        return SAMPLES

    def reader(self, schema) -> SoundReader:
        return SoundReader(self.options)


class RawSegments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raw_segments"

    def schema(self) -> str:
        return "source string, frame long, data binary"

    def writer(self, schema, overwrite: bool) -> SegmentWriter:
        return SegmentWriter(self.options)


def _known(spark: SparkSession) -> SparkSession:
    """The session with the sources registered, and with filters passed to readers in Python, which it doesn't do unasked."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for s in (RawFrames, RawSound, RawSegments):
        spark.dataSource.register(s)
    return spark


def write_segments(df: DataFrame, path: str, unit: int, segment_units: int = SEGMENT_UNITS) -> None:
    """Write source, frame, data as raw files of at most so many units or one row; a recording is written by many tasks."""
    rows = df.select(F.col("source").cast("string").alias("source"), F.col("frame").cast("long").alias("frame"), "data")
    rows = rows.repartitionByRange("source", "frame").sortWithinPartitions("source", "frame")
    _known(df.sparkSession)
    rows.write.format("raw_segments").mode("append").option("path", path).option("unit", unit).option("segment_units", segment_units).save()


def frames(spark: SparkSession, path: str, width: int, height: int, rate: float, channels: int = 3, start: float = 0.0, frames_per_task: int = 256) -> DataFrame:
    """source, frame, ts (start + frame / rate), data of all frames under path."""
    r = _known(spark).read.format("raw_frames").option("path", path).option("width", width).option("height", height).option("channels", channels)
    return r.option("rate", rate).option("start", start).option("frames_per_task", frames_per_task).load()


def frames_at(all_frames: DataFrame, wanted: DataFrame, rate: float) -> DataFrame:
    """wanted (source, t, ...) with ts and data of the first frame that is not before t; times without a frame give no row."""
    at = F.ceil(F.round(F.col("t") * rate, 6)).cast("long")
    return wanted.withColumn("frame", at).join(all_frames, ["source", "frame"])


def lower_left(data: Column, width: int, height: int, channels: int = 3, across: float = 0.70, up: float = 0.12) -> Column:
    """The bytes of the lower left part of a frame, where a burned-in clock stands; at least one pixel."""
    w, h = max(1, int(width * across)), max(1, int(height * up))
    rows = [F.substring(data, (y * width) * channels + 1, w * channels) for y in range(height - h, height)]
    return F.concat(*rows)


def frame_files(spark: SparkSession, specifications: list[str], width: int, height: int, channels: int = 3) -> DataFrame:
    """ts, path, data of frames named as TIME:FILE (cut at the first colon); a file of another size is an error when read."""
    parts = [s.partition(":") for s in specifications]
    for s, (_, colon, _) in zip(specifications, parts, strict=True):
        if not colon:
            raise ValueError(f"not TIME:FILE: {s}")
    named = spark.createDataFrame([(float(t), p) for t, _, p in parts], "ts double, path string")
    files = spark.read.format("binaryFile").load(sorted({p for _, _, p in parts}))
    right = F.col("length") == width * height * channels
    text = F.concat(F.col("found"), F.lit(" has "), F.col("length").cast("string"), F.lit(f" bytes, expected {width * height * channels}"))
    files = files.select(F.col("path").alias("found"), "content", "length").where(F.when(right, F.lit(True)).otherwise(F.raise_error(text).cast("boolean")))
    plain = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    return named.join(files, plain(F.col("path")) == plain(F.col("found"))).select("ts", "path", F.col("content").alias("data"))


def sound_blocks(spark: SparkSession, path: str, block: int = 50, least_samples: int = 0, samples_per_task: int = 1 << 22) -> DataFrame:
    """key, idx, x: root mean square of each whole block of samples plus one under the root, as ln(1 + .).

    A recording of fewer samples in whole blocks is an error when the rows are read.
    """
    raw = _known(spark).read.format("raw_sound").option("path", path).option("block", block).option("samples_per_task", samples_per_task).load()
    whole = raw.groupBy("source", "block").agg(F.sum("squares").alias("squares"), F.sum("n").alias("n")).where(F.col("n") == block)
    if least_samples:
        have = whole.groupBy("source").agg(F.count("*").alias("blocks"))
        text = F.concat(F.lit("insufficient sound in "), F.col("source"))
        enough = F.when(F.col("blocks") * block >= least_samples, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
        whole = whole.join(have.where(enough).select("source"), "source")
    x = F.log1p(F.sqrt(F.col("squares") / block + 1))
    return whole.select(F.col("source").alias("key"), F.col("block").alias("idx"), x.alias("x"))
