"""Paths, names and keys of artefacts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(path: Column) -> Column:
    """The path with empty and "." parts gone and each ".." taken together with the part before it."""
    step = lambda done, part: (
        F.when((part == "") | (part == "."), done)
        .when((part == "..") & (F.size(done) > 0), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == "..", done)
        .otherwise(F.concat(done, F.array(part)))
    )
    return F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/"))


def host_path(path: Column, root: str, mount: str = "/output", strict: bool = False) -> Column:
    """A path under the mount as it is called under root; other paths stay or, if strict, are null."""
    inside = (path == mount) | path.startswith(mount + "/")
    return F.when(inside, F.concat(F.lit(root), F.substring(path, len(mount) + 1, 1 << 20))).otherwise(F.lit(None) if strict else path)


def within(path: Column, root: str) -> Column:
    """Whether the absolute path, normalized, is root or lies below it; a relative path never is."""
    p, root = normalized(path), "/" + root.strip("/")
    below = F.lit(True) if root == "/" else (p == root) | p.startswith(root + "/")
    return path.startswith("/") & below


def event_key(track_id: Column, peak: Column, prefix: str = "") -> Column:
    return F.concat_ws(":", *([F.lit(prefix)] if prefix else []), track_id.cast("long").cast("string"), F.round(peak * 1000).cast("long").cast("string"))


def clip_name(source: Column, peak: Column, track_id: Column, class_name: Column) -> Column:
    """<source>_t<seconds, ten places or more with three decimals>_track<five places or more>_<class>.mp4"""
    return F.format_string("%s_t%010.3f_track%05d_%s.mp4", source.cast("string"), F.round(peak * 1000) / 1000, track_id.cast("long"), class_name)


def detection_height(width: Column, height: Column, target: int) -> Column:
    """Height at the target width, rounded half to even and made even."""
    h = F.bround(height * F.lit(float(target)) / width, 0).cast("long")
    return h + h % 2


def paired_window(start: Column, end: Column, offset: Column, length: Column) -> tuple[Column, Column]:
    """A window of one medium in the time of the other, which is offset later: not before its start, nor after its end."""
    return F.greatest(F.lit(0.0), start + offset), F.least(length, end + offset)
