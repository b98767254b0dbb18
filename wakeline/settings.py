"""Settings of a batch: defaults, which the environment and then the session's configuration override, checked once."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

_BATCH_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


@dataclass(frozen=True)
class Settings:
    """Counts of expected files of 0 hold for any number."""

    batch_name: str = "batch-1"
    source_mount: str = "/mnt/source"
    front_dir: str = "front"
    rear_dir: str = "rear"
    output_root: str = "/srv/out"
    expected_front_files: int = 0
    expected_rear_files: int = 0
    minimum_free_gib: int = 100
    heartbeat_timeout_seconds: int = 300
    max_source_failures: int = 3
    max_composition_failures: int = 3
    composition_workers: int = 3
    review_workers: int = 3

    def __post_init__(self) -> None:
        if not _BATCH_NAME.fullmatch(self.batch_name):
            raise ValueError(f"not a batch name: {self.batch_name!r}")
        for name, low, high in (("composition_workers", 1, 16), ("review_workers", 1, 8)):
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} must be between {low} and {high}")
        for f in fields(self):
            least = 1 if f.name.startswith(("max_", "heartbeat_")) else 0
            if isinstance(f.default, int) and getattr(self, f.name) < least:
                raise ValueError(f"{f.name} must be {least} or more")


def load(spark: SparkSession | None = None, environment: Mapping[str, str] | None = None) -> Settings:
    """Settings from `spark.wakeline.<name>` of the session, else WAKELINE_<NAME> of the environment, else the default. Empty values are unset."""
    environment = os.environ if environment is None else environment
    found = {}
    for f in fields(Settings):
        text = (spark.conf.get(f"spark.wakeline.{f.name}", None) if spark else None) or environment.get(f"WAKELINE_{f.name.upper()}")
        if text:
            try:
                found[f.name] = type(f.default)(text)
            except ValueError:
                raise ValueError(f"{f.name} is not a number: {text!r}") from None
    return Settings(**found)
