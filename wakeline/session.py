"""Sessions, table readers and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "16g", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wakeline")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one made here, which only a local master can share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return _own_folder[0]


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    This cuts the lineage like checkpoint(), and survives the loss of executors. Unlike a
    checkpoint the table is compressed and columnar, so later reads take only the columns they use.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
