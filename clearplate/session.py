"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "clearplate", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder, which is then kept in that setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="clearplate-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path below the work folder that belongs to this application only."""
    folder = work_folder(spark).rstrip("/")
    return "/".join([folder, spark.sparkContext.applicationId, *parts])


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the work folder that no earlier call has returned."""
    return work_path(spark, f"{label}-{os.urandom(6).hex()}")


def dir_tag(path: str) -> str:
    return hashlib.sha1(path.encode()).hexdigest()[:12]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes made inside leave no shuffle files: each drops its own when it ends, not when the driver happens to collect garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def written(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """The frame as a table in the work folder: computed once, safe from lost executors, lineage cut.

    A file is held in memory until it has a hundred rows, and read by thousands; ``file_rows`` bounds that for long rows.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.parquet(path)
