"""Session settings that the library needs, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("candlewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """Stored timestamps carry no zone and mean UTC, so the session has to read them so."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@lru_cache(maxsize=1)
def _local_folder() -> tempfile.TemporaryDirectory:
    """One folder for this process; it is removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="candlewright-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all of the cluster's machines reach: the session's ``spark.checkpoint.dir``.

    Only a session whose master is local, as in tests and benches, may leave it unset; it gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_folder().name


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it from there.

    Spark removes such files once nothing refers to them where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
