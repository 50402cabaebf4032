"""A session with the settings that the operators expect."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(name: str = "vellum", master: str | None = None, shared: str | None = None, **more: str) -> SparkSession:
    """``shared``: a folder that the driver and all executors see; ``more``: further settings, double underscores for dots.

    Tables between steps lie in the shared folder, so a session on several machines needs one.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in more.items()}
    if shared:
        settings["spark.checkpoint.dir"] = shared
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not own and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        spark.stop()
        raise ValueError("name a shared folder: several machines don't see each other's own")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and everything runs on one machine, as in tests, a temporary folder takes its place.
    """
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = f"file://{tempfile.mkdtemp(prefix='vellum-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` to twice the session's shuffle partitions, for short rows that become many or long ones only after it.

    The number is named because Spark would merge partitions by the size of the short rows; what comes of them wouldn't fit a task's memory.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again: cuts the lineage and is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
