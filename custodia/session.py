"""Session builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "custodia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    AQE splits skewed join partitions and re-plans joins from run-time sizes;
    dynamic partition overwrite makes a monthly re-run replace only its month.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="custodia-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


def work_dir(spark: SparkSession, label: str = "work") -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ts(text: str) -> Column:
    """A zone-less timestamp literal: results never depend on the session zone."""
    return F.lit(text).cast("timestamp_ntz")


def clock(as_of: str | Column) -> Column:
    """Accept ``as_of`` as text or as a column."""
    return as_of if isinstance(as_of, Column) else ts(as_of)
