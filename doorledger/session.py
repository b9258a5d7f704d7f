"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

_RUNTIME = {
    # naive ISO strings and timestamp_ntz columns are read as UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join also where an aggregate after it then needs a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a re-run of one day must replace that day only
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in _RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "doorledger", master: str | None = None,
                **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever the driver was started.

    Once per Spark application; not needed when the job is submitted with the package as a
    Python file or it is installed on the cluster.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="doorledger-")) / "doorledger"
    archive = shutil.make_archive(str(target), "zip", root.parent, root.name)
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a local
    session (tests, a laptop) that names none gets a temporary one, which is recorded.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="doorledger-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The rows written as a table in the shared checkpoint folder and read back.

    Several results can start from them without computing them again, readers fetch only the
    columns they need, and the loss of executors costs nothing.
    """
    path = scratch_dir(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
