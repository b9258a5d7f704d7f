"""The access-log lake and the report folder: day-wise JSON in, Parquet summaries out."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date as Date
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doorledger.schemas import ACCESS_LOG, SUMMARY
from doorledger.session import settled

# JSON lines as written by the generator or landed as raw text
LOG_FILES = "*.{json,json.*,txt,txt.*}"


def day_paths(base: str, date: str) -> list[str]:
    """Both spellings of a day's folder: a bare day and a ``Day=`` partition."""
    d = Date.fromisoformat(date)
    month = f"{base.rstrip('/')}/Year={d.year:04d}/Month={d.month:02d}"
    return [f"{month}/{d.day:02d}", f"{month}/Day={d.day:02d}"]


def _missing(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


def read_access_logs(spark: SparkSession, base: str, date: str) -> DataFrame:
    """One day's JSON lines with a fixed schema, chosen by path and not by event time.

    A day without a folder gives an empty frame; other read errors are raised.
    """
    out: DataFrame | None = None
    for path in day_paths(base, date):
        try:
            part = spark.read.schema(ACCESS_LOG).json(path)
        except AnalysisException as exc:
            if not _missing(exc):
                raise
            continue
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], ACCESS_LOG)


def read_lake(spark: SparkSession, base: str) -> DataFrame:
    """All days, with ``Year``, ``Month`` and ``Day`` as text columns to prune by."""
    schema = T.StructType(ACCESS_LOG.fields + [T.StructField(c, T.StringType())
                                               for c in ("Year", "Month", "Day")])
    return spark.read.schema(schema).json(base)


def list_objects(spark: SparkSession, base: str, prefix: str = "",
                 glob: str | None = None) -> DataFrame:
    """Object path, size and modification time below a prefix; contents are not read.

    Spark's file source skips objects of no bytes, so those are not listed and never expire.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    path = f"{base.rstrip('/')}/{prefix.lstrip('/')}" if prefix else base
    try:
        found = reader.load(path)
    except AnalysisException as exc:
        if not _missing(exc):
            raise
        return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint")
    return found.select("path", "modificationTime", "length")


def day_has_data(spark: SparkSession, base: str, date: str, glob: str = LOG_FILES) -> bool:
    """Is there at least one log object for the day?"""
    return any(not list_objects(spark, p, glob=glob).isEmpty() for p in day_paths(base, date))


def write_daily_summary(summary: DataFrame, base: str) -> None:
    """Replace exactly the summary's own ``date=`` partition by one Parquet file; other days go to other tasks."""
    (summary.select(*SUMMARY.fieldNames()).repartition("date").write.partitionBy("date")
     .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(base))


def read_daily_summaries(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(SUMMARY).parquet(base)


def retention_candidates(objects: DataFrame, now: str, days: int = 90) -> DataFrame:
    """Objects last written more than ``days`` before ``now``."""
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return objects.where(F.col("modificationTime") < limit)


def apply_retention(candidates: DataFrame, dry_run: bool = True, threads: int = 16) -> dict[str, int]:
    """Count, and only when ``dry_run`` is False delete, the candidates.

    Paths are streamed one partition at a time, never gathered on the driver, and deleted by a bounded number of threads.
    An object that cannot be deleted does not stop the others; ``expire_objects`` tells which those are.
    """
    if dry_run:
        row = candidates.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        return {"objects": row[0], "bytes": row[1], "deleted": 0}
    delete = _deleter(candidates.sparkSession)
    objects = size = deleted = 0
    with ThreadPoolExecutor(threads) as pool:
        rows = candidates.select("path", "length").toLocalIterator()
        while chunk := list(islice(rows, 64 * threads)):
            objects, size = objects + len(chunk), size + sum(r["length"] for r in chunk)
            deleted += sum(pool.map(delete, (r["path"] for r in chunk)))
    return {"objects": objects, "bytes": size, "deleted": deleted}


def _deleter(spark: SparkSession) -> Callable[[str], bool]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def delete(path: str) -> bool:
        target = hadoop.Path(path)
        try:
            return bool(target.getFileSystem(conf).delete(target, False))
        except Py4JJavaError:
            return False

    return delete


def expire_objects(spark: SparkSession, base: str, now: str, days: int = 90, threads: int = 16) -> DataFrame:
    """Delete the objects below ``base`` that are too old: a row for each, with whether it is gone.

    The candidates are written before the first is deleted; what is left is seen by listing again.
    """
    old = settled(retention_candidates(list_objects(spark, base), now, days))
    apply_retention(old, dry_run=False, threads=threads)
    left = list_objects(spark, base).select("path", "modificationTime", F.lit(True).alias("left"))
    return settled(old.join(left, ["path", "modificationTime"], "left")
                   .select("path", "length", "modificationTime", F.col("left").isNull().alias("deleted")))


def dataset_manifest(spark: SparkSession, base: str, logs: DataFrame) -> DataFrame:
    """Written records, files, bytes, users and time range of a generated or ingested lake."""
    files = list_objects(spark, base, glob=LOG_FILES).agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    return logs.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(F.when(F.col("user_id") != "anonymous", F.col("user_id")))
        .alias("num_users"),
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"),
    ).withColumns({"total_files": F.lit(files[0]), "total_bytes": F.lit(files[1]),
                   "generated_at": F.current_timestamp()})
