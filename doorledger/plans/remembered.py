"""Jobs that remember what they have done: materialization by its own last run, summaries by changed days.

What a run did is one small write that comes last. A run that dies before leaves the state of the
run before it; what it wrote so far is read by nobody.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doorledger.operators.features import TTL_DAYS, materialize_incremental
from doorledger.schemas import ACCESS_LOG
from doorledger.sources import lake

_RUNS = "run long, start timestamp, `end` timestamp, path string"
_LEDGER = "path string, length bigint, modificationTime timestamp, refresh string"
_USERS = "date string, user_id string, events bigint, predictions bigint, refresh string"


def _committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass
class Run:
    number: int
    end: str
    path: str


def last_run(spark: SparkSession, base: str) -> Run | None:
    """The newest committed run of a materialization kept below ``base``."""
    row = (_committed(spark, f"{base}/runs", _RUNS)
           .agg(F.max(F.struct("run", F.col("end").cast("string").alias("end"), "path")).alias("r")).first())
    return None if row.r is None else Run(row.r.run, row.r.end, row.r.path)


def materialize_run(offline: DataFrame, base: str, now: str, ttl_days: float = TTL_DAYS, key: str = "employee_id",
                    written: Callable[[], None] | None = None) -> DataFrame:
    """Load what is new since the last committed run and return the online table.

    The new table is written next to the old one; then the run (interval and path) is committed. A run that ends at or
    before the last one's end changes nothing. ``written`` is called between the two writes.
    """
    spark = offline.sparkSession
    last = last_run(spark, base)
    online = None if last is None else spark.read.schema(offline.schema).parquet(last.path)
    if last is not None and spark.range(1).select(F.lit(now).cast("timestamp") <= F.lit(last.end).cast("timestamp")).first()[0]:
        return online
    path = f"{base}/online/{uuid.uuid4().hex}"
    materialize_incremental(offline, online, None if last is None else last.end, now, ttl_days, key).write.parquet(path)
    if written is not None:
        written()
    row = spark.range(1).select(
        F.lit(1 if last is None else last.number + 1).cast("long").alias("run"),
        F.lit(None if last is None else last.end).cast("timestamp").alias("start"),
        F.lit(now).cast("timestamp").alias("end"), F.lit(path).alias("path"))
    row.coalesce(1).write.mode("append").parquet(f"{base}/runs")
    return spark.read.schema(offline.schema).parquet(path)


@dataclass
class Refreshed:
    files: int           # read in this refresh
    days: list[str]      # whose summaries were written anew


def refresh_summaries(spark: SparkSession, lake_base: str, state_base: str, report_base: str,
                      written: Callable[[], None] | None = None) -> Refreshed:
    """Bring the daily reports up to date by reading only files that no earlier refresh has read.

    A ledger holds every file seen (path, length, time). Of new files, counts per day and user are added to a table of such
    counts, which can be summed over refreshes; the summaries of days with new files are made from it and
    replace their partitions. The ledger is written last. As for any read, the driver holds the names of the new files.
    """
    found = lake.list_objects(spark, lake_base, glob=lake.LOG_FILES)
    seen = _committed(spark, f"{state_base}/ledger", _LEDGER)
    new = found.join(seen, ["path", "length", "modificationTime"], "left_anti").persist()
    try:
        paths = [r.path for r in new.select("path").toLocalIterator()]
        if not paths:
            return Refreshed(0, [])
        refresh = uuid.uuid4().hex
        name = F.col("_metadata.file_path")
        day = F.concat_ws("-", *[F.regexp_extract(name, r"Year=(\d+)/Month=(\d+)/(?:Day=)?(\d+)/", i) for i in (1, 2, 3)])
        logs = spark.read.schema(ACCESS_LOG).json(paths).select(day.alias("date"), "user_id", "action")
        (logs.groupBy("date", "user_id").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("action") == "prediction").alias("predictions"))
         .withColumn("refresh", F.lit(refresh)).write.mode("append").parquet(f"{state_base}/users"))
        users = _committed(spark, f"{state_base}/users", _USERS)
        known = seen.select("refresh").distinct().unionByName(spark.range(1).select(F.lit(refresh).alias("refresh")))
        changed = users.where(F.col("refresh") == refresh).select("date").distinct()
        per_user = (users.join(known, "refresh", "left_semi").join(changed, "date", "left_semi")
                    .groupBy("date", "user_id").agg(F.sum("events").alias("e"), F.sum("predictions").alias("p")))
        days = (per_user.groupBy("date").agg(F.sum("e").alias("total_events"), F.sum("p").alias("total_predictions"),
                                             F.count(F.lit(1)).alias("unique_users"))
                .withColumn("processed_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
        lake.write_daily_summary(days, report_base)
        if written is not None:
            written()
        new.withColumn("refresh", F.lit(refresh)).write.mode("append").parquet(f"{state_base}/ledger")
        return Refreshed(len(paths), sorted(r.date for r in changed.collect()))  # days, not rows
    finally:
        new.unpersist()
