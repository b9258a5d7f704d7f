"""Synthetic users and access logs.

Every value is derived from (row id, seed) by hashing, so the data does not depend on how it
is partitioned and a lost task makes the same rows again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from doorledger.functions.events import ANONYMOUS, stable_uuid

# fixed values of the generated data
DEPARTMENTS = ("Engineering", "Sales", "Marketing", "HR", "Finance")
LOCATIONS = ("Office A", "Office B", "Office C", "Remote")
STATUSES = ("success", "success", "success", "no_match")
CHECK_INS = ("face", "card", "manual")
FIRST_DAY, LAST_DAY = "2020-01-01", "2025-12-31"


class _Draws:
    """Independent uniform numbers for a row: 32-bit slices of salted MD5 digests."""

    def __init__(self, row: Column, seed: int):
        self._row, self._seed, self._n = row, seed, 0

    def uniform(self) -> Column:
        page, slot = divmod(self._n, 4)
        self._n += 1
        digest = F.md5(F.concat_ws("|", self._row.cast("string"), F.lit(str(self._seed)),
                                   F.lit(str(page))))
        part = F.conv(F.substring(digest, 1 + 8 * slot, 8), 16, 10).cast("bigint")
        return part / F.lit(4294967296.0)

    def integer(self, n: int | Column) -> Column:
        """0 .. n-1"""
        return F.floor(self.uniform() * n).cast("bigint")

    def choice(self, values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), self.integer(len(values)).cast("int"))


def user_uuid(index: Column, seed: int) -> Column:
    return stable_uuid(F.lit("pool"), F.lit(seed), index)


def users_from_ids(ids: DataFrame, id_col: str, seed: int = 0) -> DataFrame:
    d = _Draws(F.concat(F.lit("user"), F.col(id_col).cast("string")), seed)
    name = F.concat(F.lit("user_"), F.col(id_col).cast("string"))
    return ids.select(
        user_uuid(F.col(id_col), seed).alias("user_id"), name.alias("username"),
        F.concat(name, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("User "), F.col(id_col).cast("string")).alias("full_name"),
        d.choice(DEPARTMENTS).alias("department"), d.choice(LOCATIONS).alias("location"))


def generate_users(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    return users_from_ids(spark.range(n), "id", seed)


def logs_from_ids(ids: DataFrame, id_col: str, users: int, seed: int = 0,
                  first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    """One check-in record per id, by users 0 .. users-1 of the pool with the same seed."""
    d = _Draws(F.col(id_col), seed)
    start = F.unix_seconds(F.lit(first_day).cast("timestamp"))
    span = F.unix_seconds(F.lit(last_day).cast("timestamp")) - start
    cols = {"_status": d.choice(STATUSES), "_user": d.integer(users),
            "_conf": d.uniform(), "_at": start + d.integer(span + 1),
            "_ms": d.uniform() * 450 + 50, "_dev": d.integer(50) + 1,
            "_kind": d.choice(CHECK_INS), "_ip1": d.integer(65536), "_ip2": d.integer(65536)}
    drawn = ids.select(F.col(id_col), *[c.alias(k) for k, c in cols.items()])
    ok = F.col("_status") == "success"
    user = user_uuid(F.col("_user"), seed)
    half = [F.concat_ws(".", F.floor(F.col(c) / 256).cast("string"),
                        F.pmod(F.col(c), F.lit(256)).cast("string")) for c in ("_ip1", "_ip2")]
    return drawn.select(
        F.col(id_col), F.when(ok, user).otherwise(ANONYMOUS).alias("user_id"),
        F.lit("prediction").alias("action"),
        F.struct(stable_uuid(F.lit("prediction"), F.lit(seed), id_col).alias("prediction_id"),
                 F.when(ok, user).alias("matched_user"),
                 F.when(ok, F.col("_conf") * 0.4 + 0.6).otherwise(F.col("_conf") * 0.3 + 0.3)
                 .alias("confidence"),
                 F.col("_ms").alias("processing_time_ms"),
                 F.concat_ws(".", *half).alias("source_ip"),
                 F.col("_status").alias("prediction_status"),
                 F.concat(F.lit("device_"), F.col("_dev").cast("string")).alias("device_id"),
                 F.col("_kind").alias("check_in_type")).alias("metadata"),
        F.date_format(F.timestamp_seconds("_at"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))


def generate_access_logs(spark: SparkSession, n: int, users: int, seed: int = 0) -> DataFrame:
    return logs_from_ids(spark.range(n), "id", users, seed)


def batch_count(total: int, batch_size: int) -> int:
    """Batches that hold all records; the last one may be shorter."""
    return max(1, -(-total // batch_size))


def with_batch_folders(logs: DataFrame, id_col: str, batch_size: int) -> DataFrame:
    """Lake folder of each record's batch, unrelated to its timestamp."""
    b = F.floor(F.col(id_col) / batch_size)

    def padded(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    return logs.withColumns({
        "Year": (F.pmod(b, F.lit(6)) + 2020).cast("string"),
        "Month": padded(F.pmod(b, F.lit(12)) + 1), "Day": padded(F.pmod(b, F.lit(28)) + 1)})


def write_generated_lake(spark: SparkSession, base: str, total: int, batch_size: int,
                         users: int, seed: int = 0) -> None:
    """Write exactly ``total`` records as JSON, one batch per task and file, in place of the old lake."""
    batches = batch_count(total, batch_size)
    # every task makes one contiguous id range, which is exactly one batch
    ids = spark.range(0, batches * batch_size, 1, batches).where(F.col("id") < total)
    logs = with_batch_folders(logs_from_ids(ids, "id", users, seed), "id", batch_size)
    (logs.drop("id").write.partitionBy("Year", "Month", "Day").mode("overwrite")
     .option("partitionOverwriteMode", "static").json(base))


def user_count(total: int) -> int:
    """Pool size the default run uses for a number of records."""
    return max(10, min(math.floor(total / 10), 10_000))
