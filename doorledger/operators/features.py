"""Feature table: latest row per entity, materialization, lookup with expiry, point-in-time join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doorledger.functions.vectors import vector_from_json
from doorledger.operators.ordered import HOUR_MS, last_so_far

TTL_DAYS = 365
EVENT, CREATED = "event_timestamp", "created_at"
DEFAULT_FEATURES = ("embedding", "embedding_model", "registration_confidence")


def _days(n: float) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n * 86_400.0))


def _time(value: str | Column) -> Column:
    return F.lit(value).cast("timestamp") if isinstance(value, str) else value


def users_to_features(users: DataFrame) -> DataFrame:
    """Users with an embedding as feature rows; their update time is the event time."""
    return users.where(F.col("face_embedding").isNotNull()).select(
        F.col("id").cast("string").alias("employee_id"),
        vector_from_json("face_embedding").alias("embedding"),
        *_constants(1.0), F.col("updated_at").alias(EVENT), F.col("created_at").alias(CREATED))


def _constants(confidence: float) -> list[Column]:
    # fixed values of the feature source
    return [F.lit("facenet").alias("embedding_model"),
            F.lit(1).cast("bigint").alias("embedding_version"),
            F.lit(1.0).cast("float").alias("image_quality_score"),
            F.lit(1).cast("bigint").alias("num_faces_detected"),
            F.lit(confidence).cast("float").alias("registration_confidence")]


def embedding_rows(embeddings: DataFrame, key: str, now: str | Column,
                   confidence: float = 1.0) -> DataFrame:
    """New embeddings as feature rows ready to push."""
    at = _time(now)
    return embeddings.select(F.col(key).cast("string").alias("employee_id"),
                             F.col("embedding").cast("array<float>").alias("embedding"),
                             *_constants(confidence), at.alias(EVENT), at.alias(CREATED))


def latest_features(features: DataFrame, key: str = "employee_id") -> DataFrame:
    """Newest row per entity by event time, then creation time.

    A maximum of structs instead of a window: partially aggregated before the shuffle, so an
    entity with a large share of all rows is reduced where its rows are read.
    """
    rest = [c for c in features.columns if c not in (key, EVENT, CREATED)]
    newest = F.max(F.struct(EVENT, CREATED, *rest)).alias("_r")
    return (features.groupBy(key).agg(newest)
            .select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c)
                      for c in features.columns]))


def materialize(offline: DataFrame, start: str | Column, end: str | Column,
                online: DataFrame | None = None, key: str = "employee_id") -> DataFrame:
    """Online table after loading the rows with ``start <= event time <= end``."""
    span = offline.where((F.col(EVENT) >= _time(start)) & (F.col(EVENT) <= _time(end)))
    return _merge(online, span, key)


def materialize_incremental(offline: DataFrame, online: DataFrame | None,
                            last: str | Column | None, now: str | Column,
                            ttl_days: float = TTL_DAYS, key: str = "employee_id") -> DataFrame:
    """Load what is new since the last run, ``(last, now]``; the first run looks back one TTL."""
    at = _time(now)
    after = _time(last) if last is not None else at - _days(ttl_days)
    fresh = offline.where((F.col(EVENT) > after) & (F.col(EVENT) <= at))
    return _merge(online, fresh, key)


def _merge(online: DataFrame | None, rows: DataFrame, key: str) -> DataFrame:
    return latest_features(rows if online is None else online.unionByName(rows), key)


def push(rows: DataFrame, offline: DataFrame | None = None, online: DataFrame | None = None,
         to: str = "both", key: str = "employee_id") -> tuple[DataFrame | None, DataFrame | None]:
    """(offline history with the rows appended, online table with them merged in)."""
    if to not in ("online", "offline", "both"):
        raise ValueError(f"Unknown target: {to}")
    if to in ("offline", "both"):
        offline = rows if offline is None else offline.unionByName(rows)
    if to in ("online", "both"):
        online = _merge(online, rows, key)
    return offline, online


def online_lookup(keys: DataFrame, online: DataFrame,
                  columns: Sequence[str] = DEFAULT_FEATURES,
                  key: str = "employee_id") -> DataFrame:
    """One row per requested key, nulls for unknown ones."""
    return keys.join(online.select(key, *columns), key, "left")


def online_features(keys: DataFrame, online: DataFrame, now: str | Column,
                    columns: Sequence[str] = DEFAULT_FEATURES, ttl_days: float = TTL_DAYS,
                    key: str = "employee_id") -> DataFrame:
    """Lookup in which values older than the TTL read as null."""
    live = F.col(EVENT) >= _time(now) - _days(ttl_days)
    masked = online.select(key, *[F.when(live, F.col(c)).alias(c) for c in columns])
    return keys.join(masked, key, "left")


def embeddings_for_matching(keys: DataFrame | None, online: DataFrame, now: str | Column,
                            ttl_days: float = TTL_DAYS, key: str = "employee_id") -> DataFrame:
    """(key, float vector) of the requested entities that have one; no request, no rows."""
    if keys is None:
        return online.select(key, F.col("embedding").cast("array<float>")).limit(0)
    found = online_features(keys, online, now, ["embedding"], ttl_days, key)
    return found.where(F.col("embedding").isNotNull()).select(
        key, F.col("embedding").cast("array<float>").alias("embedding"))


def historical_features(spine: DataFrame, features: DataFrame, columns: Sequence[str],
                        ttl_days: float = TTL_DAYS, key: str = "employee_id",
                        spine_time: str = EVENT, block_ms: int = HOUR_MS) -> DataFrame:
    """Point-in-time join: each spine row gets the entity's latest feature row at or before
    its time and no older than the TTL, as the ``columns`` plus ``feature_timestamp``.

    Both sides go through one ordered pass per entity and time block. No pairs of spine and
    feature rows are formed.
    """
    value = F.struct(EVENT, CREATED, *columns)
    own = spine.columns
    facts = features.where(F.col(key).isNotNull() & F.col(EVENT).isNotNull())
    left = spine.select(F.col(key).alias("_key"), F.col(spine_time).alias("_at"),
                        F.lit(1).alias("_kind"), F.struct(*own).alias("_spine"))
    right = facts.select(F.col(key).alias("_key"), F.col(EVENT).alias("_at"),
                         F.lit(0).alias("_kind"), value.alias("_v"))
    both = (left.unionByName(right, allowMissingColumns=True)
            .withColumn("_us", F.unix_micros(F.col("_at").cast("timestamp"))))
    found = last_so_far(both, ["_key"], "_us", ["_us", "_kind", "_v"], "_v", "_f",
                        block_ms=block_ms * 1000)
    age_ok = F.col(f"_f.{EVENT}") >= F.col("_at") - _days(ttl_days)
    return found.where(F.col("_kind") == 1).select(
        *[F.col(f"_spine.{c}").alias(c) for c in own],
        *[F.when(age_ok, F.col(f"_f.{c}")).alias(c) for c in columns],
        F.when(age_ok, F.col(f"_f.{EVENT}")).alias("feature_timestamp"))
