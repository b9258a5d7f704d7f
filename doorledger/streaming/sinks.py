"""Sinks that survive a restart, and the routing of late rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from doorledger.streaming.timers import use_timers


def batch_sink(rows: DataFrame, parts: dict[str, tuple[str, str | None]], checkpoint: str, trigger: dict | None = None,
               written: Callable[[int], None] | None = None) -> StreamingQuery:
    """Write every micro-batch to folders named by its number, so that a repeated batch replaces itself.

    ``parts`` gives per name a path and a condition (or None) of its rows. Spark repeats a batch, with the
    same input and state, when a job ends between its work and its commit; whatever was written before is then
    replaced, and nothing is lost or doubled. ``written`` is called between the write and the commit.
    """
    def write(batch: DataFrame, number: int) -> None:
        several = len(parts) > 1
        held = batch.persist() if several else batch
        for path, condition in parts.values():
            (held if condition is None else held.where(condition)).write.mode("overwrite").parquet(f"{path}/batch_id={number}")
        if several:
            held.unpersist()
        if written is not None:
            written(number)

    return (rows.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``batch_sink`` wrote, without the batch numbers."""
    return spark.read.schema(schema).parquet(f"{path}/batch_id=*")


class _Lateness(StatefulProcessor):
    """Keeps nothing; only such an operator knows the watermark of its batch."""

    def init(self, handle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            yield pdf.drop(columns=["part", "ms"]).assign(late=pdf["ms"] <= now)

    def close(self) -> None:
        pass


def with_lateness(rows: DataFrame, ts: str) -> DataFrame:
    """Add ``late``: is the row's ``ts`` at or before the watermark of its micro-batch? No row is dropped.

    ``ts`` must carry the watermark. A row keeps all its columns; they are dealt over as many
    parts as there are shuffle partitions, whatever their keys.
    """
    use_timers(rows.sparkSession)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = F.timestamp_micros(F.unix_micros(F.col(ts)))  # without the mark, by which Spark drops late rows
    # the operator's frames keep plain names only
    named = rows.select(*[(plain if c == ts else F.col(c)).alias(f"c{i}") for i, c in enumerate(rows.columns)],
                        F.floor(F.unix_micros(F.col(ts)) / 1000).alias("ms"),
                        F.pmod(F.xxhash64(*rows.columns), F.lit(parts)).alias("part"))
    out = StructType([*[StructField(f"c{i}", f.dataType) for i, f in enumerate(rows.schema)], StructField("late", BooleanType())])
    routed = named.groupBy("part").transformWithStateInPandas(_Lateness(), out, "append", "eventTime")
    return routed.withColumnsRenamed({f"c{i}": c for i, c in enumerate(rows.columns)})


def route_late(rows: DataFrame, ts: str, on_time: str, late: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rows in time to one folder and late ones to another, from one pass over each micro-batch."""
    return batch_sink(with_lateness(rows, ts), {"on_time": (on_time, "not late"), "late": (late, "late")}, checkpoint, trigger)
