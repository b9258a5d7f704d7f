"""Stream ends: topics of text values in and out, files and console."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def access_log_stream(spark: SparkSession, servers: str, topic: str = "access-logs",
                      starting: str = "latest", **options: str) -> DataFrame:
    """Topic values as text, with the offset as arrival order and the arrival time.

    Needs the Kafka package on the class path. Cap a micro-batch with
    ``maxOffsetsPerTrigger``. Any other stream with a ``value`` text column fits the jobs too.
    """
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", starting)
           .options(**options).load())
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.col("offset").alias("ingest_seq"), F.col("timestamp").alias("ingest_ts"))


def alert_sink(alerts: DataFrame, target: dict[str, str], checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Write alert values: ``target`` holds the sink ``format`` and its options.

    To a topic this is at-least-once, to files exactly-once.
    """
    options = dict(target)
    writer: DataStreamWriter = (alerts.writeStream.format(options.pop("format"))
                                .options(**options).outputMode("append")
                                .option("checkpointLocation", checkpoint))
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def console_sink(alerts: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Print alerts as they come, for debugging."""
    return (alerts.writeStream.format("console").option("truncate", "false")
            .outputMode("append")
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
