"""Structured Streaming jobs."""

from doorledger.streaming.fraud import count_stream, fraud_job, fraud_stream
from doorledger.streaming.ingest import ingest_to_lake
from doorledger.streaming.sinks import batch_sink, read_batches, route_late, with_lateness
from doorledger.streaming.timers import condition_events, counter_increases, counter_rates
from doorledger.streaming.topics import access_log_stream, alert_sink, console_sink

__all__ = ["access_log_stream", "alert_sink", "batch_sink", "condition_events", "console_sink", "count_stream",
           "counter_increases", "counter_rates", "fraud_job", "fraud_stream", "ingest_to_lake", "read_batches",
           "route_late", "with_lateness"]
