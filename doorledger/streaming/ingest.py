"""Landing the access-log topic in the lake."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from doorledger.functions.events import date_parts


def ingest_to_lake(values: DataFrame, base: str, checkpoint: str, at: Column | None = None,
                   max_records_per_file: int = 1000, trigger: dict | None = None
                   ) -> StreamingQuery:
    """Append raw values, unchanged, as JSON lines below ``Year=/Month=/Day=`` (UTC).

    The day is that of ingestion unless ``at`` gives another time. At most
    ``max_records_per_file`` lines go into a file and a batch is written every minute; raise
    the former where a day holds many millions of rows. Files are exactly-once.
    """
    at = F.current_timestamp() if at is None else at
    rows = values.select("value", *date_parts(at))
    return (rows.writeStream.format("text").partitionBy("Year", "Month", "Day")
            .option("path", base).option("checkpointLocation", checkpoint)
            .option("maxRecordsPerFile", str(max_records_per_file)).outputMode("append")
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())
