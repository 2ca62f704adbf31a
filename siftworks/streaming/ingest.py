"""Incremental ingestion: records arrive as a stream, each key enters the queue once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def distinct_records(stream: DataFrame, key: str = "key", event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """The first record of every key. With an event time, state is dropped once keys can't come again within `late`."""
    if event_time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])


def ingest(stream: DataFrame, path: str, checkpoint: str, key: str = "key", event_time: str | None = None) -> StreamingQuery:
    """Append new records to path and stop when the source has nothing more; run again to go on."""
    return distinct_records(stream, key, event_time).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
