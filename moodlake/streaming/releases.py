"""Incremental ingest of landed new-release files into bronze.

Album records land as JSON files in a folder.  A Structured Streaming query
with the `availableNow` trigger processes every file not yet seen, shapes the
tracks into bronze rows and appends them to the bronze folder with the
exactly-once file sink; the checkpoint remembers which files were consumed,
so a daily run (or a rerun after a lost executor or driver) picks up exactly
the new files.  The flattening is stateless, so no state store is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodlake.sources.albums import ALBUM_SCHEMA, flatten_albums


def start_release_ingest(spark: SparkSession, landing: str, bronze: str, checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest; rows carry the processing time as ingestion time.
    Progress is kept in `checkpoint`, by default a folder beside `bronze`: it
    belongs to that table and must outlive the process, as the table does."""
    checkpoint = checkpoint or f"{bronze.rstrip('/')}_ingest_progress"
    reader = spark.readStream.schema(ALBUM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = flatten_albums(reader.json(landing), F.current_timestamp())
    return (rows.writeStream.format("parquet")
            .option("path", bronze)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start())


def ingest_new_releases(spark: SparkSession, landing: str, bronze: str, checkpoint: str | None = None) -> None:
    """Run one incremental pass to completion."""
    q = start_release_ingest(spark, landing, bronze, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
