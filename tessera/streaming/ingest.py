"""The same ingestion as a stream that takes what is new and ends; files are remembered by the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.ingest import source_ref
from tessera.sources.staging import EVENT_TYPES, classified


def stream_into(spark: SparkSession, folder: str, table: str, checkpoint: str, event_types: list[str] = EVENT_TYPES) -> DataFrame:
    """Appends all lines of new files, classified, to the Parquet folder `table` exactly once; returns the table.

    Valid lines have a null error_reason. A file that is sent again under a new name adds its lines, as any other file.
    """
    lines = spark.readStream.format("text").load(folder).select("value", source_ref().alias("source_ref"))
    out = classified(lines, event_types).withColumn("ingest_ts", F.current_timestamp())
    query = out.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(table)
