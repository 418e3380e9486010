"""Incremental landing load with Structured Streaming.

The batch loader (``strata.sources.csv_text.ingest_all``) re-reads every
file on each run. For a landing folder that keeps receiving files, the
same text-first load runs as a streaming query instead: the file source
picks up only files it has not seen, the parquet sink commits each batch
atomically, and the checkpoint (in the shared folder) records progress,
so a restarted or partially failed run neither loses nor duplicates
rows. ``availableNow`` processes everything that has arrived and stops,
which fits a scheduled job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.csv_text import header_of, landed, text_reader


def landing_stream(spark: SparkSession, landing_dir: str, columns: list[str],
                   multiline: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the CSV files of ``landing_dir``: text
    columns with clean names, source file and load time. A file whose header
    differs from ``columns`` fails the query."""
    # files may sit in nested folders (one per delivery); pick them all up
    reader = text_reader(spark.readStream, columns, multiline).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return landed(reader.csv(landing_dir), columns)


def ingest_available(spark: SparkSession, landing_dir: str, target_dir: str, checkpoint_dir: str,
                     columns: list[str] | None = None, multiline: bool = True) -> StreamingQuery:
    """Load every file that arrived in ``landing_dir`` since the last run
    into the parquet table at ``target_dir``, then stop."""
    cols = columns or header_of(spark, landing_dir)
    q = (landing_stream(spark, landing_dir, cols, multiline)
         .writeStream.format("parquet").option("path", target_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
