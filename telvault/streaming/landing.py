"""File-stream landing: typed CSV files arriving in a folder -> bronze parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telvault.schemas import SCHEMAS
from telvault.sources.files import CSV_READ_OPTIONS


def land_stream(spark: SparkSession, source_dir: str, table: str, sink_dir: str, checkpoint: str,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream from landing CSVs to parquet.

    Each run processes the files not yet seen (tracked in ``checkpoint``,
    which must be on shared storage) and stops; rerunning after a failure
    resumes without duplicating output (the parquet file sink commits
    through its own log). The options are those of the batch reader: a file
    whose header is not the declared one stops the stream. Rows carry the landing time as ``_landed_at``.
    """
    reader = spark.readStream.schema(SCHEMAS[table]).options(**CSV_READ_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir).withColumn("_landed_at", F.localtimestamp())
    return (stream.writeStream.format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
