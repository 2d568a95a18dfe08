"""Structured Streaming ingest of retail and experiment CSV drops."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kpiloom.operators.cleaning import clean_sales
from kpiloom.schema import SALES_CSV, VISITS_CSV
from kpiloom.sources.files import csv_options, only_good, typed

# text columns as they stand in the file, in header order (checked against each file's header)
SALES_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in SALES_CSV.fields])
VISITS_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in VISITS_CSV.fields])


def _checkpoint(table_dir: str, location: str | None) -> str:
    """The stream's state stands beside the table it fills, so a later
    application goes on where the last one stopped and no two streams share it."""
    return location or f"{table_dir.rstrip('/')}/_stream_checkpoint"


def _lines(spark: SparkSession, schema: T.StructType, source_dir: str, most: int | None):
    reader = spark.readStream.schema(schema).options(**{**csv_options(), "mode": "FAILFAST"})
    return (reader.option("maxFilesPerTrigger", most) if most else reader).csv(source_dir)


def stream_sales_ingest(spark: SparkSession, source_dir: str, table_dir: str, *,
                        date_format: str | None = None, checkpoint_location: str | None = None,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append every new retail CSV in ``source_dir`` to the cleaned Parquet
    table at ``table_dir`` (S1 + C1-C3, same rules as the batch path).

    ``available_now`` processes what is there and stops (scheduled jobs);
    otherwise the query keeps running.  The stream is stateless, so its
    checkpoint (by default in the table's folder) holds only the file log and
    offsets.  A bad record stops the stream.
    """
    raw = only_good(typed(_lines(spark, SALES_TEXT, source_dir, max_files_per_trigger), SALES_CSV))
    writer = (clean_sales(raw, date_format).writeStream.format("parquet").outputMode("append")
              .option("path", table_dir)
              .option("checkpointLocation", _checkpoint(table_dir, checkpoint_location)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_visits_ingest(spark: SparkSession, source_dir: str, table_dir: str, *,
                         checkpoint_location: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append every new experiment CSV in ``source_dir`` to a Parquet table."""
    raw = only_good(typed(_lines(spark, VISITS_TEXT, source_dir, None), VISITS_CSV))
    writer = (raw.writeStream.format("parquet").outputMode("append").option("path", table_dir)
              .option("checkpointLocation", _checkpoint(table_dir, checkpoint_location)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
