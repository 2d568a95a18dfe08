"""Incremental forms of the ingest step (S1/S2 + cleaning).

The reference has no streaming operator; its load is a one-off CSV import.
These run the same load-and-clean as a Structured Streaming query over a
folder that receives new CSV files, appending to the same Parquet table with
exactly-once bookkeeping in the shared checkpoint folder.
"""

from kpiloom.streaming.ingest import stream_sales_ingest, stream_visits_ingest  # noqa: F401
