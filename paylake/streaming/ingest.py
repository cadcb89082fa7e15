"""Incremental loads driven by Structured Streaming.

The reference has no streaming engine; its incremental mode is "load the
new batch, upsert it".  Here the raw landing folder is read as a file
stream and every micro-batch runs the same load job (``run_load`` with the
batch as its whole input) through ``foreachBatch``.  The stream checkpoint
lives in the shared folder, and the load is idempotent per batch (REPLACE
for dimensions and summary, IGNORE for facts), so a micro-batch replayed
after a failure leaves the warehouse unchanged.

A micro-batch need not hold whole days: the summary rows of its days are made
from the stored facts, which the batch has been added to.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.plans.load import run_load
from paylake.schemas import ORD, RAW, RAW_COLUMNS
from paylake.session import shared_root
from paylake.sources.raw import csv_options, csv_schema, text_to_raw
from paylake.sources.warehouse import Warehouse


def start_file_ingest(spark: SparkSession, landing_dir: str, warehouse: Warehouse, *,
                     checkpoint: str | None = None, available_now: bool = True,
                     max_files_per_trigger: int | None = None, fmt: str = "csv",
                     multi_line: bool = False, **load_options):
    """Start the stream over CSV (default) or Parquet raw files; returns the
    ``StreamingQuery``.  CSV columns are bound by the names in the headers; the
    folder needs one file at the start, to read them from."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    place = [F.col("_metadata.file_path").alias("_file"),
             F.col("_metadata.file_block_start").alias("_block")]
    if fmt == "csv":
        schema = csv_schema(spark, landing_dir, multi_line)
        stream = csv_options(reader.schema(schema), multi_line).csv(landing_dir)
    elif fmt == "parquet":
        stream = reader.schema(RAW).parquet(landing_dir)
    else:
        raise ValueError("fmt must be 'csv' or 'parquet'")
    stream = stream.select(*RAW_COLUMNS, *place)

    def as_raw(batch: DataFrame) -> DataFrame:
        """The batch with its ingest order; text fields as in the CSV scan."""
        order = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"),
                         F.monotonically_increasing_id().alias("pos"))
        batch = batch.select(*RAW_COLUMNS, order.alias(ORD))
        return text_to_raw(batch) if fmt == "csv" else batch

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        run_load(spark, as_raw(batch), warehouse, full=True,
                 **{"summary_from_store": True, **load_options})

    # one checkpoint per landing folder (and target warehouse) unless given
    tag = hashlib.sha1(f"{landing_dir}|{warehouse.root}".encode()).hexdigest()[:16]
    location = checkpoint or f"{shared_root(spark).rstrip('/')}/paylake-stream/ingest-{tag}"
    writer = (stream.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
