"""Record files -> time grid, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.grid import time_grid
from wardline.sources.records import RECORD_SCHEMA, attach_record_ids
from wardline.vocab import ICU, ICU_N_BINS, Vocabulary


def start_grid_ingestion(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                         vocab: Vocabulary = ICU, n_bins: int = ICU_N_BINS, bin_minutes: int = 60,
                         available_now: bool = False, max_files_per_trigger: int = 1000):
    """Start a query that appends the grid of every newly arrived record file
    to ``sink_dir`` (parquet).  ``checkpoint_dir`` must be a shared folder;
    progress and exactly-once file tracking live there."""
    stream = (spark.readStream.schema(RECORD_SCHEMA)
              .option("header", True)
              .option("pathGlobFilter", "*.txt")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .csv(source_dir)
              .withColumn("_file", F.col("_metadata.file_path")))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        records = attach_record_ids(batch)
        grid = time_grid(records, vocab, n_bins=n_bins, bin_minutes=bin_minutes)
        grid.withColumn("batch_id", F.lit(epoch_id)).write.mode("append").parquet(sink_dir)

    writer = (stream.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
