"""Structured Streaming: incremental scoring (R1) and event-time windows with a watermark.

File sources need a directory; one table of a directory is selected with ``pathGlobFilter``.
Queries run with ``trigger(availableNow=True)``: everything that has arrived is processed in
micro-batches, the checkpoint records progress, and a restarted query resumes from it
(exactly-once into the file sink).
"""

from __future__ import annotations

import os
from typing import Optional

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.plans.score import score
from opinio.sources.reviews import is_file


def read_table_stream(spark: SparkSession, path: str, schema: Optional[T.StructType] = None,
                      max_files_per_trigger: Optional[int] = None) -> DataFrame:
    """A parquet stream over ``path`` — a table directory, or one file selected by name within its directory.
    The file system tells which it is, not the name."""
    if is_file(spark, path):
        directory, name = os.path.dirname(path), os.path.basename(path)
    else:
        directory, name = path, None
    if schema is None:
        schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if name:
        reader = reader.option("pathGlobFilter", name)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def run_available(df: DataFrame, output_path: str, checkpoint: str, mode: str = "append") -> str:
    """Process everything available, then stop; the checkpoint makes the run resumable."""
    q = (df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(output_path))
    q.awaitTermination()
    return output_path


def stream_score(model: PipelineModel, source: DataFrame, text_col: str = "review") -> DataFrame:
    """The batch scoring plan applied to a stream — stateless, so no watermark is needed."""
    return score(model, source, text_col)


def event_windows(events: DataFrame, ts_col: str = "ts", key_col: str = "event_type",
                  value_col: str = "value", window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Tumbling event-time windows per key with a watermark: late rows within ``delay`` are still
    counted, and a window is emitted (append mode) once the watermark passes its end, after
    which its state is dropped."""
    ts = F.col(ts_col)
    if isinstance(events.schema[ts_col].dataType, T.TimestampNTZType):
        ts = ts.cast("timestamp")  # event time must be TIMESTAMP (the session zone is UTC)
    return (events.withColumn(ts_col, ts).withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, window).alias("w"), key_col)
            .agg(F.count(F.lit(1)).alias("events"), F.sum(value_col).alias("value_sum"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key_col,
                    "events", "value_sum"))
