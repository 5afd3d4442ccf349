"""Streaming scoring (#172): the batch scorer on a Structured Streaming source.

Scoring is stateless, so no watermark or state store is involved: each
micro-batch is preprocessed and scored exactly like ``score_batch`` and
appended to a Parquet sink. The checkpoint location makes the query restart
where it stopped after a failure (exactly-once file sink).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.models import FittedModel
from ..operators.scoring import score_batch


def score_stream(spark: SparkSession, source_dir: str, schema, model: FittedModel, sink_dir: str,
                 checkpoint_dir: str, artifact_rows: Sequence | None = None,
                 raw_columns: Sequence[str] | None = None, keep: Sequence[str] = (),
                 version: str = "v1", available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start (and with ``available_now`` wait for) a file-source scoring stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(source_dir)
    scored = score_batch(requests, model, artifact_rows, raw_columns, keep, version)
    writer = (scored.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def read_scored(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(sink_dir)
