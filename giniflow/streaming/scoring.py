"""Scoring on a stream.

The reference has no streaming part. What carries over is that WoE encoding (B8) and package scoring (S10) are
stateless projections with small literal lookups, so the same functions apply to a Structured Streaming DataFrame:
``readStream`` of new parquet files -> encode / score -> ``writeStream`` with a checkpoint in the shared checkpoint
folder. No state store, watermark or aggregation is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from giniflow.operators.binning import BinningModel
from giniflow.session import ensure_checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def woe_stream(stream: DataFrame, model: BinningModel, keep: list[str]) -> DataFrame:
    """WoE columns on a streaming frame (rows with unseen categories are dropped, as in batch)."""
    return model.transform(stream, keep=keep)


def write_stream(df: DataFrame, sink: str, name: str, available_now: bool = True) -> StreamingQuery:
    """Append to parquet; the checkpoint lives under the session's shared checkpoint folder."""
    ckpt = ensure_checkpoint_dir(df.sparkSession)
    writer = df.writeStream.format("parquet").option("path", sink).option(
        "checkpointLocation", f"{ckpt}/streams/{name}").outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
