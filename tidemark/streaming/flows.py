"""Continuous forms of the load flows, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.scalars import make_id
from tidemark.operators.mapping import Rule, map_fields
from tidemark.operators.models import score
from tidemark.sources.readers import partition_format


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, pattern: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    """Parquet files that arrive in a folder. `max_files` bounds one micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def score_stream(
    stream: DataFrame, rules: Sequence[Rule], model: Transformer, text_cols: Sequence[str], source: str, out_col: str
) -> DataFrame:
    """Map fields, then score with a fitted model. Stateless, so it scales with the input's partitions."""
    return score(map_fields(stream, rules), model, text_cols, source, out_col)


def ingest_time_partitions(
    stream: DataFrame, ts: str, id_cols: Sequence[str], period: str = "day", watermark: str = "1 hour"
) -> DataFrame:
    """Add `id` and the partition column `dt`; a second row with the same id within the watermark is dropped.

    State holds ids only as long as the watermark is behind.
    """
    at = F.col(ts).cast("timestamp")
    typed = stream.withColumn(ts, at).withColumn("id", make_id(list(id_cols), "-"))
    return (
        typed.withWatermark(ts, watermark)
        .dropDuplicatesWithinWatermark(["id"])
        .withColumn("dt", F.date_format(F.col(ts), partition_format(period)))
    )


def stream_sessions(stream: DataFrame, key: str, ts: str, measure: str, gap: str, watermark: str) -> DataFrame:
    """Closed sessions per key: start, last event, total and count.

    A session closes once the watermark has passed its end, so in append mode the newest sessions are
    still open; rows later than the watermark are dropped. Two rows exactly one gap apart share a session.
    """
    # rows of one key are merged into sessions before the shuffle, so a busy key ships few rows
    stream.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    typed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        typed.withWatermark(ts, watermark)
        .groupBy(key, F.session_window(ts, gap).alias("w"))
        .agg(
            F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.sum(measure).alias("total_bytes_l"),
            F.count(F.lit(1)).alias("total_requests_l"),
        )
        .drop("w")
    )


def start_write(
    df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Write to Parquet until the input present at the start is used up. The checkpoint folder makes a
    restart go on where the last run stopped, without loss or repeats."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start()
