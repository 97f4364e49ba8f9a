"""Search tables that arrive file by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sedimark.sources.text import BLAST_12


def arriving_hits(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the hits in the files that appear in ``folder``, with the time of arrival."""
    rows = spark.readStream.schema(BLAST_12).option("sep", "\t").option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return rows.withColumn("arrived", F.current_timestamp())


def best_so_far(hits: DataFrame) -> DataFrame:
    """The best hit of every query among those that came so far; the state holds one row per query."""
    order = F.struct("bit_score", "percent_identity", "alignment_length")
    return hits.groupBy("query").agg(F.max_by("subject", order).alias("subject"), F.max("bit_score").alias("bit_score"))


def hourly_counts(hits: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Hits per hour of arrival; hours older than the watermark leave the state."""
    return hits.withWatermark("arrived", lateness).groupBy(F.window("arrived", "1 hour")).agg(F.count(F.lit(1)).alias("hits"))


def write_batches(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to a Parquet table; the checkpoint makes every file count once, also after a restart."""
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
