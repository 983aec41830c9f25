"""Incremental ingest: files that arrive are parsed once and land by protein or in an append table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import sdf


def stream_texts(spark: SparkSession, glob: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of whole files below a glob: ``source_file, text``."""
    reader = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(glob).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text"))


def ingest(stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], partition_by: str | None = None):  # noqa: ANN201
    """Starts a run over all that is new; every file counts once, by the stream's checkpoint.

    A batch that is repeated after a failure replaces its own folder (named by
    the batch), so no row lands twice.
    """

    def land(batch: DataFrame, number: int) -> None:
        rows = transform(batch)
        w = rows.write.mode("overwrite")
        (w.partitionBy(partition_by) if partition_by else w).parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_poses(spark: SparkSession, glob: str, target: str, checkpoint: str, modes: int = 9):  # noqa: ANN201
    """Docked files into poses, one folder per batch."""
    return ingest(stream_texts(spark, glob), target, checkpoint, lambda t: sdf.poses_of(sdf.split_blocks(t), modes).drop("block"))


def late_counts(stream: DataFrame, time: str, key: str, delay: str = "2 days", window: str = "1 day") -> DataFrame:
    """Rows per key and event-time window; rows later than ``delay`` are dropped once their window is closed."""
    at = F.col(time).cast("timestamp")
    return stream.withColumn("__t", at).withWatermark("__t", delay).groupBy(F.window("__t", window), key).agg(F.count("*").alias("n"))


def unseen(df: DataFrame, manifest: DataFrame, key: str = "source_file") -> DataFrame:
    """Rows of files that the manifest doesn't list (skip what is done, resume)."""
    return df.join(manifest.select(key).distinct(), key, "left_anti")


def changed(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose signature (``file, signature``) is new or differs from the manifest's."""
    known = manifest.select("file", F.col("signature").alias("__known"))
    return listing.join(known, "file", "left").where(~F.col("signature").eqNullSafe(F.col("__known"))).drop("__known")
