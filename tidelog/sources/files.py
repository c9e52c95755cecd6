"""The change log in files: batch and stream scans with offsets by shard, and the frozen end of a finite scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.schema import EVENTS


def write_log(log: DataFrame, path: str) -> None:
    """Files by shard, sorted by arrival, so that shard and seqno ranges prune files and row groups."""
    log.repartition("shard").sortWithinPartitions("shard", "arrival").write.partitionBy("shard").parquet(path, mode="append")


def scan(spark: SparkSession, path: str, starts: DataFrame | None = None, shards: list[int] | None = None, collections: list[int] | None = None, schema: str = EVENTS) -> DataFrame:
    """Events after each shard's start seqno, up to its end_seqno if it has one. Shards and collections are pushed to the scan."""
    x = spark.read.schema(schema).parquet(path)
    return _bounded(x, starts, shards, collections)


def stream(spark: SparkSession, path: str, starts: DataFrame | None = None, shards: list[int] | None = None, collections: list[int] | None = None, schema: str = EVENTS, files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream; files_per_trigger is the back-pressure."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _bounded(reader.parquet(path), starts, shards, collections)


def _bounded(x: DataFrame, starts: DataFrame | None, shards: list[int] | None, collections: list[int] | None) -> DataFrame:
    if shards is not None:
        x = x.where(F.col("shard").isin(*shards))
    if collections is not None:
        x = x.where(F.col("collection_id").isNull() | F.col("collection_id").isin(*collections))
    if starts is None:
        return x
    s = F.broadcast(starts.select("shard", "start_seqno", "end_seqno"))  # at most 65536 shards
    inside = (F.col("seqno").isNull() | (F.col("seqno") > F.col("start_seqno"))) & (F.col("end_seqno").isNull() | F.col("seqno").isNull() | (F.col("seqno") <= F.col("end_seqno")))
    return x.join(s, "shard").where(inside).drop("start_seqno", "end_seqno")
