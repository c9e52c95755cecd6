"""A change log derived from the events table, and the tables that go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS = 16
#: Seqnos in a snapshot.
WINDOW = 64


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def change_log(events: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Document events: shard, seqno, arrival, rev_seqno, key, kind, cas, collection_id, snap_start, snap_end, acked."""
    by_shard = Window.partitionBy("shard").orderBy("event_id")
    in_shard = Window.partitionBy("shard", "user_id").orderBy("event_id")
    kind = F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "deletion").otherwise("expiration")).otherwise("mutation")
    coll = F.when(F.col("event_type") == "click", 8).when(F.col("event_type") == "view", 9).when(F.col("event_type") == "purchase", 10).when(F.col("event_type") == "signup", 11).otherwise(F.col("event_id") % 4 + 8)
    x = events.select("event_id", "user_id", "event_type", "ts", (F.col("user_id") % shards).cast("int").alias("shard"))
    x = x.withColumns({"seqno": F.row_number().over(by_shard).cast("bigint"), "rev_seqno": F.row_number().over(in_shard).cast("bigint"), "high": F.count("*").over(Window.partitionBy("shard"))})
    w = F.floor((F.col("seqno") - 1) / WINDOW)
    return x.select(
        "event_id", "shard", "seqno", (F.col("seqno") * 4).alias("arrival"), "rev_seqno", F.concat(F.lit("user::"), F.col("user_id").cast("string")).alias("key"), kind.alias("kind"),
        (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("cas"), coll.cast("bigint").alias("collection_id"),
        (w * WINDOW + 1).alias("snap_start"), F.least(w * WINDOW + WINDOW, F.col("high")).alias("snap_end"), (F.col("event_id") % 7 != 3).alias("acked"),
    )


def with_markers(log: DataFrame, swap_every: int = 97) -> DataFrame:
    """The log with its snapshot markers in order; every swap_every-th event arrives after the next one."""
    late = F.when(F.col("event_id") % swap_every == 0, F.lit(6)).otherwise(F.lit(0))
    e = log.select("event_id", "shard", "kind", "seqno", (F.col("arrival") + late).alias("arrival"), F.lit(None).cast("bigint").alias("snap_start"), F.lit(None).cast("bigint").alias("snap_end"), "collection_id", "cas")
    m = log.groupBy("shard", "snap_start", "snap_end").agg(F.min("arrival").alias("arrival"))
    m = m.select(
        F.lit(None).cast("bigint").alias("event_id"), "shard", F.lit("snapshot_marker").alias("kind"), F.lit(None).cast("bigint").alias("seqno"), (F.col("arrival") - 1).alias("arrival"), "snap_start", "snap_end",
        F.lit(None).cast("bigint").alias("collection_id"), F.lit(None).cast("bigint").alias("cas"),
    )
    return e.unionByName(m)


#: The same log for the oracle.
LOG_SQL = """
log AS (
  SELECT event_id, shard, seqno, seqno * 4 AS arrival, rev_seqno, 'user::' || user_id AS key,
    CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'deletion' ELSE 'expiration' END ELSE 'mutation' END AS kind,
    epoch_us(ts) * 1000 AS cas,
    (CASE event_type WHEN 'click' THEN 8 WHEN 'view' THEN 9 WHEN 'purchase' THEN 10 WHEN 'signup' THEN 11 ELSE event_id % 4 + 8 END)::BIGINT AS collection_id,
    ((seqno - 1) // 64) * 64 + 1 AS snap_start, least(((seqno - 1) // 64) * 64 + 64, high) AS snap_end, event_id % 7 <> 3 AS acked
  FROM (SELECT *, (user_id % 16)::INT AS shard, row_number() OVER (PARTITION BY user_id % 16 ORDER BY event_id) AS seqno,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rev_seqno, count(*) OVER (PARTITION BY user_id % 16) AS high FROM events)),
marked AS (
  SELECT event_id, shard, kind, seqno, arrival + CASE WHEN event_id % 97 = 0 THEN 6 ELSE 0 END AS arrival, NULL::BIGINT AS snap_start, NULL::BIGINT AS snap_end, collection_id, cas FROM log
  UNION ALL
  SELECT NULL, shard, 'snapshot_marker', NULL, min(arrival) - 1, snap_start, snap_end, NULL, NULL FROM log GROUP BY shard, snap_start, snap_end)
"""
