"""Acknowledgement: per shard the longest acknowledged run in order, and what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contiguous_progress(acks: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """shard, high_seqno, processed, pending from rows (shard, seqno, acked).

    processed is the last seqno before the first that is not acknowledged (gaps
    in the seqnos don't matter); without one, the start seqno. pending counts all
    rows from there on, acknowledged ones too. Two grouped passes; the gaps have a
    row per shard, at most 65536, so they are broadcast.
    """
    gaps = acks.groupBy("shard").agg(F.min(F.when(~F.col("acked"), F.col("seqno"))).alias("gap"), F.max("seqno").alias("high_seqno"))
    x = acks.select("shard", "seqno").join(F.broadcast(gaps), "shard")
    behind = F.col("gap").isNotNull() & (F.col("seqno") >= F.col("gap"))
    out = x.groupBy("shard").agg(F.max("high_seqno").alias("high_seqno"), F.max(F.when(~behind, F.col("seqno"))).alias("processed"), F.sum(behind.cast("bigint")).alias("pending"))
    if starts is None:
        return out.withColumn("processed", F.coalesce("processed", F.lit(0)))
    s = F.broadcast(starts.select("shard", F.col("seqno").alias("_start")))
    return out.join(s, "shard", "left").withColumn("processed", F.coalesce("processed", "_start", F.lit(0))).drop("_start")


def carry_manifest(log: DataFrame, start_uid: str | None = None) -> DataFrame:
    """log with checkpoint_manifest: the manifest of the last system event up to each row, else the start's."""
    w = Window.partitionBy("shard").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    uid = F.last(F.when(F.col("kind") == "system_event", F.col("manifest_uid")), ignorenulls=True).over(w)
    return log.withColumn("checkpoint_manifest", F.coalesce(uid, F.col(start_uid)) if start_uid else uid)


def checkpoints_of(progress: DataFrame, log: DataFrame) -> DataFrame:
    """The checkpoint of each shard at its processed seqno: snapshot and manifest as they were there."""
    at = log.select("shard", "seqno", "snap_start", "snap_end", *(["checkpoint_manifest"] if "checkpoint_manifest" in log.columns else []))
    p = F.broadcast(progress.select("shard", F.col("processed").alias("seqno")))
    return at.join(p, ["shard", "seqno"])


def dirty(processed: DataFrame, durable: DataFrame) -> DataFrame:
    """Checkpoints of `processed` that differ from the durable ones or have none; null-safe in every field."""
    fields = [c for c in processed.columns if c != "shard"]
    d = durable.select("shard", *[F.col(c).alias(f"_{c}") for c in fields], F.lit(True).alias("_there"))
    same = F.col("_there").isNotNull()
    for c in fields:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return processed.join(d, "shard", "left").where(~same).select(*processed.columns)


def rebase(processed: DataFrame, effective: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Progress after a reopening, and problems (shard, problem); with problems, nothing may be changed.

    Shards of `effective` take its checkpoint, backwards too, and have nothing pending;
    others stay. Both: shard, seqno, snap_start, snap_end. A row per shard, at most 65536.
    """
    new = effective.select("shard", *[F.col(c).alias(f"_{c}") for c in ("seqno", "snap_start", "snap_end")], F.lit(True).alias("_new"))
    x = processed.withColumn("_old", F.lit(True)).join(new, "shard", "full_outer")
    problem = F.when(F.col("_old").isNull(), "not followed").when(F.col("_new") & ((F.col("_snap_start") > F.col("_snap_end")) | (F.col("_seqno") > F.col("_snap_end")) | ((F.col("_seqno") != 0) & (F.col("_seqno") < F.col("_snap_start")))), "invalid")
    taken = [F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("seqno", "snap_start", "snap_end")]
    after = x.where("_old").select("shard", *taken, (F.col("_new").isNotNull() & ~F.col("seqno").eqNullSafe(F.col("_seqno"))).alias("moved"))
    return after, x.select("shard", problem.alias("problem")).where("problem IS NOT NULL")


def latest_by_key(log: DataFrame, key: str = "key") -> DataFrame:
    """Compaction: the last document event of each key, deletions left out; ties by shard and seqno.

    The newest event of a key is found on narrow columns, with a partial aggregation;
    whole rows are only taken where they are it. (shard, seqno) tells events apart.
    """
    newest = F.max_by(F.struct("shard", "seqno", "kind"), F.struct("rev_seqno", "cas", "shard", "seqno"))
    last = log.groupBy(key).agg(newest.alias("r")).where("r.kind = 'mutation'").select(F.col("r.shard").alias("shard"), F.col("r.seqno").alias("seqno"))
    return log.join(last, ["shard", "seqno"], "left_semi").select(key, *[c for c in log.columns if c != key])


def drop_replays(log: DataFrame) -> DataFrame:
    """At-least-once delivery made once: the first arrival of each (shard, branch, seqno), found on these columns alone."""
    first = log.groupBy("shard", "branch", "seqno").agg(F.min("arrival").alias("arrival"))
    return log.join(first, ["shard", "branch", "seqno", "arrival"], "left_semi").select("shard", "branch", "seqno", *[c for c in log.columns if c not in ("shard", "branch", "seqno")])
