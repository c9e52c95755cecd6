"""Starting points, checkpoint checks, rollback and failover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def invariant_broken() -> Column:
    """Why a checkpoint (seqno, snap_start, snap_end) is invalid, or null."""
    return (
        F.when(F.col("snap_start") > F.col("snap_end"), "start after end").when(F.col("seqno") > F.col("snap_end"), "seqno after end")
        .when((F.col("seqno") != 0) & (F.col("seqno") < F.col("snap_start")), "seqno before start")
    )


def moves_back(seqno: Column, to: Column) -> Column:
    return to < seqno


def initial_starts(assigned: DataFrame, stored: DataFrame, fallback: str = "earliest") -> DataFrame:
    """assigned shards with their start: the stored checkpoint, else `fallback` (earliest, latest or checkpoint).

    Shards are at most 65536, so the checkpoints are broadcast.
    """
    s = F.broadcast(stored.select("shard", "branch", "seqno", "snap_start", "snap_end", "manifest_uid", F.lit("checkpoint").alias("_from")))
    return assigned.join(s, "shard", "left").withColumn("start", F.coalesce("_from", F.lit(fallback))).drop("_from")


def resolve_starts(starts: DataFrame, highs: DataFrame, newest: DataFrame, finite: bool = False, bucket_uuid: str | None = None) -> DataFrame:
    """The stream request of each shard: branch, start seqno and snapshot, frozen end, flags and any rollback needed before opening.

    earliest starts at 0, latest at the high seqno; a branch of 0 means the newest
    one. A checkpoint above the high seqno needs a rollback to it. Strict branch
    checking is asked for only at an explicit checkpoint with seqno 0.
    """
    x = starts.join(F.broadcast(highs.select("shard", "high_seqno")), "shard", "left").join(F.broadcast(newest.select("shard", F.col("branch").alias("_newest"))), "shard", "left")
    high = F.coalesce("high_seqno", F.lit(0))
    is_ckpt = F.col("start") == "checkpoint"
    at = F.when(F.col("start") == "latest", high).when(is_ckpt, F.col("seqno")).otherwise(F.lit(0))
    branch = F.when(is_ckpt & (F.coalesce("branch", F.lit(0)) != 0), F.col("branch")).otherwise(F.col("_newest"))
    end = high if finite else F.lit(None).cast("bigint")
    uuid = F.lit(bucket_uuid) if bucket_uuid else F.lit(None).cast("string")
    return x.select(
        "shard", "start", branch.alias("branch"), at.alias("start_seqno"),
        F.when(is_ckpt, F.col("snap_start")).otherwise(at).alias("snap_start"), F.when(is_ckpt, F.col("snap_end")).otherwise(at).alias("snap_end"),
        end.alias("end_seqno"), F.when(is_ckpt, F.col("manifest_uid")).alias("manifest_uid"), uuid.alias("bucket_uuid"),
        (is_ckpt & (F.col("seqno") == 0)).alias("strict_branch"), F.when(is_ckpt & (F.col("seqno") > high), high).alias("rollback_to"),
        F.when(is_ckpt, invariant_broken()).alias("invalid"),
    )


def rewind(rollbacks: DataFrame, failover: DataFrame) -> DataFrame:
    """(shard, rollback_seqno) with the checkpoint to go back to: the newest branch that began at or before it; null branch: none.

    By position in the log, not by seqno. A failover log has a few entries for each
    of at most 65536 shards, so it is broadcast; rollbacks may be many.
    """
    logs = failover.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("pos", "branch", "seqno"))).alias("_log"))
    x = rollbacks.join(F.broadcast(logs), "shard", "left").withColumn("_r", F.get(F.filter("_log", lambda e: e["seqno"] <= F.col("rollback_seqno")), F.lit(0)))
    at = F.when(F.col("_r.branch").isNotNull(), F.col("rollback_seqno"))
    return x.select("shard", "rollback_seqno", "_r.branch", F.col("_r.seqno").alias("branch_seqno"), at.alias("seqno"), at.alias("snap_start"), at.alias("snap_end"), F.lit(None).cast("bigint").alias("manifest_uid"))


def set_difference(wanted: DataFrame, opened: DataFrame) -> DataFrame:
    """shard, problem: shards wanted and not opened, opened and not wanted, opened twice, or with an end before their start."""
    o = opened.groupBy("shard").agg(F.count("*").alias("n"), F.min(F.when(F.col("end_seqno") < F.col("start_seqno"), F.lit(1))).alias("backwards"))
    both = wanted.select("shard", F.lit(True).alias("w")).join(o, "shard", "full_outer")
    problem = F.when(F.col("n").isNull(), "missing").when(F.col("w").isNull(), "unexpected").when(F.col("n") > 1, "twice").when(F.col("backwards") == 1, "end before start")
    return both.select("shard", problem.alias("problem")).where("problem IS NOT NULL")


def newest_branch(failover: DataFrame) -> DataFrame:
    return failover.groupBy("shard").agg(F.min_by("branch", "pos").alias("branch"))


def finite_scan(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Events up to each shard's frozen end; the ends are at most 65536 rows."""
    return log.join(F.broadcast(ends.select("shard", "end_seqno")), "shard").where(F.col("seqno") <= F.col("end_seqno")).drop("end_seqno")


def high_seqnos(log: DataFrame, collections: list[int] | None = None) -> DataFrame:
    """The high seqno of each shard, of some collections only if given: the largest over them."""
    x = log if collections is None else log.where(F.col("collection_id").isin(*collections))
    return x.groupBy("shard").agg(F.max("seqno").alias("high_seqno"))


ROLLBACK_TRIES = 16


def next_rollback(tries: int, requested: int, rollback: int) -> None:
    """Guards a rollback loop: at most ROLLBACK_TRIES, each further back."""
    from tidelog.errors import StreamError

    if tries >= ROLLBACK_TRIES:
        raise StreamError("too many rollbacks")
    if rollback >= requested:
        raise StreamError("rollback does not go back")




def chain_problems(answers: DataFrame) -> DataFrame:
    """answers (shard, at, requested, rollback) with `tries` (1 for the first of a shard) and `problem`, as next_rollback() has it."""
    x = answers.withColumn("tries", F.row_number().over(Window.partitionBy("shard").orderBy("at")))
    return x.withColumn("problem", F.when(F.col("tries") > ROLLBACK_TRIES, "too many").when(F.col("rollback") >= F.col("requested"), "does not go back"))


def invalid_requests(requests: DataFrame) -> DataFrame:
    """shard, problem: stream requests (shard, seqno, snap_start, snap_end, end_seqno) that cannot be opened; no request at all is a row without a shard."""
    own = requests.select("shard", F.coalesce(invariant_broken(), F.when(F.col("seqno") > F.col("end_seqno"), "start after stream end")).alias("problem")).where("problem IS NOT NULL")
    twice = requests.groupBy("shard").count().where("count > 1").select("shard", F.lit("requested twice").alias("problem"))
    none = requests.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("int").alias("shard"), F.lit("no request").alias("problem"))
    return own.union(twice).union(none)


def open_report(starts: DataFrame, failover: DataFrame) -> DataFrame:
    """shard, branch, start_seqno, end_seqno, requested, rolled_back_to: the streams as opened, each with the rewind it needed (null if none)."""
    needed = starts.where("rollback_to IS NOT NULL").select("shard", F.col("rollback_to").alias("rollback_seqno"))
    back = rewind(needed, failover).select("shard", F.col("branch").alias("_branch"), F.col("seqno").alias("_at"))
    x = starts.join(F.broadcast(back), "shard", "left")  # at most 65536
    moved = F.col("_at").isNotNull()
    return x.select("shard", F.coalesce("_branch", "branch").alias("branch"), F.coalesce("_at", "start_seqno").alias("start_seqno"), "end_seqno", F.when(moved, F.col("start_seqno")).alias("requested"), F.col("_at").alias("rolled_back_to"))
