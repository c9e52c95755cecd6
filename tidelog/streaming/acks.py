"""Acknowledgement by event, as a stream: tokens in any order, progress in the order of delivery.

Carried from one micro-batch to the next: the deliveries that are not processed yet, as
versions of a table beside the stream's checkpoint. A token is void once its event is
processed, and a rebase makes all earlier ones void.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.errors import StreamError
from tidelog.streaming.held import Versions

#: at orders a shard's rows. deliver: token and checkpoint of an event; ack: token; rebase: checkpoint.
CONTROL = "shard int, at bigint, action string, token bigint, seqno bigint, snap_start bigint, snap_end bigint, manifest_uid bigint"
#: advanced_to and the rest: the checkpoint that an acknowledgement (or rebase) led to, null if to none. pending: deliveries that wait, after it.
OUTCOME = "shard int, at bigint, action string, token bigint, advanced_to bigint, snap_start bigint, snap_end bigint, manifest_uid bigint, pending bigint, problem string"
_CHECKPOINT = ["seqno", "snap_start", "snap_end", "manifest_uid"]
_PENDING = ["token", *_CHECKPOINT, "acked"]
_NEVER = np.iinfo(np.int64).max
_NAMES = [c.split()[0] for c in CONTROL.split(", ")]
#: A version of what is carried. waits 0: outcomes; 1: deliveries that wait, advanced_to their seqno, pending 1 if their acknowledgement was there.
_VERSION = f"{OUTCOME}, waits int"
#: Rows of a shard that a window takes at once.
BLOCK_ROWS = 500_000
#: A row's place in its shard is its block times _BLOCK and its number there; _LATER is beyond all. (_BLOCK is a power of two, blocks stay below 2^26.)
_BLOCK, _LATER = 2**36, 2**62


def fold(pending: np.ndarray, rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray | None, list]:
    """One run of deliver and ack rows, in order: what still waits, the last checkpoint that was reached, and an outcome per ack.

    For the few rows of one shard, in memory; a stream has settled(), which the tests hold to this.
    pending: a row of _PENDING per waiting delivery. An event is processed when all up
    to it are acknowledged: at the running maximum of the times of acknowledgement.
    """
    when = np.arange(len(rows))
    new = rows["action"].to_numpy() == "deliver"
    items = np.concatenate((pending, np.column_stack([rows[c].to_numpy(np.int64)[new] for c in _PENDING[:-1]] + [np.zeros(new.sum(), np.int64)])))
    given = np.concatenate((np.full(len(pending), -1), when[new]))
    order = np.argsort(items[:, 0], kind="stable")
    tokens = items[order, 0]
    asked = rows["token"].to_numpy(np.int64)[~new]
    at = when[~new]
    spot = np.minimum(np.searchsorted(tokens, asked), max(len(tokens) - 1, 0))
    known = (tokens[spot] == asked) if len(tokens) else np.zeros(len(asked), bool)
    item = order[spot] if len(tokens) else spot
    known &= given[item] < at if len(tokens) else known
    acked = np.where(items[:, 5] == 1, -1, _NEVER)
    np.minimum.at(acked, item[known], at[known])
    done = np.maximum.accumulate(acked) if len(acked) else acked
    known[known] = at[known] <= done[item[known]]  # else it was processed before
    reached = np.searchsorted(done, at, "right")  # deliveries processed up to each ack
    moved = known & (reached > np.searchsorted(done, at, "left"))
    waiting = np.searchsorted(given, at, "right") - reached
    out = [(int(rows["at"].iloc[t]), int(tok), items[r - 1, 1:5].tolist() if m else None, int(w), None if k else "obsolete") for t, tok, m, r, w, k in zip(at, asked, moved, reached, waiting, known)]
    n = int(np.searchsorted(done, _NEVER))
    left = items[n:].copy()
    left[:, 5] = acked[n:] != _NEVER
    return left, items[n - 1, 1:5] if n else None, out


def _dealt(rows: DataFrame) -> DataFrame:
    """rows with their block: stretches of a shard of some BLOCK_ROWS in order, those that waited before new ones."""
    n = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    k, new = n // BLOCK_ROWS + 1, F.col("acked").isNull().cast("bigint")
    if k == 1:
        return rows.withColumn("block", new)
    cuts = rows.groupBy("shard").agg(F.percentile_approx("at", [j / k for j in range(1, k)], 1000).alias("cuts"))
    return rows.join(F.broadcast(cuts), "shard").withColumn("block", new * k + F.size(F.filter("cuts", lambda c: c < F.col("at")))).drop("cuts")


def settled(rows: DataFrame, kept: list[DataFrame] | None = None) -> DataFrame:
    """The outcomes of rows and the deliveries that still wait after them, as _VERSION has both.

    rows: CONTROL with `acked`, null in new rows, else of a delivery that waited before
    them. It is fold() by windows over blocks of a shard; what a block begins with comes from
    a row per block before it, so a task's memory grows neither with a shard's rows nor with
    what waits. A rebase begins a new run. kept: gets the tables that are kept on disk
    as they are read twice, to be let go by the caller; without it they are made twice.
    """
    deliver, ack, rebase = (F.col("action") == a for a in ("deliver", "ack", "rebase"))
    so_far, earlier = (Window.unboundedPreceding, Window.currentRow), (Window.unboundedPreceding, -1)

    def twice(x: DataFrame) -> DataFrame:
        if kept is not None:
            kept.append(x := x.persist(StorageLevel.DISK_ONLY))
        return x

    x = _dealt(rows)
    blocks = Window.partitionBy("shard").orderBy("block").rowsBetween(*earlier)
    n = x.groupBy("shard", "block").agg(F.count_if(deliver).alias("d"), F.count_if(rebase).alias("r"))
    base = n.select("shard", "block", F.coalesce(F.sum("d").over(blocks), F.lit(0)).alias("d"), F.coalesce(F.sum("r").over(blocks), F.lit(0)).alias("r"), F.sum("r").over(Window.partitionBy("shard")).alias("runs"))
    inside = Window.partitionBy("shard", "block").orderBy("at", F.desc("action"), "token").rowsBetween(*so_far)  # of one moment: rebase, deliver, ack
    x = x.join(F.broadcast(base), ["shard", "block"])
    x = x.withColumns({"i": F.col("block") * _BLOCK + F.count(F.lit(1)).over(inside), "given": F.col("d") + F.count_if(deliver).over(inside), "run": F.col("r") + F.count_if(rebase).over(inside)}).drop("d", "r")

    of_token = Window.partitionBy("shard", "run", "token")
    x = x.withColumn("first", F.min(F.when(deliver, F.col("i"))).over(of_token))
    x = x.withColumn("at_first", F.min(F.when(ack & (F.col("i") > F.col("first")), F.col("i"))).over(of_token))
    told = F.when(F.col("acked"), 0).when(F.col("i") == F.col("first"), F.col("at_first"))
    x = twice(x.withColumn("told", F.when(deliver, F.coalesce(told, F.lit(_LATER)))).drop("acked", "at_first"))

    # a delivery is processed when all up to it in its run are acknowledged: it is put there, before the row that did it
    high = x.groupBy("shard", "block").agg(F.max(F.struct("run", F.coalesce("told", F.lit(0)).alias("told"))).alias("h"))
    x = x.join(F.broadcast(high.select("shard", "block", F.max("h").over(blocks).alias("h"))), ["shard", "block"])
    in_run = Window.partitionBy("shard", "block", "run").orderBy("i").rowsBetween(*so_far)
    done = F.greatest(F.max("told").over(in_run), F.when(F.col("h.run") == F.col("run"), F.col("h.told")))
    x = x.withColumn("spot", F.when(deliver, done).otherwise(F.col("i"))).drop("h").where(~deliver | (F.col("spot") < _LATER) | (F.col("run") == F.col("runs")))
    waits = F.col("spot") == _LATER
    x = twice(x.withColumn("block", F.when(waits, F.col("block")).otherwise(F.shiftright("spot", 36))).drop("run", "runs"))

    reached = F.when(~ack & ~waits, F.struct("spot", "i", "given", *_CHECKPOINT))
    last = x.groupBy("shard", "block").agg(F.max(reached).alias("l"))
    x = x.join(F.broadcast(last.select("shard", "block", F.max("l").over(blocks).alias("l"))), ["shard", "block"])
    in_turn = Window.partitionBy("shard", "block").orderBy("spot", ack, "i").rowsBetween(*so_far)
    x = x.withColumn("last", F.coalesce(F.last(reached, ignorenulls=True).over(in_turn), F.col("l"))).where(~deliver | waits)
    moved = F.coalesce(F.col("last.spot") == F.col("i"), F.lit(False))
    known = F.coalesce(F.col("first") < F.col("i"), F.lit(False)) & (moved | F.coalesce(F.col("last.i") < F.col("first"), F.lit(True)))
    seqno, *rest = [F.when(ack & ~moved, None).when(ack, F.col(f"last.{c}")).otherwise(F.col(c)).alias(c) for c in _CHECKPOINT]
    pending = F.when(deliver, (F.col("told") < _LATER).cast("bigint")).otherwise(F.col("given") - F.coalesce("last.given", F.lit(0)))
    return x.select("shard", "at", "action", F.when(~rebase, F.col("token")).alias("token"), seqno.alias("advanced_to"), *rest, pending.alias("pending"), F.when(ack & ~known, "obsolete").alias("problem"), deliver.cast("int").alias("waits"))


def _publish(spark: SparkSession, made: str, out: str, epoch: int) -> None:
    """A micro-batch's outcomes become files of `out` that begin with its number; those of an earlier try at it go first."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(out).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(out))
    for old in fs.globStatus(Path(f"{out}/{epoch}-*")):
        fs.delete(old.getPath(), False)
    for new in fs.globStatus(Path(f"{made}/waits=0/part-*")) or []:
        to = Path(f"{out}/{epoch}-{new.getPath().getName()}")
        if not fs.rename(new.getPath(), to):
            raise StreamError(f"the outcome {to} could not be put in its place")


def run(spark: SparkSession, control: DataFrame, out: str, checkpoint_dir: str) -> None:
    """Follows the control stream, which has a shard's rows in order over micro-batches, to its present end; the outcomes are added to the folder `out`.

    A token that is unknown, processed or void gives the problem `obsolete` and moves
    nothing. Outcomes are there once, also after a restart.
    """
    state = Versions(spark, f"{checkpoint_dir.rstrip('/')}-waiting", _VERSION)

    def take(new: DataFrame, epoch: int) -> None:
        x, before = new.select(*_NAMES, F.lit(None).cast("boolean").alias("acked")), state.before(epoch)
        if before is not None:
            x = x.unionByName(before.where("waits = 1").withColumn("acked", F.col("pending") == 1).withColumnRenamed("advanced_to", "seqno").select(*x.columns))
        kept: list[DataFrame] = []
        try:
            _publish(spark, state.write(settled(x, kept), epoch, "waits"), out, epoch)
        finally:
            for made in kept:
                made.unpersist()

    control.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination()
