"""Order and snapshot checks within a shard (batch form).

All windows share one spec, (shard, arrival), so the log is shuffled and sorted
once. Rows are labelled; nothing stops the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_UP_TO = (Window.unboundedPreceding, 0)
_BEFORE = (Window.unboundedPreceding, -1)


def _spec(until=_UP_TO):
    return Window.partitionBy("shard").orderBy("arrival").rowsBetween(*until)


def attach_snapshot(log: DataFrame, carried: bool = False) -> DataFrame:
    """log with snap_start and snap_end of the last marker at or before each row; carried: else those in c_start and c_end."""
    marker = F.when(F.col("kind") == "snapshot_marker", F.struct("snap_start", "snap_end"))
    snap = F.last(marker, ignorenulls=True).over(_spec())
    if carried:
        snap = F.coalesce(snap, F.when(F.col("c_end").isNotNull(), F.struct(F.col("c_start").alias("snap_start"), F.col("c_end").alias("snap_end"))))
    return log.withColumn("_snap", snap).withColumns({"snap_start": F.col("_snap.snap_start"), "snap_end": F.col("_snap.snap_end")}).drop("_snap")


def check_order(log: DataFrame, start_seqno=None, stream_end=None, carried: bool = False) -> DataFrame:
    """log with the snapshot attached, `violation` and `unreached`.

    start_seqno and stream_end are columns of log (null end: none). Labels, first
    that applies: a marker that ends before the last seqno or beyond the stream's
    end; an event before any marker; one outside its snapshot or beyond the end;
    a seqno not above the last. Rows after a shard's first violation, or after
    its stream end, were not reached. carried: log has what earlier rows of the shard
    left, c_start, c_end, c_last and c_stopped (null for none), which go.
    """
    x = attach_snapshot(log, carried)
    start = F.lit(0) if start_seqno is None else F.coalesce(F.col(start_seqno), F.lit(0))
    if carried:
        start = F.greatest(start, F.coalesce("c_last", F.lit(0)))
    end = F.lit(None).cast("bigint") if stream_end is None else F.col(stream_end)
    prev = F.greatest(start, F.coalesce(F.max("seqno").over(_spec(_BEFORE)), F.lit(0)))
    x = x.withColumns({"_prev": prev, "_end": end})
    marker, event = F.col("kind") == "snapshot_marker", F.col("seqno").isNotNull()
    violation = (
        F.when(marker & (F.col("snap_end") < F.col("_prev")), "marker_behind").when(marker & (F.col("snap_end") > F.col("_end")), "marker_beyond_end")
        .when(event & F.col("snap_end").isNull(), "no_snapshot")
        .when(event & ((F.col("seqno") < F.col("snap_start")) | (F.col("seqno") > F.col("snap_end")) | F.coalesce(F.col("seqno") > F.col("_end"), F.lit(False))), "outside")
        .when(event & (F.col("seqno") <= F.col("_prev")), "non_monotonic")
    )
    x = stop_after(x.withColumn("violation", violation)).drop("_prev", "_end")
    if carried:
        x = x.withColumn("unreached", F.col("unreached") | F.coalesce("c_stopped", F.lit(False))).drop("c_start", "c_end", "c_last", "c_stopped")
    return x


def fence(log: DataFrame, opened: DataFrame) -> DataFrame:
    """log with `fenced`: why a row is not of its shard's open stream, or null.

    opened: shard, stream_id (null: none), opaque of the streams that are open, a row per
    shard, at most 65536. log: stream_id and opaque as they came.
    """
    at = F.broadcast(opened.select("shard", F.col("stream_id").alias("_sid"), F.col("opaque").alias("_opaque"), F.lit(True).alias("_open")))
    why = F.when(F.col("_open").isNull(), "not_open").when(~F.col("opaque").eqNullSafe(F.col("_opaque")), "other_opaque").when(~F.col("stream_id").eqNullSafe(F.col("_sid")), "other_stream")
    return log.join(at, "shard", "left").withColumn("fenced", why).drop("_sid", "_opaque", "_open")


def stop_after(x: DataFrame) -> DataFrame:
    """x with `unreached`: rows after a shard's first violation or after its stream end."""
    stopped = F.col("violation").isNotNull() | (F.col("kind") == "stream_end")
    before = F.coalesce(F.max(stopped.cast("int")).over(_spec(_BEFORE)), F.lit(0))
    return x.withColumn("unreached", before == 1)


def fold_shards(rows: DataFrame, order: list[str], step, zero, result, schema: str) -> DataFrame:
    """A row per shard: (shard, *result(state)) after step(state, batch) over the shard's rows in order.

    Sorted by Spark, which can spill, and read in batches: memory doesn't grow with a shard.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, shard, state = [c.split()[0] for c in schema.split(", ")], None, None
        done: list[tuple] = []

        def frame() -> pd.DataFrame:
            made = pd.DataFrame(done, columns=names, dtype=object)  # else integers beside nulls would become floats
            done.clear()
            return made

        for b in batches:
            at = b["shard"].to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1), len(b)] if len(b) else [0]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if state is None or at[i] != shard:
                    if state is not None:
                        done.append((shard, *result(state)))
                    shard, state = at[i], zero
                state = step(state, b.iloc[i:j])
            yield frame()
        if state is not None:
            done.append((shard, *result(state)))
            yield frame()

    return rows.repartition("shard").sortWithinPartitions("shard", *order).mapInPandas(run, schema)
