"""Persistence gate: events wait until every copy of their shard has persisted them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators import order


def observation_plan(routes: DataFrame) -> DataFrame:
    """shard, node for every distinct node that holds a copy, and expected_copies. routes: shard, active, replicas (array)."""
    nodes = F.array_distinct(F.filter(F.concat(F.array("active"), F.coalesce("replicas", F.array().cast("array<string>"))), lambda n: n.isNotNull()))
    return routes.select("shard", nodes.alias("nodes")).select("shard", F.size("nodes").alias("expected_copies"), F.explode("nodes").alias("node"))


def outcomes(observations: DataFrame, expected: DataFrame) -> DataFrame:
    """cycle, shard, outcome, persisted per polling cycle.

    A changed branch comes first, then an incomplete set of copies, then a failed
    or inconsistent answer; else the least persisted seqno. expected: cycle, shard,
    branch, copies; a shard without answers is incomplete.
    """
    e = expected.select("cycle", "shard", F.col("branch").alias("want"), "copies")
    x = e.join(observations, ["cycle", "shard"], "left")
    there = F.col("node").isNotNull()
    ok = there & F.coalesce("ok", F.lit(False))
    changed = ok & (F.coalesce("did_failover", F.lit(False)) | ~F.col("branch").eqNullSafe(F.col("want")))
    bad = there & (~ok | ~F.col("obs_shard").eqNullSafe(F.col("shard")) | (F.col("persisted") > F.col("current")))
    g = x.groupBy("cycle", "shard").agg(
        F.count(F.when(there, 1)).alias("n"), F.max("copies").alias("copies"), F.max(changed.cast("int")).alias("changed"), F.max(bad.cast("int")).alias("bad"), F.min("persisted").alias("least"), F.max("want").alias("branch")
    )
    outcome = F.when(F.col("changed") == 1, "branch_changed").when(F.col("n") != F.col("copies"), "incomplete").when(F.col("bad") == 1, "transient").otherwise("persisted")
    return g.select("cycle", "shard", outcome.alias("outcome"), F.when(outcome == "persisted", F.col("least")).alias("persisted"))


def watermarks(outcome: DataFrame) -> DataFrame:
    """shard, watermark after all cycles, in order.

    Incomplete and transient cycles keep it; a changed branch or a seqno below it
    clears it; a later observation sets it afresh. A fold over the cycles since the
    log's start, read in batches.
    """

    def step(state: tuple, rows: pd.DataFrame) -> tuple:
        (w,) = state
        for outcome, persisted in zip(rows["outcome"], rows["text"]):
            if outcome in ("incomplete", "transient"):
                continue
            p = None if persisted is None else int(persisted)
            lost = outcome == "branch_changed" or (outcome == "persisted" and None not in (w, p) and p < w)
            w = None if lost else p
        return (w,)

    # as text: pandas would make floats of a column with nulls
    rows = outcome.select("shard", "cycle", "outcome", "persisted", F.col("persisted").cast("string").alias("text"))
    out = order.fold_shards(rows, ["cycle", "outcome", "persisted"], step, (None,), lambda s: (s[0] if s[0] is None else str(s[0]),), f"shard {outcome.schema['shard'].dataType.simpleString()}, watermark string")
    return out.select("shard", F.col("watermark").cast("bigint").alias("watermark"))


def hold_unsafe(log: DataFrame, marks: DataFrame) -> DataFrame:
    """log with `delivered`: whether the row and all before it in its shard are persisted.

    Markers wait for their start, events for their seqno; other rows don't wait.
    Only the shard of a held row waits. marks has a row per shard, at most 65536.
    """
    at = F.when(F.col("kind") == "snapshot_marker", F.col("snap_start")).otherwise(F.col("seqno"))
    x = log.join(F.broadcast(marks.select("shard", "watermark")), "shard", "left")
    safe = at.isNull() | (at == 0) | F.coalesce(at <= F.col("watermark"), F.lit(False))
    w = Window.partitionBy("shard").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumn("delivered", F.min(safe.cast("int")).over(w) == 1).drop("watermark")
