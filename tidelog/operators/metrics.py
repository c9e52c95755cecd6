"""Metrics and health as DataFrames."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.order import fold_shards
from tidelog.schema import KINDS


def kind_counts(log: DataFrame) -> DataFrame:
    """kind, events: one partial aggregation, kinds without events as 0."""
    spark = log.sparkSession
    all_ = spark.createDataFrame([(k,) for k in KINDS], "kind string")
    n = log.groupBy("kind").agg(F.count("*").alias("n"))
    return all_.join(F.broadcast(n), "kind", "left").select("kind", F.coalesce("n", F.lit(0)).alias("events"))


def families(log: DataFrame, status: str = "healthy", prefix: str = "changelog") -> DataFrame:
    """name, label, value: counters by kind and a one-hot status gauge, long form."""
    c = kind_counts(log)
    spark = log.sparkSession
    kinds = c.select(F.lit(f"{prefix}_events_total").alias("name"), F.col("kind").alias("label"), F.col("events").cast("double").alias("value"))
    total = c.agg(F.sum("events").cast("double").alias("value")).select(F.lit(f"{prefix}_delivered_total").alias("name"), F.lit("").alias("label"), "value")
    states = spark.createDataFrame([(f"{prefix}_health_status", s, float(s == status)) for s in ("starting", "healthy", "degraded", "stopped")], "name string, label string, value double")
    return kinds.union(total).union(states)


def render_text(rows: list) -> str:
    """The long form as exposition text."""
    return "".join(f"{r['name']}{{kind=\"{r['label']}\"}} {r['value']:g}\n" if r["label"] else f"{r['name']} {r['value']:g}\n" for r in rows)


def credit_threshold(buffer_bytes: int, ratio: float) -> int:
    """Bytes after which credit is given back; the ratio is a 32-bit float."""
    return max(1, int(np.ceil(np.float64(buffer_bytes) * np.float64(np.float32(ratio)))))


def flow_credit(frames: DataFrame, threshold: int) -> DataFrame:
    """shard, flushes, flushed, remainder: credit given back over frames (shard, arrival, wire_size), and what is left at the end.

    Reset on reaching the threshold is a fold in order: a shard's frames are sorted
    and come in batches, only the fold's state is kept.
    """

    def step(state: tuple, rows: pd.DataFrame) -> tuple:
        pending, flushes, flushed = state
        total = np.cumsum(rows["wire_size"].to_numpy(np.int64))
        start, base = 0, -pending  # pending at row i is total[i] - base
        while (i := max(start, int(np.searchsorted(total, base + threshold)))) < len(total):
            flushes, flushed, start, base = flushes + 1, flushed + int(total[i]) - base, i + 1, int(total[i])
        return int(total[-1]) - base, flushes, flushed

    out = "shard {}, flushes bigint, flushed bigint, remainder bigint".format(frames.schema["shard"].dataType.simpleString())
    rows = frames.select("shard", "arrival", F.col("wire_size").cast("bigint").alias("wire_size"))
    return fold_shards(rows, ["arrival", "wire_size"], step, (0, 0, 0), lambda s: (s[1], s[2], s[0]), out)


def health_runs(probes: DataFrame) -> DataFrame:
    """probes (target, at, ok) with consecutive failures up to each and the status: healthy after a success, else degraded."""
    w = Window.partitionBy("target").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    x = probes.withColumn("_island", F.sum(F.col("ok").cast("int")).over(w))
    run = Window.partitionBy("target", "_island").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    fails = F.sum((~F.col("ok")).cast("bigint")).over(run)
    return x.select("target", "at", "ok", fails.alias("consecutive_failures"), F.when(F.col("ok"), "healthy").otherwise("degraded").alias("status"))


#: The snapshot's fields: counters that come from outside the log, those of the log by kind, and the rest of the log's.
OUTSIDE = ("bootstrap_attempts", "bootstrap_successes", "bootstrap_failures", "topology_updates", "reconnects", "health_checks", "health_failures", "active_connections", "assigned_shards")
BY_KIND = {"mutation": "mutations", "deletion": "deletions", "expiration": "expirations", "snapshot_marker": "snapshot_markers", "seqno_advanced": "seqno_advanced_events", "system_event": "system_events", "stream_end": "stream_ends", "oso_snapshot": "oso_snapshots"}
GAUGES = ("active_connections", "assigned_shards")


def snapshot(log: DataFrame, outside: dict[str, int] | None = None, rollbacks: int = 0) -> DataFrame:
    """One row with the 25 counters and gauges of a run over a labelled log (kind, delivered, acked, held, stale, failed).

    Delivered rows count by kind; acked ones as processed; unknown kinds as unknown
    frames; held ones as delays of the gate, stale ones as drops of the generation
    fence, failed (a label or null) as stream errors, those of the gate by themselves.
    What doesn't come from the log is given. One partial aggregation.
    """
    given = dict(outside or {})
    n = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    sent, known = F.col("delivered") & ~F.col("stale"), F.col("kind").isin(*KINDS)
    fields = {k: F.lit(given.pop(k, 0)).cast("bigint") for k in OUTSIDE}
    fields |= {"delivered_events": n(sent & known)} | {name: n(sent & (F.col("kind") == kind)) for kind, name in BY_KIND.items()}
    fields |= {
        "processed_events": n(F.col("acked") & ~F.col("stale")), "unknown_frames": n(~known), "stream_errors": n(F.coalesce(F.col("failed") != "mitigation", F.lit(False))), "stale_generation_drops": n(F.col("stale")),
        "rollbacks": F.lit(min(rollbacks, 2**63 - 1)).cast("bigint"), "rollback_mitigation_delays": n(F.col("held")), "rollback_mitigation_failures": n(F.coalesce(F.col("failed") == "mitigation", F.lit(False))),
    }
    if given:
        raise KeyError(f"no such counters: {sorted(given)}")
    return log.agg(*[c.alias(k) for k, c in fields.items()])


def all_families(counters: DataFrame, status: str = "starting", consecutive_failures: int = 0, topology_generation: int = 0, last_check: float = 0.0, prefix: str = "changelog") -> DataFrame:
    """name, label, value: every exported family of a snapshot() row and of the health state, long form."""
    rows = [(f"{prefix}_{k}" + ("" if k in GAUGES else "_total"), "", F.col(k)) for k in counters.columns if k not in BY_KIND.values()]
    rows += [(f"{prefix}_event_deliveries_total", kind, F.col(k)) for kind, k in BY_KIND.items()]
    rows += [(f"{prefix}_health_status", s, F.lit(float(s == status))) for s in ("starting", "healthy", "degraded", "stopped")]
    rows += [(f"{prefix}_health_{k}", "", F.lit(v)) for k, v in (("consecutive_failures", consecutive_failures), ("topology_generation", topology_generation), ("last_check_timestamp_seconds", last_check))]
    made = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(label).alias("label"), v.cast("double").alias("value")) for n, label, v in rows])
    return counters.select(F.explode(made).alias("r")).select("r.*")
