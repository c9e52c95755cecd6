"""Counters and health of a running subscription."""

from __future__ import annotations

import time
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidelog.operators import metrics

_MOST = (1 << 64) - 1
FIELDS = (*metrics.OUTSIDE, "delivered_events", *metrics.BY_KIND.values(), "processed_events", "unknown_frames", "stream_errors", "stale_generation_drops", "rollbacks", "rollback_mitigation_delays", "rollback_mitigation_failures")


class Monitor:
    """The 25 counters and gauges, which saturate, and a health of starting, healthy, degraded or stopped."""

    def __init__(self):
        self.counters = dict.fromkeys(FIELDS, 0)
        self.status, self.consecutive_failures, self.topology_generation = "starting", 0, 0
        self.last_check: float | None = None
        self.message: str | None = None

    def add(self, **counts: int) -> None:
        for k, n in counts.items():
            self.counters[k] = min(self.counters[k] + n, _MOST)

    def set(self, **gauges: int) -> None:
        if wrong := set(gauges) - set(metrics.GAUGES):
            raise KeyError(f"no such gauges: {sorted(wrong)}")
        self.counters |= gauges

    def succeeded(self, at: float | None = None, generation: int | None = None) -> None:
        self.status, self.consecutive_failures, self.message = "healthy", 0, None
        self.last_check = time.time() if at is None else at
        self.topology_generation = self.topology_generation if generation is None else generation

    def failed(self, message: str, at: float | None = None) -> None:
        self.status, self.message = "degraded", message
        self.consecutive_failures = min(self.consecutive_failures + 1, _MOST)
        self.last_check = time.time() if at is None else at

    def stopped(self, at: float | None = None) -> None:
        self.status, self.message = "stopped", "client stopped"
        self.last_check = time.time() if at is None else at
        self.counters["active_connections"] = 0

    def count(self, rows: DataFrame, held: Column) -> None:
        """Adds what a micro-batch delivered, processed and holds. held: which rows wait for the first time."""
        of_log = rows.select("kind", "delivered", ((F.col("delivered") | F.col("acked")) & F.col("seqno").isNotNull()).alias("acked"), held.alias("held"), F.lit(False).alias("stale"), F.lit(None).cast("string").alias("failed"))
        self.add(**{k: v for k, v in metrics.snapshot(of_log).first().asDict().items() if k not in metrics.OUTSIDE and k != "rollbacks"})

    def families(self, spark: SparkSession) -> DataFrame:
        """Every exported family, as metrics.all_families has them."""
        row = spark.createDataFrame([tuple(Decimal(self.counters[k]) for k in FIELDS)], ", ".join(f"{k} decimal(20,0)" for k in FIELDS))
        return metrics.all_families(row, self.status, self.consecutive_failures, self.topology_generation, self.last_check or 0.0)


class Watch(StreamingQueryListener):
    """Tells a monitor how a query goes on: every progress is a success, an end with an exception a failure."""

    def __init__(self, spark: SparkSession, monitor: Monitor):
        self.spark, self.monitor, self.run_id = spark, monitor, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.run_id is not None and str(event.progress.runId) == self.run_id and self.monitor.status in ("starting", "healthy"):
            self.monitor.succeeded()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.run_id is not None and str(event.runId) == self.run_id and event.exception is not None and self.monitor.status != "degraded":
            self.monitor.failed(event.exception.splitlines()[0])
