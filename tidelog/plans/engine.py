"""The subscription: stages in their order, batch and stream, with durable checkpoints after each sink write."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.config import Config
from tidelog.errors import CheckpointError, CollectionError, InvalidConfiguration, PersistenceError, RollbackRequired, StreamError, TimedOut
from tidelog.functions.columns import before_cutoff
from tidelog.operators import ack, collections, gate, order, rollback
from tidelog.schema import DOCUMENTS
from tidelog.sources import checkpoints as stores
from tidelog.sources import files
from tidelog.streaming import monitor as monitoring


def stages(log: DataFrame, config: Config, marks: DataFrame | None = None, dim: DataFrame | None = None, starts: DataFrame | None = None) -> DataFrame:
    """order -> gate -> cutoff -> names -> manifest; rows carry violation, unreached, delivered and acked.

    The order of the stages is part of the meaning: a held row is not filtered,
    and a skipped row needs no known collection. acked: passed over by the cutoff.
    A row is delivered or acked only if all rows before it in its shard are.
    starts (shard, start_seqno, end_seqno): where each shard's stream begins and ends.
    """
    if starts is None:
        x = order.check_order(log)
    else:
        at = F.broadcast(starts.select("shard", F.col("start_seqno").alias("_start"), F.col("end_seqno").alias("_stop")))  # at most 65536 shards
        x = order.check_order(log.join(at, "shard", "left"), "_start", "_stop").drop("_start", "_stop")
    return passed(x, config, marks, dim)


def passed(x: DataFrame, config: Config, marks: DataFrame | None, dim: DataFrame | None) -> DataFrame:
    """The stages after the order check."""
    reached = ~F.col("unreached") & F.col("violation").isNull()
    if marks is not None and config.mitigation.enabled:
        x = gate.hold_unsafe(x, marks).withColumnRenamed("delivered", "_safe")
        reached = reached & F.col("_safe")
    x = x.withColumns({"delivered": reached & ~_skipped(config), "acked": reached & _skipped(config)}).drop("_safe")
    if "manifest_uid" in x.columns:
        x = ack.carry_manifest(x)
    if dim is None:
        return x
    if {"sys_kind", "manifest_uid", "scope_id", "key"} <= set(x.columns):
        x = collections.decorate_by_log(x, dim)
    else:
        x = collections.decorate(x, dim, strict=False)
    lost = F.col("delivered") & F.col("collection_id").isNotNull() & F.col("collection_name").isNull() & F.col("kind").isin(*DOCUMENTS)
    x = order.stop_after(x.withColumn("violation", F.coalesce("violation", F.when(lost, "unmapped_collection"))))
    reached = ~F.col("unreached") & F.col("violation").isNull()
    return x.withColumns({"delivered": F.col("delivered") & reached, "acked": F.col("acked") & reached})


def _skipped(config: Config) -> Column:
    """Whether the cutoff passes over a row; a document without a time is not skipped."""
    if config.skip_until_ns is None:
        return F.lit(False)
    return F.coalesce(before_cutoff(F.col("kind"), F.col("cas"), config.skip_until_ns), F.lit(False))


class Subscription:
    """A running stream and its progress."""

    def __init__(self, engine: Engine, query: StreamingQuery, again: Callable[[], None], ends: dict[int, int]):
        self.engine, self.query, self._again, self.ends = engine, query, again, ends

    def drain(self) -> None:
        """Looks at held rows again, as new marks may have come without new events; it waits for a micro-batch that runs."""
        self._again()

    def wait(self, timeout_s: float | None = None) -> None:
        """Until the stream ends and the gate holds nothing, looking at held rows every poll interval.

        The stream's own error is raised as it is named by its stage; held rows that
        wait longer than the stall time, or whose branch has changed, fail the wait; so
        does a finite stream that ends before its shards' ends.
        """
        engine, until = self.engine, None if timeout_s is None else time.monotonic() + timeout_s
        while True:
            try:
                ended = self.query.awaitTermination(max(0.05, engine.config.mitigation.poll_s))
            except StreamingQueryException:
                ended = True
            self._raise_failed()
            if engine.holding:
                self.drain()
            if ended and not engine.holding:
                break
            if until is not None and time.monotonic() >= until:
                raise TimedOut(f"the stream has not ended in {timeout_s} s")
        self._raise_short()

    def _raise_failed(self) -> None:
        if self.engine.failure is not None:
            raise self.engine.failure
        failed = self.query.exception()
        if failed is not None:
            raise StreamError(str(failed))

    def short(self) -> dict[int, tuple[int, int]]:
        """Shards of a finite stream that is at its end: processed seqno and the end that was not reached."""
        done = {s: c["seqno"] for s, c in self.engine.processed.items()}
        return {s: (done.get(s, 0), e) for s, e in self.ends.items() if done.get(s, 0) < e and s not in self.engine.closed}

    def _raise_short(self) -> None:
        if short := self.short():
            shard, (at, end) = min(short.items())
            raise StreamError(f"shard {shard} ended at {at} of {end} ({len(short)} shards fell short)")

    def close_shard(self, shard: int) -> None:
        self.engine.close_shard(shard)

    def flush(self) -> int:
        return self.engine.flush()

    def statuses(self) -> dict[int, dict]:
        """Per shard: processed and durable seqno, whether they differ in anything, and what stopped it (else None)."""
        return self.engine.statuses()

    def close(self) -> None:
        """Stops and flushes; the stream's own error comes before one of the flush. A finite stream that had ended must have reached its ends."""
        ended = not self.query.isActive
        self.query.stop()
        try:
            self.flush()
        finally:
            self.engine.subscription = None
            self.engine.spark.streams.removeListener(self.engine._watch)
            self.engine.monitor.stopped()
            self._raise_failed()
        if ended and self.engine.config.mode == "finite":
            self._raise_short()


class Engine:
    """handler(shard, requested, rollback, failover log) answers stop_and_report or rewind_and_replay; only the policy `delegate` asks it."""

    def __init__(self, spark: SparkSession, config: Config, store: stores.CheckpointStore | None = None, handler: Callable[[int, int, int, list], str] | None = None):
        if config.rollback_policy == "delegate" and handler is None:
            raise InvalidConfiguration("the rollback policy delegate needs a handler")
        self.handler = handler
        self.spark, self.config, self.store = spark, config, store or stores.NoopStore()
        self.generation, self.processed, self.durable = 1, {}, {}
        self.rollbacks: list[tuple[int, int, int]] = []
        self._tries: dict[int, int] = {}
        self._flushed_at = time.monotonic()
        self.subscription: Subscription | None = None
        #: What ended the stream, what stopped a shard, and how many rows the gate holds.
        self.failure: Exception | None = None
        self.stopped: dict[int, str] = {}
        self.holding = 0
        self.closed: set[int] = set()
        #: Counters and health, as long as the engine lives.
        self.monitor = monitoring.Monitor()
        self._watch = monitoring.Watch(spark, self.monitor)
        self._busy = threading.RLock()

    @property
    def _uuid(self) -> str:
        return self.config.bucket_uuid or "-"

    def starts(self, shards: list[int], highs: DataFrame, failover: DataFrame) -> DataFrame:
        """The start of each shard; a checkpoint that needs a rollback is treated by the policy.

        The engine's progress begins there: the next flush saves starts that the store
        doesn't have, also those at 0.
        """
        stored = stores.load_checked(self.store, self._uuid, shards)
        found = stored if self.config.start_from == "checkpoint" else {}
        s = self.spark
        given = s.createDataFrame([(x["shard"], x["branch"], x["seqno"], x["snap_start"], x["snap_end"], x["manifest_uid"]) for x in found.values()], "shard int, branch bigint, seqno bigint, snap_start bigint, snap_end bigint, manifest_uid bigint")
        assigned = s.createDataFrame([(x,) for x in shards], "shard int")
        fallback = "earliest" if self.config.start_from == "checkpoint" else self.config.start_from
        starts = rollback.resolve_starts(rollback.initial_starts(assigned, given, fallback), highs, rollback.newest_branch(failover), self.config.mode == "finite", self.config.bucket_uuid)
        back = self._allowed(starts.where("rollback_to IS NOT NULL").select("shard", "start_seqno", F.col("rollback_to").alias("rollback_seqno")), failover)
        if back is not None:
            back = back.select("shard", F.col("seqno").alias("_at"), F.col("branch").alias("_branch"))
            x = starts.join(F.broadcast(back), "shard", "left")
            moved = {c: F.coalesce("_at", c) for c in ("start_seqno", "snap_start", "snap_end")}
            starts = x.withColumns(moved | {"branch": F.coalesce("_branch", "branch"), "manifest_uid": F.when(F.col("_at").isNull(), F.col("manifest_uid"))}).drop("_at", "_branch")
        rows = starts.collect()  # a row per shard, at most 65536
        if bad := [r["shard"] for r in rows if r["invalid"] is not None or (r["end_seqno"] is not None and r["start_seqno"] > r["end_seqno"])]:
            raise CheckpointError(f"invalid start of shards {bad[:10]}")
        self.durable = dict(stored)
        self.processed = {r["shard"]: {"bucket_uuid": self._uuid, "branch": int(r["branch"] or 0), "manifest_uid": r["manifest_uid"], "shard": r["shard"], "seqno": r["start_seqno"], "snap_start": r["snap_start"], "snap_end": r["snap_end"]} for r in rows}
        return starts

    def _allowed(self, needed: DataFrame, failover: DataFrame) -> DataFrame | None:
        """What rollbacks (shard, start_seqno, rollback_seqno) go back to under the policy, or None without any; each is guarded and remembered."""
        asked = needed.orderBy("shard").collect()  # at most 65536
        if not asked:
            return None
        policy, logs = self.config.rollback_policy, {}
        if policy != "rewind_and_replay":
            for r in failover.join(F.broadcast(needed.select("shard")), "shard").orderBy("pos").select("shard", "branch", "seqno").collect():
                logs.setdefault(r["shard"], []).append((r["branch"], r["seqno"]))
        for r in asked:
            case = r["shard"], r["start_seqno"], r["rollback_seqno"], logs.get(r["shard"], [])
            rollback.next_rollback(self._tries.get(r["shard"], 0), r["start_seqno"], r["rollback_seqno"])
            answer = self.handler(*case) if policy == "delegate" else policy
            if answer not in ("stop_and_report", "rewind_and_replay"):
                raise InvalidConfiguration(f"the rollback handler answered {answer!r}")
            if answer == "stop_and_report":
                raise RollbackRequired(*case)
        back = rollback.rewind(needed.select("shard", "rollback_seqno"), failover)
        if lost := [r["shard"] for r in back.where("branch IS NULL").select("shard").collect()]:
            raise StreamError(f"no branch of shards {lost[:10]} began at or before the rollback")
        for r in asked:
            self._tries[r["shard"]] = self._tries.get(r["shard"], 0) + 1
            self.rollbacks.append((r["shard"], r["start_seqno"], r["rollback_seqno"]))
        self.monitor.add(rollbacks=len(asked))
        return back

    def roll_back(self, answers: DataFrame, failover: DataFrame) -> None:
        """Treats a producer's rollback answers (shard, rollback_seqno) by the policy and goes on from there; at most 16 in a row for a shard."""
        now = self.spark.createDataFrame([(s, c["seqno"]) for s, c in self.processed.items()], "shard int, start_seqno bigint")
        back = self._allowed(answers.join(F.broadcast(now), "shard"), failover)
        if back is not None:
            self.rebase([{"bucket_uuid": self._uuid, "manifest_uid": None, **r.asDict(), "branch": int(r["branch"])} for r in back.select("shard", "branch", "seqno", "snap_start", "snap_end").collect()])

    def rebase(self, checkpoints: list[dict]) -> None:
        """Replaces the progress of shards, backwards too: after a reopening or a rollback. All are checked before any is changed."""
        for c in checkpoints:
            if c["shard"] not in self.processed:
                raise CheckpointError(f"shard {c['shard']} is not followed")
            if c["bucket_uuid"] != self._uuid or c["snap_start"] > c["snap_end"] or c["seqno"] > c["snap_end"] or 0 < c["seqno"] < c["snap_start"]:
                raise CheckpointError(f"shard {c['shard']}: invalid checkpoint")
        for c in checkpoints:
            self.durable.setdefault(c["shard"], {})  # known to differ: the flush may go back
            self.processed[c["shard"]] = dict(c)

    def mark_dirty(self, shard: int) -> None:
        """The next flush saves the shard, changed or not."""
        if shard not in self.processed:
            raise CheckpointError(f"shard {shard} is not followed")
        self.durable[shard] = {}

    def statuses(self) -> dict[int, dict]:
        none = {"seqno": 0}
        return {
            s: {"processed": self.processed.get(s, none)["seqno"], "durable": self.durable.get(s, {}).get("seqno"), "dirty": s in self.processed and self.durable.get(s) != self.processed[s], "stopped": self.stopped.get(s)}
            for s in sorted({*self.processed, *self.stopped})
        }

    def open_report(self) -> DataFrame:
        """shard, branch, start_seqno, and the rollback applied last before (requested, rolled_back_to), of the followed shards."""
        last = {s: (a, b) for s, a, b in self.rollbacks}
        rows = [(s, c["branch"], c["seqno"], *last.get(s, (None, None))) for s, c in self.processed.items()]
        return self.spark.createDataFrame(rows, "shard int, branch bigint, start_seqno bigint, requested bigint, rolled_back_to bigint")

    def source(self, path: str, dim: DataFrame | None = None, starts: DataFrame | None = None, streaming: bool = False, **options) -> DataFrame:
        """The log under path from each shard's start, of the configured collections if a manifest is given; all pushed to the scan."""
        ids = None
        if dim is not None:
            scope, ids = collections.resolve(dim, self.config.selection.scope, self.config.selection.collections)
            ids = ids or [r[0] for r in dim.where((F.col("scope_id") == scope) & F.col("collection_id").isNotNull()).select("collection_id").collect()]
        return (files.stream if streaming else files.scan)(self.spark, path, starts, None, ids, **options)

    def run_batch(self, log: DataFrame, sink: Callable[[DataFrame], None], marks: DataFrame | None = None, dim: DataFrame | None = None, starts: DataFrame | None = None, strict: bool = True) -> DataFrame:
        """One finite run: stages, sink of what is delivered, then the progress of each shard is recorded and flushed.

        Progress ends before the first row of a shard that was neither delivered nor
        skipped, so a held row or one after a violation comes again after a restart.
        strict: violations are raised after that; else they are labels of the rows only.
        """
        x = stages(log, self.config, marks, dim, starts)
        sink(x.where("delivered"))
        self.record(x.where("seqno IS NOT NULL AND (delivered OR acked)"))
        self.flush()
        if error := self._violations(x):
            if strict:
                raise error
        return x

    def _violations(self, x: DataFrame) -> Exception | None:
        """Notes what stopped shards, a row per shard, and gives the error of the first."""
        found = x.where("violation IS NOT NULL AND NOT unreached").select("shard", "arrival", "violation", "seqno", "collection_id" if "collection_id" in x.columns else F.lit(None).alias("collection_id")).orderBy("shard").collect()
        self.stopped |= {r["shard"]: r["violation"] for r in found}
        if not found:
            return None
        r = found[0]
        if r["violation"] == "unmapped_collection":
            return CollectionError(f"shard {r['shard']}: unmapped_collection {r['collection_id']}")
        return StreamError(f"shard {r['shard']}: {r['violation']} at arrival {r['arrival']}, seqno {r['seqno']} ({len(found)} shards stopped)")

    def record(self, done: DataFrame) -> None:
        """The last seqno, snapshot and manifest of each shard in a batch that its sink has taken: a row per shard. Progress never goes back."""
        manifest = F.col("checkpoint_manifest") if "checkpoint_manifest" in done.columns else F.lit(None).cast("bigint")
        last = done.groupBy("shard").agg(F.max(F.struct("seqno", "snap_start", "snap_end", manifest.alias("manifest_uid"))).alias("c")).select("shard", "c.*").collect()
        for r in last:
            if r["seqno"] < self.processed.get(r["shard"], {"seqno": 0})["seqno"]:
                raise CheckpointError(f"shard {r['shard']} cannot go back from {self.processed[r['shard']]['seqno']} to {r['seqno']}")
        for r in last:
            before = self.processed.get(r["shard"], {})
            uid = before.get("manifest_uid") if r["manifest_uid"] is None else r["manifest_uid"]
            self.processed[r["shard"]] = {"bucket_uuid": self._uuid, "branch": before.get("branch", 0), **r.asDict(), "manifest_uid": uid}
            self._tries.pop(r["shard"], None)

    def flush(self) -> int:
        """Saves the checkpoints that changed since the last save; on failure all stay to be saved. A stored seqno that this engine never saw is not gone back from."""
        changed = [c for s, c in self.processed.items() if self.durable.get(s) != c]
        unseen = [c["shard"] for c in changed if c["shard"] not in self.durable]
        if unseen and self.store.writes:
            for s, c in self.store.load(self._uuid, unseen).items():
                if c["seqno"] > self.processed[s]["seqno"]:
                    raise CheckpointError(f"the store has shard {s} at {c['seqno']}, this run at {self.processed[s]['seqno']}")
        if changed:
            self.store.save(changed)
            self.durable.update({c["shard"]: dict(c) for c in changed})
        self._flushed_at = time.monotonic()
        return len(changed)

    def _flush_if_due(self) -> None:
        plan = self.config.checkpointing
        if plan.automatic and (self.config.mode == "finite" or time.monotonic() - self._flushed_at >= plan.interval_s):
            self.flush()

    def subscribe(self, stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint_dir: str, marks: Callable[[], DataFrame] | DataFrame | None = None, dim: DataFrame | None = None, starts: DataFrame | None = None, opened: DataFrame | None = None, **trigger) -> Subscription:
        """One subscription at a time. The same stages as run_batch on each micro-batch: sink, then record and flush: at least once, in order by shard.

        marks (shard, watermark, and if known changed and error) is asked for at each
        micro-batch. Rows that the gate holds are kept beside the stream's checkpoint and
        come again with the next micro-batch, on drain() or while wait() waits; after the
        stall time, or where `changed`, they fail the stream. A violation of order or a
        document of an unknown collection fails it too. In any case what lies before is
        delivered and recorded first. opened (shard, stream_id, opaque): rows of other
        streams than the open ones are violations as well.
        """
        from tidelog.streaming import held as carried

        if self.subscription is not None:
            raise StreamError("the engine has a subscription already")
        base = checkpoint_dir.rstrip("/")
        held = carried.HeldRows(self.spark, f"{base}-held") if marks is not None and self.config.mitigation.enabled else None
        ordered = carried.CarriedOrder(self.spark, f"{base}-order", starts, opened)
        self.failure, self.holding, self.stopped, self.closed = None, 0, {}, set()
        self._ended = lambda shard: sink(self._stream_end(stream, shard), -1)

        def take(new: DataFrame | None, epoch: int) -> None:
            with self._busy:
                try:
                    deliver(new, epoch)
                except Exception as e:
                    self.failure = e
                    self.monitor.failed(str(e))
                    self.monitor.add(**{"rollback_mitigation_failures" if isinstance(e, PersistenceError) else "stream_errors": 1})
                    raise

        def deliver(new: DataFrame | None, epoch: int) -> None:
            began, open_ = time.time(), ~F.col("shard").isin(*self.closed)
            new = new.where(open_) if new is not None and self.closed else new
            labelled = ordered.labelled(new, epoch).persist() if new is not None else None
            x = labelled.where("violation IS NULL AND NOT unreached") if labelled is not None else None
            if held is not None:
                x = held.with_new(x, epoch)
            if x is None:
                return
            x = x.where(open_) if self.closed else x
            at = marks() if callable(marks) else marks
            x = passed(self._with_manifests(x), self.config, at, dim).persist()
            try:
                sink(x.where("delivered").drop("_before", "_since"), epoch)
                if held is not None:
                    waiting = x.where("NOT delivered AND NOT acked AND violation IS NULL AND NOT unreached")
                    held.keep(waiting, epoch)
                if labelled is not None:
                    ordered.keep(labelled, epoch)
                self.record(x.where("seqno IS NOT NULL AND (delivered OR acked)"))
                waits = ~F.col("delivered") & ~F.col("acked") & (F.col("_since") >= began) if held is not None else F.lit(False)
                self.monitor.count(x, waits & F.col("violation").isNull() & ~F.col("unreached"))
                self._flush_if_due()
                stalled = self._stalled(waiting, at) if held is not None else None
                wrong = self._violations(x) or (self._violations(labelled) if labelled is not None else None)
                if error := wrong or stalled:
                    raise error
            finally:
                x.unpersist()
                if labelled is not None:
                    labelled.unpersist()

        trigger = trigger or ({"availableNow": True} if self.config.mode == "finite" else {"processingTime": "1 second"})
        ends = {r["shard"]: r["end_seqno"] for r in starts.where("end_seqno > start_seqno").select("shard", "end_seqno").collect()} if starts is not None else {}
        self.monitor.add(bootstrap_attempts=1)
        self.monitor.set(assigned_shards=starts.count() if starts is not None else 0, active_connections=1)
        self.spark.streams.addListener(self._watch)
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir).trigger(**trigger).start()
        self._watch.run_id = str(query.runId)
        self.monitor.add(bootstrap_successes=1)
        self.subscription = Subscription(self, query, lambda: take(None, -1), ends)
        return self.subscription

    def close_shard(self, shard: int) -> None:
        """Ends one shard of the running subscription: its rows, held ones too, are passed over from now on, and the sink gets a stream end of the reason `closed`. Its progress stays."""
        with self._busy:
            if self.subscription is None or shard in self.closed or shard in self.stopped or shard not in {*self.processed, *self.subscription.ends}:
                raise StreamError(f"shard {shard}: cannot close a stream that is not active")
            self.closed.add(shard)
            self._ended(shard)
            self.monitor.add(delivered_events=1, stream_ends=1)

    def _stream_end(self, stream: DataFrame, shard: int) -> DataFrame:
        """The row that stands for the end of a closed shard, with the columns of the stream and its labels."""
        given = {"shard": shard, "kind": "stream_end", "end_reason": "closed"}
        row = self.spark.range(1).select(*[F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in stream.schema.fields])
        return row.withColumns({"violation": F.lit(None).cast("string"), "unreached": F.lit(False), "delivered": F.lit(True), "acked": F.lit(False)})

    def _stalled(self, waiting: DataFrame, marks: DataFrame) -> PersistenceError | None:
        """Counts what the gate holds; an error if a held shard's branch has changed, or if one has waited longer than the stall time."""
        known = [c for c in ("changed", "error") if c in marks.columns]
        first = waiting.groupBy("shard").agg(F.count("*").alias("n"), F.min("_since").alias("since"), F.min("seqno").alias("seqno"))
        rows = first.join(F.broadcast(marks.select("shard", *known)), "shard", "left").orderBy("shard").collect()  # a row per shard
        self.holding = sum(r["n"] for r in rows)
        limit = self.config.mitigation.stall_s
        for r in rows:
            said = r.asDict()
            if said.get("changed"):
                return PersistenceError(f"shard {r['shard']}: the branch has changed while seqno {r['seqno']} was waiting")
            if time.time() - r["since"] > limit:
                return PersistenceError(f"shard {r['shard']}: not safe within {limit} s: {said.get('error') or f'the persisted seqno did not reach {r.seqno}'}")
        return None

    def _with_manifests(self, x: DataFrame) -> DataFrame:
        """x with the manifest that each shard had before the batch, as `_before`."""
        if "manifest_uid" not in x.columns:
            return x
        known = [(s, c["manifest_uid"]) for s, c in self.processed.items() if c.get("manifest_uid") is not None]
        return x.drop("_before").join(F.broadcast(self.spark.createDataFrame(known, "shard int, _before bigint")), "shard", "left")

    def reopen(self) -> int:
        """A new connection generation: progress stays, rows of older generations are stale."""
        self.generation += 1
        self.monitor.add(reconnects=1)
        return self.generation
