"""Streams with state: acknowledgement by event, sources with offsets, live metrics."""

import dataclasses
import random
import time

import numpy as np
import pandas as pd
import pytest

from tidelog.streaming import acks

NAMES = [c.split()[0] for c in acks.CONTROL.split(", ")]


def plain_acks(rows):
    """One row after the other: a queue per shard, as its only state."""
    queue, out = {}, []
    for shard, at, action, token, *checkpoint in rows:
        q = queue.setdefault(shard, [])
        if action == "deliver":
            q.append([token, checkpoint, False])
            continue
        if action == "rebase":
            q.clear()
            out.append((shard, at, "rebase", None, *checkpoint, 0, None))
            continue
        mine = next((x for x in q if x[0] == token), None)
        to, problem = None, None if mine else "obsolete"
        if mine:
            mine[2] = True
        while q and q[0][2]:
            to = q.pop(0)[1]
        out.append((shard, at, "ack", token, *(to or [None] * 4), len(q), problem))
    return out


def random_control(seed, n=300, shards=3):
    rng, rows, issued, seqno = random.Random(seed), [], {}, {}
    for at in range(n):
        shard = rng.randrange(shards)
        mine = issued.setdefault(shard, [])
        roll = rng.random()
        if roll < 0.5 or not mine:
            seqno[shard] = seqno.get(shard, 0) + rng.randrange(1, 3)
            mine.append(at)
            rows.append((shard, at, "deliver", at, seqno[shard], seqno[shard] - 1, seqno[shard] + 9, rng.choice([None, 7])))
        elif roll < 0.97:
            token = rng.choice(mine[-8:]) if rng.random() < 0.95 else 10**6
            rows.append((shard, at, "ack", token, None, None, None, None))
        else:
            seqno[shard] = rng.randrange(50)
            rows.append((shard, at, "rebase", None, seqno[shard], 0, 99, None))
    return rows


def test_ack_fold_equals_a_queue():
    for seed in range(40):
        rows = [r for r in random_control(seed, 80, 1) if r[2] != "rebase"]
        x = pd.DataFrame([tuple(-1 if v is None else v for v in r) for r in rows], columns=NAMES)
        cut = len(x) // 3
        pending, got = np.zeros((0, 6), np.int64), []
        for part in (x.iloc[:cut], x.iloc[cut:]):
            pending, _, out = acks.fold(pending, part.reset_index(drop=True))
            got += out
        want = [(at, token, None if c[0] is None else [-1 if v is None else v for v in c], n, p) for _, at, _, token, *c, n, p in plain_acks(rows)]
        assert got == want


def test_acks_as_a_stream(spark, tmp_path):
    """Micro-batches and restarts anywhere; out-of-order acks, a rebase, and tokens from before it."""
    rows = random_control(1) + [(9, 1000, "deliver", 1, 1, 1, 2, None), (9, 1001, "deliver", 2, 2, 1, 2, None), (9, 1002, "ack", 2, *[None] * 4), (9, 1003, "ack", 1, *[None] * 4), (9, 1004, "deliver", 3, 3, 3, 4, None), (9, 1005, "rebase", None, 2, 2, 2, None), (9, 1006, "ack", 3, *[None] * 4)]
    rows.sort(key=lambda r: r[1])
    for part in np.array_split(np.arange(len(rows)), 3):
        spark.createDataFrame([rows[i] for i in part], acks.CONTROL).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        control = spark.readStream.schema(acks.CONTROL).parquet(str(tmp_path / "in"))
        acks.run(spark, control, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=lambda r: (r[0], r[1]))
    assert got == sorted(plain_acks(rows), key=lambda r: (r[0], r[1]))
    mine = {r[1]: r for r in got if r[0] == 9}
    assert mine[1002][4:9] == (None, None, None, None, 2) and mine[1003][4] == 2 and mine[1003][8] == 0
    assert mine[1006][4] is None and mine[1006][9] == "obsolete"


def test_acks_in_windows_equal_the_fold_and_leave_python_out(spark, monkeypatch):
    """One shard's rows of one micro-batch and what waited before them go through no worker of Python: windows over blocks, of any size."""
    for seed in range(4):
        monkeypatch.setattr(acks, "BLOCK_ROWS", (7, 40, 90, 500)[seed])
        rows = [r for r in random_control(seed, 200, 1) if r[2] != "rebase"]
        made = spark.createDataFrame(rows, acks.CONTROL).selectExpr("*", "CAST(null AS BOOLEAN) AS acked")
        out = acks.settled(spark.createDataFrame(made.collect(), made.schema))
        left, _, want = acks.fold(np.zeros((0, 6), np.int64), pd.DataFrame([tuple(-1 if v is None else v for v in r) for r in rows], columns=NAMES))
        got = out.orderBy("at").collect()
        assert [(r["at"], r["token"], None if r["advanced_to"] is None else [-1 if r[c] is None else r[c] for c in ("advanced_to", "snap_start", "snap_end", "manifest_uid")], r["pending"], r["problem"]) for r in got if r["waits"] == 0] == want
        assert [(r["token"], r["advanced_to"], r["pending"]) for r in got if r["waits"] == 1] == [(t[0], t[1], t[5]) for t in left.tolist()]
    plan = acks.settled(spark.range(9).selectExpr("0 AS shard", "id AS at", "'ack' AS action", *[f"id AS {c}" for c in NAMES[3:]], "CAST(null AS BOOLEAN) AS acked"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Python" not in plan and "Pandas" not in plan


def test_acks_in_small_blocks(spark, tmp_path, monkeypatch):
    """Rebases, waiting deliveries and acknowledgements over the borders of blocks and micro-batches."""
    monkeypatch.setattr(acks, "BLOCK_ROWS", 9)
    rows = random_control(5, 240, 2)
    for part in np.array_split(np.arange(len(rows)), 2):
        spark.createDataFrame([rows[i] for i in part], acks.CONTROL).write.mode("append").parquet(str(tmp_path / "in"))
        acks.run(spark, spark.readStream.schema(acks.CONTROL).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=lambda r: (r[0], r[1])) == sorted(plain_acks(rows), key=lambda r: (r[0], r[1]))


def test_acks_of_a_repeated_micro_batch_are_there_once(spark, tmp_path):
    """A stream that failed after its outcomes were in place and before its commit does the micro-batch again; one without rows changes nothing."""
    given = [(0, s, "deliver", s, s, 1, 9, None) for s in (1, 2, 3, 4)]
    parts = [[*given, (0, 5, "ack", 2, *[None] * 4)], [(1, 5, "later", 0, *[None] * 4)], [(0, 6, "ack", 1, *[None] * 4), (0, 7, "ack", 4, *[None] * 4), (0, 8, "ack", 2, *[None] * 4)]]
    for n, part in enumerate(parts):
        spark.createDataFrame(part, acks.CONTROL).write.mode("append").parquet(str(tmp_path / "in"))
        control = spark.readStream.schema(acks.CONTROL).parquet(str(tmp_path / "in")).where("action <> 'later'")
        acks.run(spark, control, str(tmp_path / "out"), str(tmp_path / "ck"))
        if n == 2:
            for name in (f"commits/{n}", f"commits/.{n}.crc"):
                (tmp_path / "ck" / name).unlink(missing_ok=True)
            acks.run(spark, control, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = sorted((r["at"], r["token"], r["advanced_to"], r["pending"], r["problem"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(5, 2, None, 4, None), (6, 1, 2, 2, None), (7, 4, None, 2, None), (8, 2, None, 2, "obsolete")]


def test_live_metrics_equal_those_of_the_labelled_rows(spark, tmp_path):
    """After a run the counters are those of metrics.snapshot over the batch's labels; all four states are reached."""
    from pyspark.sql import functions as F
    from test_changelog import MARKS, ROW, event, marker

    from tidelog import Config, Engine
    from tidelog.config import Mitigation
    from tidelog.errors import PersistenceError
    from tidelog.operators import metrics
    from tidelog.plans.engine import stages
    from tidelog.sources import checkpoints, files

    rows = [marker(0, 1, 9), event(1, 1), event(2, 2, kind="deletion"), marker(0, 1, 9, 1), event(1, 1, 1), event(2, 4, 1, "seqno_advanced"), event(3, 5, 1), (1, 4, "stream_end", None, None, None)]
    marks = spark.createDataFrame([(0, 9, False, None), (1, 4, False, None)], MARKS)
    config = Config("b", mode="finite", bucket_uuid="u", mitigation=Mitigation(poll_s=0.1, request_s=0.2, stall_s=60))
    log = spark.createDataFrame(rows, ROW)
    files.write_log(log, str(tmp_path / "log"))
    engine = Engine(spark, config, checkpoints.NoopStore())
    assert engine.monitor.status == "starting"
    seen = []
    sub = engine.subscribe(files.stream(spark, str(tmp_path / "log"), schema=ROW), lambda df, _: seen.append(df.count()), str(tmp_path / "ck"), marks=marks)
    sub.query.awaitTermination()
    for _ in range(50):
        if engine.monitor.status == "healthy":
            break
        time.sleep(0.1)
    assert engine.monitor.status == "healthy" and engine.holding == 2
    x = stages(log, config, marks)
    held = ~F.col("delivered") & ~F.col("acked")
    labelled = x.withColumns({"held": held, "stale": F.lit(False), "failed": F.lit(None).cast("string"), "acked": F.col("delivered") & F.col("seqno").isNotNull()})
    want = metrics.snapshot(labelled, {"bootstrap_attempts": 1, "bootstrap_successes": 1, "active_connections": 1}).first().asDict()
    assert engine.monitor.counters == want and want["delivered_events"] == sum(seen) == 6 and want["rollback_mitigation_delays"] == 2
    engine.config = dataclasses.replace(config, mitigation=Mitigation(poll_s=0.1, request_s=0.2, stall_s=0.5))
    with pytest.raises(PersistenceError):
        sub.wait(60)
    assert engine.monitor.status == "degraded" and engine.monitor.counters["rollback_mitigation_failures"] == 1 and engine.monitor.consecutive_failures >= 1
    assert {(r.name, r.label): r.value for r in engine.monitor.families(spark).collect()}[("changelog_health_status", "degraded")] == 1
    with pytest.raises(PersistenceError):
        sub.close()
    assert engine.monitor.status == "stopped" and engine.monitor.counters["active_connections"] == 0
    engine.monitor.add(rollbacks=2**64)
    assert engine.monitor.counters["rollbacks"] == 2**64 - 1


def log_rows(shards=3, events=40, window=8):
    from test_changelog import event, marker

    rows = []
    for s in range(shards):
        for i in range(1, events + 1):
            if i % window == 1:
                rows.append(marker(10 * i - 1, i, i + window - 1, s))
            rows.append(event(10 * i, i, s))
    return rows


def append(spark, rows, path):
    from test_changelog import ROW

    from tidelog.sources import files

    files.write_log(spark.createDataFrame(rows, ROW), path)


def test_shard_source_reads_what_it_owns(spark, tmp_path):
    """Partitions by owned shard, starts inside a snapshot get its marker, filters reach the folders and rows."""
    import json

    from pyspark.sql import functions as F
    from test_changelog import ROW

    from tidelog.sources import shards

    shards.register(spark)
    rows, path = log_rows(), str(tmp_path / "log")
    append(spark, [r for r in rows if r[1] <= 170], path)
    append(spark, [r for r in rows if r[1] > 170], path)
    read = lambda **o: spark.read.format("tidelog").schema(ROW).options(path=path, **o).load()
    assert sorted(map(tuple, read().collect()), key=str) == sorted(rows, key=str)
    x = read(shards="0,2,9", starts=json.dumps({"0": 12}), ends=json.dumps({"2": 20}))
    assert x.rdd.getNumPartitions() == 2
    got = {}
    for r in x.collect():
        got.setdefault(r.shard, []).append((r.kind, r.seqno or r.snap_start))
    assert got[0][:2] == [("snapshot_marker", 9), ("mutation", 13)] and [v for k, v in got[0] if k == "mutation"] == list(range(13, 41))
    assert [v for k, v in got[2] if k == "mutation"] == list(range(1, 21)) and 1 not in got
    y = read().where((F.col("shard") == 1) & (F.col("seqno") > 30))
    assert y.rdd.getNumPartitions() == 1 and sorted(r.seqno for r in y.collect()) == list(range(31, 41))
    assert read(shards="7").count() == 0


def test_shard_source_goes_on_at_each_shards_seqno(spark, tmp_path):
    """Restarts read only what is new; markers come with their events; a frozen read keeps its ends."""
    from test_changelog import ROW

    from tidelog import Config, Engine
    from tidelog.sources import checkpoints, shards

    shards.register(spark)
    rows, path, got = log_rows(2), str(tmp_path / "log"), []

    def run(**options):
        engine = Engine(spark, Config("b", mode="finite", bucket_uuid="u"), checkpoints.FileStore(str(tmp_path / "c.json")))
        stream = spark.readStream.format("tidelog").schema(ROW).options(path=path, **options).load()
        sub = engine.subscribe(stream, lambda df, _: got.extend((r.shard, r.arrival) for r in df.collect()), str(tmp_path / "ck"))
        sub.wait(120)
        sub.close()
        return engine

    append(spark, [r for r in rows if r[1] <= 172 and (r[0] == 0 or r[1] < 90)], path)
    run()
    assert len(got) == len(set(got)) and {g for g in got if g[0] == 1} == {(r[0], r[1]) for r in rows if r[0] == 1 and r[1] < 89}
    append(spark, [r for r in rows if not (r[1] <= 172 and (r[0] == 0 or r[1] < 90))], path)
    engine = run(frozen=str(tmp_path / "ends.json"))
    assert sorted(got) == sorted((r[0], r[1]) for r in rows) and engine.store.load("u", [0, 1])[1]["seqno"] == 40
    append(spark, [(s, 1000 + i, "mutation", 41 + i, None, None) for s in (0, 1) for i in range(3)], path)
    run(frozen=str(tmp_path / "ends.json"))
    assert len(got) == len(rows)


def test_rows_of_other_streams_fail_the_subscription(spark, tmp_path):
    """A row of another opaque, stream id or shard than the open streams' ends it, after what lies before."""
    from test_changelog import ROW, event, marker

    from tidelog import Config, Engine
    from tidelog.errors import StreamError
    from tidelog.sources import checkpoints, files

    opened = spark.createDataFrame([(0, None, 5), (1, 7, 6)], "shard int, stream_id int, opaque bigint")
    full = ROW + ", stream_id int, opaque bigint"
    good = [(*marker(1, 1, 9), None, 5), (*event(2, 1), None, 5), (*marker(1, 1, 9, 1), 7, 6), (*event(2, 1, 1), 7, 6)]
    cases = {"other_opaque": [(*event(3, 2), None, 4), (*event(4, 3), None, 5)], "other_stream": [(*event(3, 2, 1), None, 6)], "not_open": [(*marker(1, 1, 9, 2), None, 5)]}
    for k, (label, bad) in enumerate(cases.items()):
        files.write_log(spark.createDataFrame(good + bad, full), str(tmp_path / f"log{k}"))
        got, engine = [], Engine(spark, Config("b", mode="finite", bucket_uuid="u"), checkpoints.NoopStore())
        sub = engine.subscribe(files.stream(spark, str(tmp_path / f"log{k}"), schema=full), lambda df, _: got.extend((r.shard, r.seqno) for r in df.collect() if r.seqno), str(tmp_path / f"ck{k}"), opened=opened)  # noqa: B023
        with pytest.raises(StreamError, match=label):
            sub.wait(120)
        with pytest.raises(StreamError):
            sub.close()
        assert sorted(got) == [(0, 1), (1, 1)] and list(engine.stopped.values()) == [label]


def test_closing_one_shard(spark, tmp_path):
    """Its rows, held ones too, are passed over, the sink gets its end, the others go on; a shard that isn't active can't be closed."""
    from test_changelog import MARKS, ROW, event, marker

    from tidelog import Config, Engine
    from tidelog.config import Mitigation
    from tidelog.errors import StreamError
    from tidelog.sources import checkpoints, files

    got, path = [], str(tmp_path / "log")
    append(spark, [marker(1, 1, 9, s) for s in (0, 1)] + [event(1 + i, i, s) for s in (0, 1) for i in (1, 2)], path)
    engine = Engine(spark, Config("b", bucket_uuid="u", mitigation=Mitigation(poll_s=0.1, request_s=0.2, stall_s=60)), checkpoints.NoopStore())
    marks = {"now": [(0, 1, False, None), (1, 9, False, None)]}
    sub = engine.subscribe(files.stream(spark, path, schema=ROW), lambda df, _: got.extend((r.shard, r.kind, r.seqno) for r in df.collect()), str(tmp_path / "ck"), marks=lambda: spark.createDataFrame(marks["now"], MARKS))
    sub.query.processAllAvailable()
    assert engine.holding == 1
    sub.close_shard(0)
    for shard in (0, 5):
        with pytest.raises(StreamError, match="not active"):
            sub.close_shard(shard)
    marks["now"] = [(0, 9, False, None), (1, 9, False, None)]
    append(spark, [event(5, 3, s) for s in (0, 1)], path)
    sub.query.processAllAvailable()
    sub.drain()
    sub.close()
    assert [g for g in got if g[0] == 0] == [(0, "snapshot_marker", None), (0, "mutation", 1), (0, "stream_end", None)]
    assert {g[2] for g in got if g[0] == 1} == {None, 1, 2, 3} and engine.statuses()[0]["processed"] == 1
