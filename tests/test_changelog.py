"""Worked cases: routing, order, acknowledgement, gate, rollback, names, wire, stores, configuration."""

import decimal
import json
import struct
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelog import Config, Engine
from tidelog.config import FlowControl, Mitigation, Selection, parse_seed
from tidelog.errors import CheckpointError, CheckpointStoreError, CollectionError, InvalidConfiguration, PersistenceError, RollbackRequired, StreamError
from tidelog.functions import columns, wire
from tidelog.operators import ack, collections, endpoints, filters, gate, membership, metrics, order, rollback, topology
from tidelog.sources import checkpoints, files
from tidelog.streaming.held import Versions

ROW = "shard int, arrival bigint, kind string, seqno bigint, snap_start bigint, snap_end bigint"


def encode_frame(opcode: int, extras: bytes = b"", key: bytes = b"", value: bytes = b"", target: int = 0, cas: int = 0, datatype: int = 0, magic: int = wire.REQUEST, opaque: int = 0, framing: bytes = b"") -> bytes:
    """A wire frame: the inverse of wire.decode_frames, for fixtures."""
    body = framing + extras + key + value
    if magic in (wire.ALT_REQUEST, wire.ALT_RESPONSE):
        head = struct.pack(">BBBBBBHIIQ", magic, opcode, len(framing), len(key), len(extras), datatype, target, len(body), opaque, cas)
    else:
        head = struct.pack(">BBHBBHIIQ", magic, opcode, len(key), len(extras), datatype, target, len(body), opaque, cas)
    return head + body


def leb128(n: int) -> bytes:
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


def marker(at, s, e, shard=0):
    return (shard, at, "snapshot_marker", None, s, e)


def event(at, seqno, shard=0, kind="mutation"):
    return (shard, at, kind, seqno, None, None)


def test_shard_of_key(spark):
    rows = spark.createDataFrame([("membership",), ("hello",), ("travel-sample",)], "k string").select("k", columns.shard_of(F.col("k"), 1024).alias("s")).collect()
    assert {r.k: r.s for r in rows} == {"membership": 767, "hello": 528, "travel-sample": 86}


def test_order_labels(spark):
    rows = [event(1, 5), marker(10, 1, 10, 1), event(11, 5, 1), event(12, 4, 1), marker(20, 1, 10, 2), event(21, 11, 2), marker(22, 1, 5, 2), marker(30, 1, 3, 3), event(31, 3, 3), marker(32, 1, 2, 3)]
    got = {(r.shard, r.arrival): (r.violation, r.unreached) for r in order.check_order(spark.createDataFrame(rows, ROW)).collect()}
    assert got[(0, 1)] == ("no_snapshot", False)
    assert got[(1, 12)] == ("non_monotonic", False)
    assert got[(2, 21)] == ("outside", False)
    assert got[(2, 22)] == ("marker_behind", True)
    assert got[(3, 32)] == ("marker_behind", False)


def fold(state: tuple, rows: pd.DataFrame, stop: int | None = None) -> tuple[tuple, pd.DataFrame]:
    """The order rules over one shard's rows, sorted by arrival, one after the other. stop: the stream's end."""
    start, end, last, stopped = state
    out = []
    for arrival, kind, seqno, s, e in rows[["arrival", "kind", "seqno", "snap_start", "snap_end"]].itertuples(index=False):
        violation, seqno = None, None if pd.isna(seqno) else int(seqno)
        was = stopped
        if kind == "snapshot_marker":
            start, end = int(s), int(e)
            violation = "marker_behind" if end < last else "marker_beyond_end" if stop is not None and end > stop else None
        elif seqno is not None:
            if end is None:
                violation = "no_snapshot"
            elif not start <= seqno <= end or (stop is not None and seqno > stop):
                violation = "outside"
            elif seqno <= last:
                violation = "non_monotonic"
            last = max(last, seqno)
        out.append((arrival, kind, seqno, start, end, violation, was))
        stopped = stopped or violation is not None or kind == "stream_end"
    return (start, end, last, stopped), pd.DataFrame(out, columns=["arrival", "kind", "seqno", "snap_start", "snap_end", "violation", "unreached"])


def test_window_and_fold_agree(spark):
    rng = np.random.default_rng(3)
    rows = []
    for shard in range(30):
        seqno = 0
        for at in range(40):
            if rng.random() < 0.25:
                s = max(1, seqno + int(rng.integers(-2, 3)))
                rows.append(marker(at, s, s + int(rng.integers(0, 8)), shard))
            else:
                seqno = max(1, seqno + int(rng.integers(0, 3)))
                rows.append(event(at, seqno, shard))
    want = order.check_order(spark.createDataFrame(rows, ROW)).toPandas().sort_values(["shard", "arrival"])
    for shard, own in pd.DataFrame(rows, columns=["shard", "arrival", "kind", "seqno", "snap_start", "snap_end"]).groupby("shard"):
        _, out = fold((None, None, 0, False), own.sort_values("arrival"))
        w = want[want["shard"] == shard]
        assert [x or None for x in out["violation"]] == [None if pd.isna(x) else x for x in w["violation"]]
        assert out["unreached"].tolist() == w["unreached"].tolist()


def test_out_of_order_ack(spark):
    def progress(*acked):
        return ack.contiguous_progress(spark.createDataFrame([(7, 1, acked[0]), (7, 2, acked[1])], "shard int, seqno bigint, acked boolean")).first()

    assert (progress(False, True).processed, progress(False, True).pending) == (0, 2)
    assert (progress(True, True).processed, progress(True, True).pending) == (2, 0)


def test_skip_until_keeps_subsecond_cutoff(spark):
    rows = [("mutation", 19_999_999_999), ("deletion", 19 * 10**9), ("mutation", 20 * 10**9), ("snapshot_marker", None)]
    log = spark.createDataFrame(rows, "kind string, cas bigint")
    assert [r.delivered for r in filters.skip_until(log, 20 * 10**9).collect()] == [False, False, True, None] or [bool(r.delivered) for r in filters.skip_until(log, 20 * 10**9).where("kind <> 'snapshot_marker'").collect()] == [False, False, True]
    assert not filters.skip_until(log, 20 * 10**9 + 1).where("cas = 20000000000").first().delivered
    assert filters.skip_until(log, -1).where("NOT delivered").count() == 0


def test_gate_outcomes(spark):
    obs = "cycle bigint, shard int, node string, ok boolean, did_failover boolean, obs_shard int, branch bigint, persisted bigint, current bigint"
    exp = spark.createDataFrame([(0, 7, 99, 3), (1, 7, 99, 3), (2, 7, 99, 3), (3, 7, 99, 3)], "cycle bigint, shard int, branch bigint, copies int")
    rows = [(0, 7, f"n{i}", True, False, 7, 99, p, 50) for i, p in enumerate((45, 42, 44))] + [(1, 7, "n0", True, False, 7, 99, 50, 50)]
    rows += [(2, 7, f"n{i}", True, False, 7, 98 if i else 99, 50, 50) for i in range(3)]
    got = {r.cycle: (r.outcome, r.persisted) for r in gate.outcomes(spark.createDataFrame(rows, obs), exp).collect()}
    assert got == {0: ("persisted", 42), 1: ("incomplete", None), 2: ("branch_changed", None), 3: ("incomplete", None)}
    o = spark.createDataFrame([(1, 0, "persisted", 50), (1, 1, "branch_changed", None), (2, 0, "persisted", 40), (2, 1, "transient", None), (3, 0, "persisted", 9), (3, 1, "persisted", 8), (3, 2, "persisted", 5)], "shard int, cycle bigint, outcome string, persisted bigint")
    assert {r.shard: r.watermark for r in gate.watermarks(o).collect()} == {1: None, 2: 40, 3: 5}


def test_rewind_goes_by_position(spark):
    f = spark.createDataFrame([(0, 0, 30, 50), (0, 1, 20, 25), (0, 2, 10, 0)], "shard int, pos int, branch bigint, seqno bigint")
    r = spark.createDataFrame([(0, 30), (0, 60)], "shard int, rollback_seqno bigint")
    assert {x.rollback_seqno: x.branch for x in rollback.rewind(r, f).collect()} == {30: 20, 60: 30}


def test_registry_and_assignment(spark):
    got = membership.balanced(spark, 10, 3).groupBy("member").agg(F.sort_array(F.collect_list("shard")).alias("s")).collect()
    assert {r.member: r.s for r in got} == {1: [0, 1, 2, 3], 2: [4, 5, 6], 3: [7, 8, 9]}
    for shards, members in ((10, 0), (2, 3), (65537, 1)):
        with pytest.raises(InvalidConfiguration):
            membership.balanced(spark, shards, members)


def test_routes_and_problems(spark):
    doc = {"rev": 7, "revEpoch": 2, "vBucketServerMap": {"numReplicas": 1, "serverList": ["a", "b"], "vBucketMap": [[0, 1], [9, 1], [-1, 0], [1, -1]]}}
    got = {r.shard: (r.active, r.problem) for r in topology.parse_routes(spark.createDataFrame([(json.dumps(doc),)], "json string")).collect()}
    assert got == {0: ("a", None), 1: (None, "node out of range"), 2: (None, "no active node"), 3: ("b", None)}


def test_manifest_selection(spark):
    m = {"uid": "2a", "scopes": [{"uid": "8", "name": "inventory", "collections": [{"uid": "9", "name": "airline", "maxTTL": 60}, {"uid": "a", "name": "airport"}]}]}
    dim = collections.parse_manifest(spark.createDataFrame([(json.dumps(m),)], "json string"))
    assert collections.resolve(dim, "inventory", ("airport", "airline")) == (None, [10, 9])
    assert collections.resolve(dim, "inventory", ()) == (8, [])
    with pytest.raises(CollectionError):
        collections.resolve(dim, "inventory", ("hotel",))
    log = spark.createDataFrame([("mutation", 11)], "kind string, collection_id bigint")
    with pytest.raises(Exception, match="unmapped collection"):
        collections.decorate(log, dim).collect()


def frames(spark, *raw):
    return wire.decode_events(wire.decode_frames(spark.createDataFrame([(i, bytearray(f)) for i, f in enumerate(raw)], "i int, frame binary"))).orderBy("i").collect()


def test_wire_events(spark):
    big = 2**64 - 1
    mutation = encode_frame(0x57, struct.pack(">QQIIIHB", 100, 7, 0xDEADBEEF, 3600, 12, 0, 0), leb128(4) + b"key", b"{}", target=9, cas=big, datatype=3)
    marker1 = encode_frame(0x56, struct.pack(">QQI", 5, 10, 3))
    marker2 = encode_frame(0x56, b"\x02", value=struct.pack(">QQIQQQQ", 6, 12, 0x10, 11, 9, 1234, 5))
    made = encode_frame(0x5F, struct.pack(">QIB", 44, 0, 1), b"hotel", struct.pack(">QIII", 0xAA, 8, 9, 3600))
    short = encode_frame(0x58, b"\0" * 8, leb128(1))
    sid = encode_frame(0x64, struct.pack(">Q", 3), magic=wire.ALT_REQUEST, framing=bytes([0x22, 0, 7]))
    end = encode_frame(0x55, struct.pack(">I", 6))
    large = encode_frame(0x64, struct.pack(">Q", big))
    a, b, c, d, e, f, g, h = frames(spark, mutation, marker1, marker2, made, short, sid, end, large)
    assert (a.kind, a.seqno, a.flags, a.expiry, a.lock_time, a.collection_id, bytes(a.key), int(a.cas), a.shard, a.malformed) == ("mutation", 100, 0xDEADBEEF, 3600, 12, 4, b"key", big, 9, None)
    assert (b.snap_start, b.snap_end, b.snap_flags) == (5, 10, 3)
    assert (c.snap_start, c.snap_end, c.max_visible_seqno, c.high_completed_seqno, c.snap_timestamp, c.purge_seqno) == (6, 12, 11, 9, 1234, 5)
    assert (d.sys_kind, d.seqno, d.manifest_uid, d.scope_id, d.collection_id, d.max_ttl) == ("create_collection", 44, 0xAA, 8, 9, 3600)
    assert e.malformed == "short extras" and f.stream_id == 7 and g.end_reason == "unknown" and h.malformed == "seqno too large"
    assert not frames(spark, encode_frame(0x5C)) and frames(spark, b"\x80\x57")[0].malformed == "short header"


def test_leb128(spark):
    good = [0, 1, 0x7F, 0x80, 0x555, 0xFFFF, 0xCAFEF00D, 2**32 - 1]
    bad = [b"\x80", b"\xff\xff\xff\xff\x10", b"\x80" * 5 + b"\0"]
    rows = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate([leb128(n) for n in good] + bad)], "i int, b binary").select("i", wire.uleb128(F.col("b")).alias("u")).orderBy("i").collect()
    assert [r.u and r.u.value for r in rows] == good + [None] * 3


def test_record_lists(spark):
    v = bytearray(struct.pack(">HQHQ", 1, 2, 3, 4))
    x = spark.createDataFrame([(v, bytearray(b"abc"), bytearray(b""))], "v binary, w binary, e binary").select(wire.seqno_list(F.col("v")).alias("v"), wire.seqno_list(F.col("w")).alias("w"), wire.failover_list(F.col("e")).alias("e")).first()
    assert [(r.shard, int(r.seqno)) for r in x.v] == [(1, 2), (3, 4)] and x.w is None and x.e == []


def test_stores(tmp_path):
    c = {"bucket_uuid": "bucket-id", "shard": 7, "branch": 43697, "seqno": 10, "snap_start": 9, "snap_end": 10, "manifest_uid": 255}
    store = checkpoints.FileStore(str(tmp_path / "c.json"))
    store.save([c])
    assert json.loads((tmp_path / "c.json").read_text()) == {"7": {"checkpoint": {"snapshot": {"startSeqno": 9, "endSeqno": 10}, "vbuuid": 43697, "seqno": 10}, "bucketUuid": "bucket-id", "manifestUid": 255}}
    assert checkpoints.load_checked(store, "bucket-id", [7, 8]) == {7: c}
    with pytest.raises(CheckpointStoreError):
        store.load("other", [7])
    store.clear([7])
    assert not (tmp_path / "c.json").exists()
    (tmp_path / "c.json").write_text("{")
    with pytest.raises(CheckpointStoreError):
        store.load("bucket-id", [7])
    keyed = checkpoints.KeyedStore({}, "group1")
    keyed.save([c])
    assert list(keyed.documents) == ["_connector:cbgo:group1:checkpoint:7"] and keyed.load("bucket-id", [7]) == {7: c}
    assert checkpoints.ReadOnlyStore(keyed).clear([7]) is None and keyed.documents


def test_shared_store_and_attributes(spark, tmp_path):
    c = {"bucket_uuid": "u", "shard": 7, "branch": 4, "seqno": 10, "snap_start": 9, "snap_end": 10, "manifest_uid": None}
    store = checkpoints.SharedFileStore(spark, f"file://{tmp_path}/shared/c.json")
    assert store.load("u", [7]) == {}
    store.save([c])
    store.save([{**c, "seqno": 9}, {**c, "shard": 8}])
    assert store.load("u", [7, 8]) == {7: {**c, "seqno": 9}, 8: {**c, "shard": 8}}
    assert checkpoints.FileStore(f"{tmp_path}/shared/c.json").load("u", [7])[7]["seqno"] == 9
    store.clear([7, 8])
    assert store.load("u", [7]) == {} and not (tmp_path / "shared/c.json").exists()
    keyed = checkpoints.KeyedStore({"_connector:cbgo:g:checkpoint:7": '{"own": 1}'}, "g", attribute=True)
    assert keyed.load("u", [7]) == {}
    keyed.save([c])
    assert keyed.load("u", [7]) == {7: c} and json.loads(keyed.documents["_connector:cbgo:g:checkpoint:7"])["own"] == 1


def test_configuration():
    Config("b")
    for bad in (lambda: Config(""), lambda: FlowControl(ack_ratio=0), lambda: FlowControl(noop_s=30, dead_s=30), lambda: Mitigation(stall_s=5), lambda: Selection("a b"), lambda: Selection("a", ("x", "x")), lambda: Config("b", mode="x")):
        with pytest.raises(InvalidConfiguration):
            bad()
    assert parse_seed("[::1]:99", 1) == ("::1", 99) and parse_seed("::1", 5) == ("::1", 5) and parse_seed("h:7", 1) == ("h", 7)
    assert metrics.credit_threshold(20 << 20, 0.2) == 4_194_305


def test_batch_run_records_progress(spark, tmp_path):
    log = spark.createDataFrame([(*marker(1, 1, 3), 5), (*event(2, 1), 5), (*event(3, 2), 5), (*event(4, 2), 5), (*event(5, 3), 5)], ROW + ", cas bigint")
    store, got = checkpoints.FileStore(str(tmp_path / "c.json")), []
    engine = Engine(spark, Config("b", bucket_uuid="u"), store)
    with pytest.raises(StreamError, match="shard 0: non_monotonic at arrival 4"):
        engine.run_batch(log, lambda df: got.extend(r.arrival for r in df.collect()))
    assert sorted(got) == [1, 2, 3] and engine.statuses()[0]["stopped"] == "non_monotonic"
    assert store.load("u", [0])[0]["seqno"] == 2


def test_rollback_policies(spark, tmp_path):
    store = checkpoints.FileStore(str(tmp_path / "c.json"))
    store.save([{"bucket_uuid": "u", "shard": 0, "branch": 10, "seqno": 101, "snap_start": 100, "snap_end": 110, "manifest_uid": 23}])
    highs = spark.createDataFrame([(0, 99)], "shard int, high_seqno bigint")
    log = spark.createDataFrame([(0, 0, 20, 50), (0, 1, 10, 0)], "shard int, pos int, branch bigint, seqno bigint")
    with pytest.raises(RollbackRequired) as e:
        Engine(spark, Config("b", bucket_uuid="u", start_from="checkpoint"), store).starts([0], highs, log)
    assert (e.value.requested, e.value.rollback) == (101, 99)
    r = Engine(spark, Config("b", bucket_uuid="u", start_from="checkpoint", rollback_policy="rewind_and_replay"), store).starts([0], highs, log).first()
    assert (r.start_seqno, r.snap_start, int(r.branch), r.manifest_uid) == (99, 99, 20, None)


def test_stream_equals_batch(spark, tmp_path):
    log = spark.createDataFrame([marker(1, 1, 4), event(2, 1), event(3, 2), marker(1, 1, 2, 1), event(2, 3, 1), event(3, 1, 1)], ROW)
    files.write_log(log, str(tmp_path / "log"))
    schema = "shard int, arrival bigint, kind string, seqno bigint, snap_start bigint, snap_end bigint"
    engine, got = Engine(spark, Config("b", mode="finite", bucket_uuid="u"), checkpoints.FileStore(str(tmp_path / "c.json"))), []
    sub = engine.subscribe(files.stream(spark, str(tmp_path / "log"), schema=schema), lambda df, _: got.extend((r.shard, r.arrival) for r in df.collect()), str(tmp_path / "ck"))
    with pytest.raises(StreamError):
        engine.subscribe(None, None, "")
    with pytest.raises(StreamError, match="shard 1: outside"):
        sub.wait(120)
    with pytest.raises(StreamError):
        sub.close()
    assert sorted(got) == [(0, 1), (0, 2), (0, 3), (1, 1)]
    assert engine.store.load("u", [0, 1])[0]["seqno"] == 2
    assert files.scan(spark, str(tmp_path / "log"), shards=[1], schema=schema).count() == 3


def stream_of(spark, path, rows, parts=1, at_once=1):
    """A stream over rows whose files are taken one at a time, in the order of arrival."""
    log = spark.createDataFrame(rows, ROW)
    cuts = np.array_split(sorted({r[1] for r in rows}), parts)
    for c in cuts:
        files.write_log(log.where(F.col("arrival").isin([int(x) for x in c])).coalesce(1), path)
        time.sleep(0.02)  # files are ordered by their time
    return files.stream(spark, path, schema=ROW, files_per_trigger=at_once)


def test_stream_raises_a_violation_of_order(spark, tmp_path):
    """What lies before a violation is delivered and recorded, then the stream fails; what comes after it is not delivered."""
    rows = [marker(0, 0, 10), event(1, 1), event(2, 5), event(3, 4), event(4, 6), marker(0, 0, 10, 1), event(1, 1, 1)]
    store, got = checkpoints.FileStore(str(tmp_path / "c.json")), []
    engine = Engine(spark, Config("b", mode="finite", bucket_uuid="u"), store)
    sub = engine.subscribe(stream_of(spark, str(tmp_path / "log"), rows), lambda df, _: got.extend((r.shard, r.seqno) for r in df.collect() if r.seqno), str(tmp_path / "ck"))
    with pytest.raises(StreamError, match="shard 0: non_monotonic at arrival 3, seqno 4"):
        sub.wait(120)
    with pytest.raises(StreamError, match="non_monotonic"):
        sub.close()
    assert [s for s in got if s[0] == 0] == [(0, 1), (0, 5)] and store.load("u", [0])[0]["seqno"] == 5
    assert engine.statuses()[0] == {"processed": 5, "durable": 5, "dirty": False, "stopped": "non_monotonic"}


def test_carried_order_equals_the_window_form(spark, tmp_path):
    """Random logs cut into micro-batches: every row has the label of the whole log, until the first violation ends the stream."""
    rng = np.random.default_rng(12)
    for trial in range(3):
        rows = []
        for shard in range(4):
            seqno = 0
            for at in range(30):
                if at % 5 == 0:
                    rows.append(marker(at, seqno + 1, seqno + 8, shard))
                elif shard != trial or at < 20 or rng.random() < 0.7:
                    seqno += 1
                    rows.append(event(at, seqno, shard))
                else:
                    rows.append(event(at, max(1, seqno - 1), shard))
        want = order.check_order(spark.createDataFrame(rows, ROW)).collect()
        bad = sorted((r.shard, r.arrival, r.violation) for r in want if r.violation and not r.unreached)
        got, path = [], tmp_path / str(trial)
        engine = Engine(spark, Config("b", mode="finite", bucket_uuid="u"), checkpoints.NoopStore())
        sub = engine.subscribe(stream_of(spark, str(path / "log"), rows, 4), lambda df, _: got.extend((r.shard, r.arrival, r.snap_start, r.snap_end) for r in df.collect()), str(path / "ck"))
        if bad:
            with pytest.raises(StreamError):
                sub.wait(120)
            first = {s: (a, v) for s, a, v in bad}
            assert engine.stopped and all(first[s][1] == v for s, v in engine.stopped.items())
            assert {(r.shard, r.arrival, r.snap_start, r.snap_end) for r in want if r.shard in engine.stopped and r.arrival < first[r.shard][0]} <= set(got)
        else:
            sub.wait(120)
        assert set(got) <= {(r.shard, r.arrival, r.snap_start, r.snap_end) for r in want if r.violation is None and not r.unreached}
        engine.subscription = None
        sub.query.stop()


def test_a_finite_stream_must_reach_its_ends(spark, tmp_path):
    rows = [marker(0, 1, 9), event(1, 1), event(2, 2), marker(0, 1, 3, 1), event(1, 1, 1), event(2, 3, 1)]
    starts = spark.createDataFrame([(0, 0, 9), (1, 0, 3)], "shard int, start_seqno bigint, end_seqno bigint")
    engine = Engine(spark, Config("b", mode="finite", bucket_uuid="u"), checkpoints.NoopStore())
    sub = engine.subscribe(stream_of(spark, str(tmp_path / "log"), rows), lambda df, _: df.count(), str(tmp_path / "ck"), starts=starts)
    with pytest.raises(StreamError, match="shard 0 ended at 2 of 9"):
        sub.wait(120)
    with pytest.raises(StreamError, match="shard 0 ended at 2 of 9"):
        sub.close()
    sub = engine.subscribe(stream_of(spark, str(tmp_path / "log"), [event(3, 9)]), lambda df, _: df.count(), str(tmp_path / "ck"), starts=starts)
    sub.wait(120)
    sub.close()
    assert engine.statuses()[0]["processed"] == 9


def held_stream(spark, tmp_path, marks, stall_s=1.5, sink=None):
    rows = [marker(0, 1, 9), event(1, 1), event(2, 2), marker(0, 1, 3, 1), event(1, 1, 1)]
    config = Config("b", mode="finite", bucket_uuid="u", mitigation=Mitigation(poll_s=0.1, request_s=0.2, stall_s=stall_s))
    engine = Engine(spark, config, checkpoints.NoopStore())
    return engine, engine.subscribe(stream_of(spark, str(tmp_path / "log"), rows, at_once=9), sink, str(tmp_path / "ck"), marks=marks)


MARKS = "shard int, watermark bigint, changed boolean, error string"


def test_a_stalled_shard_fails_the_wait(spark, tmp_path):
    got, sink = [], lambda df, _: got.extend((r.shard, r.seqno) for r in df.collect() if r.seqno)
    engine, sub = held_stream(spark, tmp_path, spark.createDataFrame([(0, 1, False, "no answer"), (1, 9, False, None)], MARKS), sink=sink)
    with pytest.raises(PersistenceError, match="shard 0: not safe within 1.5 s: no answer"):
        sub.wait(120)
    assert sorted(got) == [(0, 1), (1, 1)] and engine.statuses()[0]["processed"] == 1
    assert len(Versions(spark, str(tmp_path / "ck-held")).numbers()) <= 3


def test_a_changed_branch_fails_the_wait(spark, tmp_path):
    got, sink = [], lambda df, _: got.extend((r.shard, r.seqno) for r in df.collect() if r.seqno)
    _, sub = held_stream(spark, tmp_path, spark.createDataFrame([(0, None, True, None), (1, 9, False, None)], MARKS), 60, sink)
    with pytest.raises(PersistenceError, match="shard 0: the branch has changed"):
        sub.wait(120)
    assert sorted(got) == [(1, 1)]


def test_held_rows_are_released_while_waiting(spark, tmp_path):
    got, now = [], {"at": 0}

    def marks():
        now["at"] += 1
        return spark.createDataFrame([(0, 0 if now["at"] < 4 else 9, False, None), (1, 9, False, None)], MARKS)

    engine, sub = held_stream(spark, tmp_path, marks, 60, lambda df, _: got.extend((r.shard, r.seqno) for r in df.collect() if r.seqno))
    sub.wait(120)
    sub.close()
    assert sorted(got) == [(0, 1), (0, 2), (1, 1)] and engine.holding == 0 and now["at"] >= 4


def test_versions_do_not_pile_up(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "v"))
    for epoch in range(5):
        v.write(spark.range(epoch), epoch)
        v.write(spark.range(epoch + 10), -1)
    assert v.numbers() == [(3, 1), (4, 0), (4, 1)] and v.before(4).count() == 13 and v.before(-1).count() == 14
    v.write(spark.range(7), 4)  # a repeated micro-batch
    assert v.before(4).count() == 13 and (4, 0) in v.numbers()


def test_progress_stops_where_delivery_does(spark, tmp_path):
    full = ROW + ", cas bigint, collection_id bigint"
    rows = [(*marker(1, 1, 9, s), None, None) for s in range(3)] + [(*event(i + 1, i, s), 5 * 10**9 if i == 1 else 10**18, 8 + (s == 1 and i == 3)) for s in range(3) for i in range(1, 6)]
    marks = spark.createDataFrame([(0, 3), (1, 9), (2, 0)], "shard int, watermark bigint")
    dim = collections.parse_manifest(spark.createDataFrame([(json.dumps({"uid": "1", "scopes": [{"uid": "8", "name": "s", "collections": [{"uid": "8", "name": "c"}]}]}),)], "json string"))
    store, got = checkpoints.FileStore(str(tmp_path / "c.json")), []
    Engine(spark, Config("b", bucket_uuid="u", skip_until_ns=6 * 10**9), store).run_batch(spark.createDataFrame(rows, full), lambda df: got.extend((r.shard, r.seqno) for r in df.collect() if r.seqno), marks, dim, strict=False)
    assert sorted(got) == [(0, 2), (0, 3), (1, 2)]
    assert {k: c["seqno"] for k, c in store.load("u", [0, 1, 2]).items()} == {0: 3, 1: 2}


def test_stream_skips_and_keeps_columns(spark, tmp_path):
    full = ROW + ", cas decimal(20,0), key binary, rev_seqno bigint"
    rows = [(*marker(1, 1, 9), None, None, None), (*event(2, 1), 5 * 10**9, bytearray(b"a"), 2**60 + 1), (*event(3, 2), 2**63 + 1, bytearray(b"b"), 2**60 + 3), (*event(4, 3), 5 * 10**9, bytearray(b"c"), 1)]
    files.write_log(spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4], r[5], None if r[6] is None else decimal.Decimal(r[6]), *r[7:]) for r in rows], full), str(tmp_path / "log"))
    engine, got = Engine(spark, Config("b", mode="finite", bucket_uuid="u", skip_until_ns=6 * 10**9), checkpoints.FileStore(str(tmp_path / "c.json"))), []
    sub = engine.subscribe(files.stream(spark, str(tmp_path / "log"), schema=full), lambda df, _: got.extend(df.collect()), str(tmp_path / "ck"))
    sub.query.awaitTermination(120)
    sub.close()
    assert [(r.kind, r.seqno, r.cas and int(r.cas), r.key and bytes(r.key), r.rev_seqno) for r in sorted(got, key=lambda r: r.arrival)] == [("snapshot_marker", None, None, None, None), ("mutation", 2, 2**63 + 1, b"b", 2**60 + 3)]
    assert engine.store.load("u", [0])[0]["seqno"] == 3


def test_delegated_rollback(spark, tmp_path):
    store = checkpoints.FileStore(str(tmp_path / "c.json"))
    store.save([{"bucket_uuid": "u", "shard": 0, "branch": 10, "seqno": 101, "snap_start": 100, "snap_end": 110, "manifest_uid": 23}])
    highs, config = spark.createDataFrame([(0, 99)], "shard int, high_seqno bigint"), Config("b", bucket_uuid="u", start_from="checkpoint", rollback_policy="delegate")
    log, seen = spark.createDataFrame([(0, 0, 20, 50), (0, 1, 10, 0)], "shard int, pos int, branch bigint, seqno bigint"), []
    with pytest.raises(InvalidConfiguration):
        Engine(spark, config, store)
    with pytest.raises(RollbackRequired):
        Engine(spark, config, store, lambda *case: seen.append(case) or "stop_and_report").starts([0], highs, log)
    assert seen == [(0, 101, 99, [(20, 50), (10, 0)])]
    assert Engine(spark, config, store, lambda *case: "rewind_and_replay").starts([0], highs, log).first().start_seqno == 99


def test_folds_and_numbers_take_no_whole_group(spark):
    rng = np.random.default_rng(3)
    sizes = [(s, i, int(rng.integers(0, 90))) for s in (0, 1, 2, 5) for i in range(200)]
    want = {}
    for s, _, n in sizes:
        pending, flushes, flushed = want.get(s, (0, 0, 0))
        pending += n
        want[s] = (0, flushes + 1, flushed + pending) if pending >= 100 else (pending, flushes, flushed)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        credit = metrics.flow_credit(spark.createDataFrame(sizes, "shard int, arrival bigint, wire_size int"), 100)
        assert {r.shard: (r.remainder, r.flushes, r.flushed) for r in credit.collect()} == want
        o = spark.createDataFrame([(1, i, "persisted" if i != 50 else "branch_changed", 2**60 + i if i != 50 else None) for i in range(100)] + [(2, 0, "transient", None)], "shard int, cycle bigint, outcome string, persisted bigint")
        marks = gate.watermarks(o)
        assert {r.shard: r.watermark for r in marks.collect()} == {1: 2**60 + 99, 2: None}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for df in (credit, marks):
        assert "collect_list" not in df._jdf.queryExecution().toString()
    numbered = membership.member_numbers(spark.createDataFrame([(f"m{i}", i % 5) for i in range(3000)], "member_id string, joined_at bigint"))
    assert [r.member_number for r in numbered.orderBy("joined_at", "member_id").collect()] == list(range(1, 3001))
    assert numbered.groupBy(F.spark_partition_id()).count().count() > 1
    assert membership.member_numbers(numbered.drop("member_number").limit(0)).count() == 0


def test_rewind_broadcasts_the_failover_log_only(spark):
    f = spark.createDataFrame([(0, 0, 30, 50), (0, 1, 20, 25)], "shard int, pos int, branch bigint, seqno bigint")
    r = spark.range(2000).selectExpr("cast(id % 2 as int) AS shard", "id AS rollback_seqno")
    out = rollback.rewind(r, f)
    assert all(x.branch == (None if x.shard or x.rollback_seqno < 25 else 20 if x.rollback_seqno < 50 else 30) for x in out.collect()) and out.count() == 2000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "rightHint=(strategy=broadcast)" in plan


def doc_log(spark, rows):
    """rows: (shard, arrival, kind, seqno, snap_start, snap_end, cas, collection_id, sys_kind, manifest_uid, scope_id, key)."""
    return spark.createDataFrame(rows, ROW + ", cas bigint, collection_id bigint, sys_kind string, manifest_uid bigint, scope_id bigint, key binary")


def case_rows():
    """Three shards: one with an old document and a schema change, one with an unmapped collection, one whose events wait at the gate."""
    none = (None, None, None, None)
    rows = [(*marker(1, 1, 9, s), None, None, *none) for s in range(3)]
    rows += [(*event(i + 1, i, s), 5 * 10**9 if i == 1 else 10**18, 8, *none) for s in (0, 1, 2) for i in (1, 2)]
    rows += [(*event(4, 3, 0, "system_event"), None, 9, "create_collection", 2, 8, bytearray(b"new")), (*event(5, 4, 0), 10**18, 9, *none)]
    rows += [(*event(4, 3, 1), 10**18, 9, *none), (*event(5, 4, 1), 10**18, 8, *none)]
    return rows


CASE_DIM = {"uid": "1", "scopes": [{"uid": "8", "name": "s", "collections": [{"uid": "8", "name": "c"}]}]}
CASE_MARKS = [(0, 9), (1, 9), (2, 1)]
CASE_WANT = [(0, 2, "c"), (0, 3, None), (0, 4, "new"), (1, 2, "c")]


def case_tables(spark):
    return spark.createDataFrame(CASE_MARKS, "shard int, watermark bigint"), collections.parse_manifest(spark.createDataFrame([(json.dumps(CASE_DIM),)], "json string"))


def test_batch_is_lossless(spark, tmp_path):
    marks, dim = case_tables(spark)
    store, got = checkpoints.FileStore(str(tmp_path / "c.json")), []
    engine = Engine(spark, Config("b", bucket_uuid="u", skip_until_ns=6 * 10**9), store)
    with pytest.raises(CollectionError, match="shard 1: unmapped_collection 9"):
        engine.run_batch(doc_log(spark, case_rows()), lambda df: got.extend((r.shard, r.seqno, r.collection_name) for r in df.collect() if r.seqno), marks, dim)
    assert sorted(got, key=str) == sorted(CASE_WANT, key=str)
    saved = store.load("u", [0, 1, 2])
    assert {s: (c["seqno"], c["manifest_uid"]) for s, c in saved.items()} == {0: (4, 2), 1: (2, None), 2: (1, None)}


def test_stream_equals_batch_in_gate_cutoff_and_names(spark, tmp_path):
    marks, dim = case_tables(spark)
    rows = case_rows()
    now, store, got, epochs = {"marks": marks}, checkpoints.FileStore(str(tmp_path / "c.json")), [], []
    engine = Engine(spark, Config("b", mode="finite", bucket_uuid="u", skip_until_ns=6 * 10**9), store)
    log = doc_log(spark, [r for r in rows if r[0] != 1])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema.fields)
    files.write_log(log.where("arrival <= 3"), str(tmp_path / "log"))
    sink = lambda df, epoch: (epochs.append(epoch), got.extend((r.shard, r.seqno, r.collection_name) for r in df.collect() if r.seqno))

    def run():
        sub = engine.subscribe(files.stream(spark, str(tmp_path / "log"), schema=schema), sink, str(tmp_path / "ck"), marks=lambda: now["marks"], dim=dim)
        sub.query.awaitTermination(120)
        return sub

    run().close()
    assert sorted(got) == [(0, 2, "c")]
    files.write_log(log.where("arrival > 3"), str(tmp_path / "log"))
    sub = run()
    assert sorted(got, key=str) == [(0, 2, "c"), (0, 3, None), (0, 4, "new")]
    now["marks"] = spark.createDataFrame([(0, 9), (2, 9)], "shard int, watermark bigint")
    sub.drain()  # what the gate held comes without a new event
    sub.close()
    assert (2, 2, "c") in got and len(got) == 4
    assert {s: (c["seqno"], c["manifest_uid"]) for s, c in store.load("u", [0, 2]).items()} == {0: (4, 2), 2: (2, None)}
    files.write_log(doc_log(spark, [r for r in rows if r[0] == 1]), str(tmp_path / "log"))
    now["marks"] = marks
    with pytest.raises(Exception, match="unmapped_collection"):
        run()
    assert (1, 2, "c") in got and not [g for g in got if g[0] == 1 and g[1] > 2]
    with pytest.raises(CollectionError):
        engine.subscription.close()
    assert store.load("u", [1])[1]["seqno"] == 2


def test_progress_keeps_branch_and_manifest_and_never_goes_back(spark, tmp_path):
    def store(seqno):
        s = checkpoints.FileStore(str(tmp_path / f"c{seqno}.json"))
        s.save([{"bucket_uuid": "u", "shard": 0, "branch": 10, "seqno": seqno, "snap_start": seqno, "snap_end": seqno, "manifest_uid": 23}])
        return s

    highs = spark.createDataFrame([(0, 200), (1, 5)], "shard int, high_seqno bigint")
    log = spark.createDataFrame([(0, 0, 10, 0), (1, 0, 77, 0)], "shard int, pos int, branch bigint, seqno bigint")
    s = store(1)
    engine = Engine(spark, Config("b", bucket_uuid="u", start_from="checkpoint"), s)
    starts = engine.starts([0, 1], highs, log)
    assert engine.flush() == 1 and s.load("u", [1])[1] == {"bucket_uuid": "u", "shard": 1, "branch": 77, "seqno": 0, "snap_start": 0, "snap_end": 0, "manifest_uid": None}
    engine.run_batch(spark.createDataFrame([marker(1, 1, 5), event(2, 2), event(3, 3)], ROW), lambda df: df.collect(), starts=starts, strict=False)
    assert s.load("u", [0])[0] == {"bucket_uuid": "u", "shard": 0, "branch": 10, "seqno": 3, "snap_start": 1, "snap_end": 5, "manifest_uid": 23}
    again = engine.run_batch(spark.createDataFrame([marker(1, 1, 5), event(2, 1)], ROW), lambda df: df.collect(), starts=starts, strict=False)
    assert [r.violation for r in again.orderBy("arrival").collect()] == [None, "non_monotonic"]
    fresh, late = store(100), spark.createDataFrame([marker(1, 1, 2), event(2, 2)], ROW)
    with pytest.raises(CheckpointError):
        Engine(spark, Config("b", bucket_uuid="u"), fresh).run_batch(late, lambda df: df.collect())
    assert fresh.load("u", [0])[0]["seqno"] == 100
    with pytest.raises(CheckpointError):
        engine.record(spark.createDataFrame([(0, 1, 1, 2)], "shard int, seqno bigint, snap_start bigint, snap_end bigint"))


def test_rebase_and_repeated_rollbacks(spark, tmp_path):
    store = checkpoints.FileStore(str(tmp_path / "c.json"))
    store.save([{"bucket_uuid": "u", "shard": s, "branch": 10, "seqno": 50, "snap_start": 50, "snap_end": 50, "manifest_uid": 23} for s in (0, 1)])
    highs = spark.createDataFrame([(0, 99), (1, 99)], "shard int, high_seqno bigint")
    log = spark.createDataFrame([(s, 0, 20, 30) for s in (0, 1)] + [(0, 1, 10, 0)], "shard int, pos int, branch bigint, seqno bigint")
    engine = Engine(spark, Config("b", bucket_uuid="u", start_from="checkpoint", rollback_policy="rewind_and_replay"), store)
    engine.starts([0, 1], highs, log)
    assert engine.statuses()[0] == {"processed": 50, "durable": 50, "dirty": False, "stopped": None}
    answer = lambda at, shard=0: spark.createDataFrame([(shard, at)], "shard int, rollback_seqno bigint")
    engine.roll_back(answer(40), log)
    engine.roll_back(answer(20), log)
    assert {r.shard: (r.branch, r.start_seqno, r.requested, r.rolled_back_to) for r in engine.open_report().collect()} == {0: (10, 20, 40, 20), 1: (10, 50, None, None)}
    for bad in (answer(20), answer(10, 1)):  # not further back; before the first branch
        with pytest.raises(StreamError):
            engine.roll_back(bad, log)
    assert engine.flush() == 1 and store.load("u", [0])[0]["seqno"] == 20
    with pytest.raises(CheckpointError):
        engine.rebase([{**engine.processed[0], "seqno": 1, "snap_start": 1, "snap_end": 1}, {**engine.processed[1], "shard": 7}])
    assert engine.processed[0]["seqno"] == 20
    engine.mark_dirty(1)
    assert engine.flush() == 1
    for at in range(19, 5, -1):
        engine.roll_back(answer(at), log)
    with pytest.raises(StreamError, match="too many"):
        engine.roll_back(answer(1), log)


def test_source_takes_the_configured_collections(spark, tmp_path):
    _, dim = case_tables(spark)
    log = doc_log(spark, case_rows())
    files.write_log(log, str(tmp_path / "log"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema.fields)
    x = Engine(spark, Config("b", selection=Selection("s", ("c",)))).source(str(tmp_path / "log"), dim, schema=schema)
    assert {r.collection_id for r in x.collect()} == {None, 8} and "PushedFilters: [Or(IsNull(collection_id)" in x._jdf.queryExecution().toString()


def brute_pods(events):
    """The watch events of one cluster, one by one: effective pods by name, and the generation."""
    pods, generation, listed = {}, 0, None
    for _, action, pod, uid, effective in sorted(events):
        after = dict(pods)
        if action == "init":
            listed = {}
        elif action == "init_apply":
            listed.update({pod: uid} if effective else {})
        elif action == "init_done":
            after, listed = listed, None
        elif action == "apply" and effective:
            after[pod] = uid
        elif action == "apply" or after.get(pod) == uid:
            after.pop(pod, None)
        generation += after != pods
        pods = after
    return pods, generation


def test_pods_follow_their_events(spark):
    rng = np.random.default_rng(5)
    rows = []
    for cluster in range(6):
        at = iter(range(1, 10_000))
        rows += [(cluster, next(at), "init", None, None, False), (cluster, next(at), "init_done", None, None, False)]
        for _ in range(60):
            pod, uid = f"p{rng.integers(4)}", f"u{rng.integers(3)}"
            kind = rng.choice(["apply", "apply", "delete", "list"])
            if kind == "list":
                rows.append((cluster, next(at), "init", None, None, False))
                rows += [(cluster, next(at), "init_apply", f"p{k}", f"u{rng.integers(3)}", bool(rng.integers(2))) for k in range(int(rng.integers(0, 4)))]
                rows.append((cluster, next(at), "init_done", None, None, False))
            else:
                rows.append((cluster, next(at), str(kind), pod, uid, bool(rng.integers(3))))
    schema = "cluster int, at bigint, action string, pod string, uid string, effective boolean"
    pods, generation = membership.pods_after(spark.createDataFrame(rows, schema))
    want = {c: brute_pods([r[1:] for r in rows if r[0] == c]) for c in range(6)}
    got = {}
    for r in pods.collect():
        got.setdefault(r.cluster, {})[r.pod] = r.uid
    assert {c: got.get(c, {}) for c in want} == {c: w[0] for c, w in want.items()}
    assert {r.cluster: r.generation for r in generation.collect()} == {c: w[1] for c, w in want.items()}
    assert membership.pod_problems(spark.createDataFrame(rows, schema)).count() == 0
    bad = [(9, 1, "apply", "p", "u", True), (9, 2, "init_apply", "p", "u", True), (9, 3, "init", None, None, False), (9, 4, "init_apply", "p", "u", True), (9, 5, "init_apply", "p", "v", True), (9, 6, "delete", "p", "u", True), (9, 7, "init_done", None, None, False), (9, 8, "init_done", None, None, False)]
    assert {r.at: r.problem for r in membership.pod_problems(spark.createDataFrame(bad, schema)).collect()} == {1: "before the first list", 2: "no list is open", 5: "pod twice in a list", 6: "before the first list", 8: "no list is open"}


def test_compressed_values_and_lookups(spark):
    import pyarrow as pa

    pack = lambda b: bytearray(pa.compress(b, codec="snappy", asbytes=True))
    rows = [(1, 3, pack(b"{}" * 99), None), (2, 1, bytearray(b"plain"), None), (3, 2, bytearray(b"\xff\xff\xff\xff\x0fx"), None), (4, 2, bytearray(b"\x05ab"), None), (5, 2, bytearray(b""), None), (6, 6, pack(b""), None), (7, 2, None, "short body")]
    x = spark.createDataFrame(rows, "i int, datatype smallint, value binary, malformed string")
    got = {r.i: (r.datatype, r.value and bytes(r.value), r.malformed) for r in wire.decompressed(x).collect()}
    assert got[1] == (1, b"{}" * 99, None) and got[2] == (1, b"plain", None) and got[6] == (4, b"", None)
    assert [got[i][2] for i in (3, 4, 5, 7)] == ["value too large", "bad snappy value", "bad snappy value", "short body"]
    refused = {r.i: (r.value, r.malformed) for r in wire.decompressed(x, negotiated=False).collect()}
    assert refused[1] == (None, "compression was not negotiated") and bytes(refused[2][0]) == b"plain"
    ids = spark.createDataFrame([(0, bytearray(struct.pack(">QI", 7, 9))), (0, bytearray(b"x")), (1, bytearray(12))], "s int, e binary").select(wire.collection_id_response(F.col("s"), F.col("e")).alias("r")).collect()
    assert [r.r and (int(r.r.manifest_uid), r.r.collection_id) for r in ids] == [(7, 9), None, None]


def test_numbers_of_64_bits_and_wide_maps(spark):
    x = spark.createDataFrame([("ffffffffffffffff",), ("7fffffffffffffff",), ("0000000000000000001",), ("1ffffffffffffffff",), ("x",), ("",)], "t string").select(columns.hex_number(F.col("t")).alias("n")).collect()
    assert [r.n for r in x] == [-1, 2**63 - 1, 1, None, None, None]
    doc = {"rev": 1, "vBucketServerMap": {"numReplicas": 99, "serverList": [f"s{i}" for i in range(100)], "vBucketMap": [list(range(100))]}}
    assert len(topology.parse_routes(spark.createDataFrame([(json.dumps(doc),)], "json string")).first().replicas) == 99


def test_registry_follows_scopes(spark):
    dim = spark.createDataFrame([(5, 8, "s", 1, "a")], "manifest_uid bigint, scope_id bigint, scope string, collection_id bigint, collection string")
    changes = spark.createDataFrame([(4, "create_collection", 8, 9, "old"), (6, "create_collection", 8, 2, "b"), (7, "create_collection", 9, 3, "other scope"), (8, "drop_scope", 8, None, None), (9, "create_collection", 8, 4, "a"), (10, "flush_collection", 8, 4, None)], "manifest_uid bigint, sys_kind string, scope_id bigint, collection_id bigint, name string")
    got = {(r.collection_id, r.name, r.from_uid, r.to_uid) for r in collections.name_versions(dim, changes, 8).collect()}
    assert got == {(1, "a", 5, 8), (2, "b", 6, 8), (4, "a", 9, None)}
    assert {r.name for r in collections.name_versions(dim, changes, 8, whole_scope=False).collect()} == {"a"}
    assert collections.registry_problems(dim, changes, 8).count() == 0
    assert collections.registry_status(dim, changes).first().asDict() == {"manifest_uid": 10, "stale": False}
    assert collections.registry_status(dim, changes.limit(0)).first().asDict() == {"manifest_uid": 5, "stale": False}


def test_a_bucket_that_is_another_one(spark):
    doc = lambda uuid, rev: json.dumps({"rev": rev, "revEpoch": 1, "name": "b", "uuid": uuid, "vBucketServerMap": {"numReplicas": 0, "serverList": ["x", "y"], "vBucketMap": [[0], [1]]}})
    routes = lambda *a: topology.parse_routes(spark.createDataFrame([(doc(*a),)], "json string"))
    assert [r.change for r in topology.apply_revisions(routes("u", 1), routes("v", 2), 1).collect()] == ["bucket uuid changed"]
    assert topology.apply_revisions(routes("u", 3), routes("u", 2), 1).count() == 0


def test_endpoints_and_networks(spark):
    """Every branch of the choice of a network; nodes without data, a name, a port or an address; documents that can't be used."""
    node = lambda i, kv=11210, ssl=11207, **more: {"nodeUUID": f"node-{i}", "hostname": f"10.0.0.{i}", "services": {"kv": kv, "kvSSL": ssl}, "alternateAddresses": {"external": {"hostname": "proxy.test", "ports": {"kv": 31000 + i, "kvSSL": 31100 + i}}}, **more}
    two, servers = [node(1, serverGroup="g"), node(2)], ["10.0.0.1:11210", "10.0.0.2:11210"]
    cases = {
        "inside": (two, servers, "auto", False, "10.0.0.1:11210"), "outside": (two, servers, "auto", True, "proxy.test:31101"), "no outer address": ([node(1), node(2, alternateAddresses=None)], servers, "auto", True, "proxy.test:31101"),
        "external": (two, servers, "external", False, "10.0.0.1:11210"), "named": (two, servers, "lab", False, "10.0.0.1:11210"), "bad name": (two, servers, "a b", False, "x:1"), "query node first": ([{"hostname": "q", "services": {}}, node(1, hostname=None), node(2)], servers, "default", False, "10.0.0.9:11210"),
        "v6": ([node(1, hostname="fd00::1"), node(2, hostname="[fd00::2]")], servers, "auto", False, "[FD00::1]:11210"), "no tls port": ([node(1, ssl=0), node(2)], servers, "default", True, "x:1"), "no uuid": ([node(1, nodeUUID=""), node(2, nodeUUID=None)], ["a.lan:1", "[fd00::3]:2"], "default", False, "x:1"),
        "own ports": ([node(1, alternateAddresses={"external": {"hostname": "e"}}), node(2)], servers, "external", True, "x:1"), "old": ([], servers, "auto", False, "x:1"), "old tls": ([], servers, "auto", True, "x:1"), "old external": ([], servers, "external", False, "x:1"),
        "few": ([node(1)], servers, "auto", False, "x:1"), "none": (two, [], "auto", False, "x:1"), "odd server": ([], ["fd00::1:11210"], "auto", False, "x:1"), "white": ([node(1, hostname="a b"), node(2)], servers, "default", False, "x:1"),
    }
    rows = [(k, json.dumps({"nodesExt": n, "vBucketServerMap": {"serverList": s}}), r, tls, src) for k, (n, s, r, tls, src) in cases.items()]
    got = {}
    for r in endpoints.endpoints(spark.createDataFrame(rows, "k string, json string, requested string, tls boolean, source string")).orderBy("k", "server").collect():
        got.setdefault(r.k, []).append((r.network, r.node, r.address, r.canonical, r.server_group) if r.problem is None else r.problem)
    assert got["inside"] == [("default", "node-1", "10.0.0.1:11210", "10.0.0.1:11210", "g"), ("default", "node-2", "10.0.0.2:11210", "10.0.0.2:11210", None)]
    assert got["outside"] == [("external", "node-1", "proxy.test:31101", "10.0.0.1:11207", "g"), ("external", "node-2", "proxy.test:31102", "10.0.0.2:11207", None)]
    assert [x[0] for x in got["no outer address"]] == ["default", "default"] and [x[2] for x in got["external"]] == ["proxy.test:31001", "proxy.test:31002"]
    assert got["named"] == ["no address in the network"] * 2 and got["bad name"] == ["bad network name"]
    assert [x[1:3] for x in got["query node first"]] == [("node-1", "10.0.0.9:11210"), ("node-2", "10.0.0.2:11210")]
    assert [x[:3] for x in got["v6"]] == [("default", "node-1", "[fd00::1]:11210"), ("default", "node-2", "[fd00::2]:11210")]
    assert got["no tls port"][0] == "no kvSSL port" and [x[1] for x in got["no uuid"]] == ["a.lan:1", "[fd00::3]:2"] and got["own ports"][0][2] == "e:11207"
    assert [x[1:3] for x in got["old"]] == [(s, s) for s in servers] and got["old tls"] == ["tls needs nodes"] and got["old external"] == ["the network needs nodes"]
    assert got["few"] == ["fewer data nodes than servers"] and got["none"] == ["no servers"] and got["odd server"] == ["bad server address"] and got["white"][0] == "bad host name"


def test_encoding_is_the_inverse_of_decoding(spark):
    """Column-wise frames equal the ones put together byte by byte, for every kind, both magics and all lengths of a collection's number."""
    big = 2**64 - 1
    made = [(0x57, b"e" * 28, leb128(n) + b"key", b"value", 9, big, 3, wire.REQUEST, b"") for n in (0, 127, 128, 16383, 16384, 2**21, 2**28, 2**32 - 1)]
    made += [(op, b"x" * 20, leb128(300) + b"k" if op in wire.KEYED else b"plain", b"", 1023, 2**63, 1, wire.ALT_REQUEST, bytes([0x22, 0, 7])) for op in wire.OPCODES]
    made += [(0x57, b"", b"", b"v" * 100_000, 0, 0, 0, m, b"") for m in (wire.RESPONSE, wire.ALT_RESPONSE)]
    raw = [encode_frame(op, ex, key, value, target=t, cas=c, datatype=d, magic=m, framing=f) for op, ex, key, value, t, c, d, m, f in made]
    decoded = wire.decode_frames(spark.createDataFrame([(i, bytearray(f)) for i, f in enumerate(raw)], "i int, frame binary"))
    got = wire.encode_frames(decoded.drop("frame")).orderBy("i").collect()
    assert [bytes(r.frame) for r in got] == raw and not any(r.problem for r in got)
    rows = [(1, 0x80, 87, bytearray(b"k" * 65_535), None, None), (2, 0x80, 87, bytearray(b"k" * 65_536), None, None), (3, 0x08, 87, bytearray(b"k" * 256), None, None), (4, 0x80, 87, bytearray(b"k"), 2**32, None), (5, 0x80, 87, bytearray(b"k"), None, bytearray(b"f")), (6, 0x08, 87, bytearray(b"k"), None, bytearray(b"f" * 256))]
    bad = {r.i: r.problem for r in wire.encode_frames(spark.createDataFrame(rows, "i int, magic int, opcode int, key binary, collection_id bigint, framing binary")).collect()}
    assert bad == {1: None, 2: "key too long", 3: "key too long", 4: "collection id too large", 5: "framing extras need the other magic", 6: "framing extras too long"}


def test_a_dropped_scope_closes_its_own_names_only(spark):
    manifest = {"uid": "1", "scopes": [{"uid": "8", "name": "s", "collections": [{"uid": "8", "name": "a"}]}, {"uid": "9", "name": "t", "collections": [{"uid": "9", "name": "b"}]}]}
    dim = collections.parse_manifest(spark.createDataFrame([(json.dumps(manifest),)], "json string"))
    rows = [(2, "create_collection", 8, 20, "c"), (3, "drop_scope", 8, None, None), (4, "create_collection", 9, 21, "d")]
    changes = spark.createDataFrame(rows, "manifest_uid bigint, sys_kind string, scope_id bigint, collection_id bigint, name string")
    got = {r.collection_id: (r.name, r.from_uid, r.to_uid) for r in collections.name_versions(dim, changes).collect()}
    assert got == {8: ("a", 1, 3), 9: ("b", 1, None), 20: ("c", 2, 3), 21: ("d", 4, None)}
    assert {r.collection_id: r.to_uid for r in collections.name_versions(dim, changes.drop("scope_id")).collect()} == {8: 3, 9: 3, 20: 3, 21: None}
