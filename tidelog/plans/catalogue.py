"""One query per operator over the driver's tables, and the same in SQL."""

from __future__ import annotations

import json
import struct


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import columns as C
from tidelog.functions import wire
from tidelog.operators import ack, collections, filters, gate, membership, metrics, order, rollback, topology
from tidelog.sources import checkpoints, synth
from tidelog.sources.synth import LOG_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}
CUTOFF_NS = 1_704_500_000_500_000_000


def query(sql: str | None = None, log: bool = True):
    """Registers a query under its function's name, with its SQL (behind the log's definition unless log is False)."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = f"WITH {LOG_SQL}{', ' if sql.lstrip().startswith('AND ') else ''}{sql.lstrip().removeprefix('AND ')}" if log else sql
        return f

    return add


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.change_log(synth.events(spark, sf_dir))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.with_markers(_log(spark, sf_dir))


@query("""SELECT g.shard, g.high AS high_seqno, coalesce(max(CASE WHEN g.gap IS NULL OR l.seqno < g.gap THEN l.seqno END), 0)::BIGINT AS processed,
  count(CASE WHEN l.seqno >= g.gap THEN 1 END) AS pending
FROM log l JOIN (SELECT shard, max(seqno) AS high, min(CASE WHEN NOT acked THEN seqno END) AS gap FROM log GROUP BY shard) g ON l.shard = g.shard GROUP BY ALL""")
def k2_contiguous_progress(spark, sf_dir):
    return ack.contiguous_progress(_log(spark, sf_dir))


@query("SELECT shard, max(seqno)::BIGINT AS high_seqno FROM log GROUP BY shard")
def a8_high_seqno(spark, sf_dir):
    return rollback.high_seqnos(_log(spark, sf_dir))


@query("SELECT shard, max(seqno)::BIGINT AS high_seqno FROM log WHERE collection_id IN (8, 10) GROUP BY shard")
def a9_selection_high_seqno(spark, sf_dir):
    return rollback.high_seqnos(_log(spark, sf_dir), [8, 10])


def _stored(spark, sf_dir):
    """A checkpoint of every shard not divisible by 3, at its last acknowledged event."""
    x = _log(spark, sf_dir).where("shard % 3 <> 0 AND acked").groupBy("shard").agg(F.max(F.struct("seqno", "snap_start", "snap_end")).alias("c"))
    return x.select("shard", (F.col("shard") + 1000).cast("bigint").alias("branch"), (F.col("c.seqno") + F.when(F.col("shard") == 5, 9).otherwise(0)).alias("seqno"), "c.snap_start", (F.col("c.snap_end") + F.when(F.col("shard") == 5, 9).otherwise(0)).alias("snap_end"), F.lit(None).cast("bigint").alias("manifest_uid"))


STORED_SQL = """AND stored AS (SELECT shard, (shard + 1000)::BIGINT AS branch, max(seqno) + CASE WHEN shard = 5 THEN 9 ELSE 0 END AS seqno, max(snap_start) AS snap_start,
  max(snap_end) + CASE WHEN shard = 5 THEN 9 ELSE 0 END AS snap_end FROM log WHERE shard % 3 <> 0 AND acked GROUP BY shard)"""


def _assigned(spark):
    return spark.range(synth.SHARDS).select(F.col("id").cast("int").alias("shard"))


@query(STORED_SQL + " SELECT a.shard::INT AS shard, s.branch, s.seqno, s.snap_start, s.snap_end, CASE WHEN s.shard IS NULL THEN 'earliest' ELSE 'checkpoint' END AS start FROM range(16) a(shard) LEFT JOIN stored s ON a.shard = s.shard")
def a6_initial_starts(spark, sf_dir):
    return rollback.initial_starts(_assigned(spark), _stored(spark, sf_dir)).drop("manifest_uid")


@query(STORED_SQL + """, highs AS (SELECT shard, max(seqno) AS high FROM log GROUP BY shard)
SELECT a.shard::INT AS shard, CASE WHEN s.shard IS NULL THEN 'earliest' ELSE 'checkpoint' END AS start, coalesce(s.branch, 7 + a.shard)::BIGINT AS branch, coalesce(s.seqno, 0)::BIGINT AS start_seqno, coalesce(h.high, 0)::BIGINT AS end_seqno,
  coalesce(s.seqno = 0, false) AS strict_branch, CASE WHEN s.seqno > h.high THEN h.high END::BIGINT AS rollback_to FROM range(16) a(shard) LEFT JOIN highs h ON a.shard = h.shard LEFT JOIN stored s ON a.shard = s.shard""")
def a5_resolve_starts(spark, sf_dir):
    newest = _assigned(spark).select("shard", (F.col("shard") + 7).cast("bigint").alias("branch"))
    x = rollback.resolve_starts(rollback.initial_starts(_assigned(spark), _stored(spark, sf_dir)), rollback.high_seqnos(_log(spark, sf_dir)), newest, finite=True)
    return x.select("shard", "start", F.col("branch").cast("bigint").alias("branch"), "start_seqno", "end_seqno", "strict_branch", "rollback_to")


@query("SELECT l.event_id, l.shard, l.seqno FROM log l JOIN (SELECT shard, max(seqno) // 2 AS e FROM log GROUP BY shard) m ON l.shard = m.shard WHERE l.seqno <= m.e")
def a7_finite_scan(spark, sf_dir):
    log = _log(spark, sf_dir)
    ends = rollback.high_seqnos(log).select("shard", F.floor(F.col("high_seqno") / 2).alias("end_seqno"))
    return rollback.finite_scan(log, ends).select("event_id", "shard", "seqno")


@query(f"SELECT event_id, NOT ({CUTOFF_NS} > cas // 1000000000 * 1000000000) AS delivered, acked OR {CUTOFF_NS} > cas // 1000000000 * 1000000000 AS acked FROM log")
def c1_skip_until(spark, sf_dir):
    return filters.skip_until(_log(spark, sf_dir), CUTOFF_NS).select("event_id", "delivered", "acked")


@query(f"""AND s AS (SELECT shard, seqno, acked OR {CUTOFF_NS} > cas // 1000000000 * 1000000000 AS acked FROM log), g AS (SELECT shard, max(seqno) AS high, min(CASE WHEN NOT acked THEN seqno END) AS gap FROM s GROUP BY shard)
SELECT g.shard, g.high AS high_seqno, coalesce(max(CASE WHEN g.gap IS NULL OR s.seqno < g.gap THEN s.seqno END), 0)::BIGINT AS processed, count(CASE WHEN s.seqno >= g.gap THEN 1 END) AS pending FROM s JOIN g USING (shard) GROUP BY ALL""")
def c2_skip_progress(spark, sf_dir):
    return ack.contiguous_progress(filters.skip_until(_log(spark, sf_dir), CUTOFF_NS))


@query("SELECT event_id, collection_id & 1 = 1 AS has_1, collection_id & 2 = 2 AS has_2, collection_id & 10 = 10 AS has_10, rev_seqno = 1 AS created FROM log")
def c5_flag_bits(spark, sf_dir):
    c = F.col("collection_id")
    return _log(spark, sf_dir).select("event_id", C.has_bits(c, 1).alias("has_1"), C.has_bits(c, 2).alias("has_2"), C.has_bits(c, 10).alias("has_10"), C.is_created(F.col("rev_seqno")).alias("created"))


@query("SELECT shard, kind, count(*) AS n, count(seqno) AS with_seqno FROM marked WHERE collection_id IN (8, 11) OR collection_id IS NULL GROUP BY shard, kind")
def c3_collection_filter(spark, sf_dir):
    x = filters.in_collections(_marked(spark, sf_dir), [8, 11])
    return x.groupBy("shard", "kind").agg(F.count("*").alias("n"), F.count(C.event_seqno(F.col("kind"), F.col("seqno"))).alias("with_seqno"))


@query("SELECT event_id FROM log WHERE event_id % 5 = 3 AND shard < 6")
def c9_generation_fence(spark, sf_dir):
    x = _log(spark, sf_dir).withColumns({"connection_generation": F.col("event_id") % 5})
    return filters.owned(filters.current_generation(x, 3), membership.balanced(spark, 16, 3).where("member = 1")).select("event_id")


ORDER_SQL = """AND a AS (SELECT *, last_value(snap_start IGNORE NULLS) OVER w AS s, last_value(snap_end IGNORE NULLS) OVER w AS e, coalesce(max(seqno) OVER (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
  FROM marked WINDOW w AS (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
v AS (SELECT *, CASE WHEN kind = 'snapshot_marker' THEN CASE WHEN e < prev THEN 'marker_behind' END WHEN e IS NULL THEN 'no_snapshot' WHEN seqno < s OR seqno > e THEN 'outside' WHEN seqno <= prev THEN 'non_monotonic' END AS violation FROM a)
"""


@query(ORDER_SQL + "SELECT shard, arrival, violation, coalesce(max(violation IS NOT NULL) OVER (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS unreached FROM v")
def d4_order_violations(spark, sf_dir):
    return order.check_order(_marked(spark, sf_dir)).select("shard", "arrival", "violation", "unreached")


@query(ORDER_SQL + "SELECT shard, arrival, s AS snap_start, e AS snap_end FROM a")
def d6_snapshot_attach(spark, sf_dir):
    return order.attach_snapshot(_marked(spark, sf_dir)).select("shard", "arrival", "snap_start", "snap_end")


def _failover(log):
    """Six branches per shard, newest first."""
    h = log.groupBy("shard").agg(F.max("seqno").alias("high"))
    return h.select("shard", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("pos"), "high").select("shard", "pos", (F.col("shard") * 100 + F.col("pos")).cast("bigint").alias("branch"), F.floor(F.col("high") * (5 - F.col("pos")) / 6).cast("bigint").alias("seqno"))


FAILOVER_SQL = "AND f AS (SELECT shard, p::INT AS pos, (shard * 100 + p)::BIGINT AS branch, (high * (5 - p) // 6)::BIGINT AS seqno FROM (SELECT shard, max(seqno) AS high FROM log GROUP BY shard), range(6) r(p))"


@query(FAILOVER_SQL + """, r AS (SELECT DISTINCT shard, seqno AS rollback_seqno FROM log)
SELECT shard, rollback_seqno, branch, bs AS branch_seqno, CASE WHEN branch IS NOT NULL THEN rollback_seqno END AS seqno FROM (
  SELECT r.shard, r.rollback_seqno, f.branch, f.seqno AS bs, row_number() OVER (PARTITION BY r.shard, r.rollback_seqno ORDER BY f.pos) AS k FROM r LEFT JOIN f ON f.shard = r.shard AND f.seqno <= r.rollback_seqno) WHERE k = 1""")
def e7_failover_branch(spark, sf_dir):
    log = _log(spark, sf_dir)
    r = log.select("shard", F.col("seqno").alias("rollback_seqno")).distinct()
    return rollback.rewind(r, _failover(log)).select("shard", "rollback_seqno", "branch", "branch_seqno", "seqno")


@query("SELECT event_id, CASE WHEN s > e THEN 'start after end' WHEN q > e THEN 'seqno after end' WHEN q <> 0 AND q < s THEN 'seqno before start' END AS problem, q < 50 AS moves_back FROM (SELECT event_id, seqno - event_id % 3 * 40 AS q, snap_start + event_id % 11 * 10 AS s, snap_end AS e FROM log)")
def e11_checkpoint_invariants(spark, sf_dir):
    x = _log(spark, sf_dir).select("event_id", (F.col("seqno") - F.col("event_id") % 3 * 40).alias("seqno"), (F.col("snap_start") + F.col("event_id") % 11 * 10).alias("snap_start"), "snap_end")
    return x.select("event_id", rollback.invariant_broken().alias("problem"), rollback.moves_back(F.lit(50), F.col("seqno")).alias("moves_back"))


@query("""SELECT shard, CASE WHEN n IS NULL THEN 'missing' WHEN w IS NULL THEN 'unexpected' WHEN n > 1 THEN 'twice' ELSE 'end before start' END AS problem FROM (SELECT i::INT AS shard, 1 AS w FROM range(16) t(i) WHERE i <> 11) FULL JOIN (
  SELECT shard, count(*) AS n, min(e - s) AS d FROM (SELECT (user_id % 16)::INT AS shard, 0 AS s, CASE WHEN user_id % 16 = 4 THEN -1 ELSE 5 END AS e FROM (SELECT DISTINCT user_id % 16 AS user_id FROM events WHERE user_id % 16 <> 2) UNION ALL SELECT 9, 0, 5) GROUP BY shard) USING (shard)
WHERE n IS NULL OR w IS NULL OR n > 1 OR d < 0""", log=False)
def e13_open_set_difference(spark, sf_dir):
    shards = synth.events(spark, sf_dir).select((F.col("user_id") % 16).cast("int").alias("shard")).distinct().where("shard <> 2")
    opened = shards.union(spark.range(1).select(F.lit(9).alias("shard"))).select("shard", F.lit(0).alias("start_seqno"), F.when(F.col("shard") == 4, -1).otherwise(5).alias("end_seqno"))
    return rollback.set_difference(_assigned(spark).where("shard <> 11"), opened)


def _observations(log):
    """Three answers per shard and cycle of 64 seqnos, some missing, failed, on another branch or behind."""
    c = log.groupBy("shard", F.floor((F.col("seqno") - 1) / 64).alias("cycle")).agg(F.max("seqno").alias("at"))
    x = c.select("shard", "cycle", "at", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    h = F.col("shard") * 31 + F.col("cycle") * 7 + F.col("k")
    obs = x.where(h % 13 != 5).select(
        "cycle", "shard", F.concat(F.lit("n"), F.col("k").cast("string")).alias("node"), (h % 17 != 3).alias("ok"), (h % 41 == 8).alias("did_failover"), F.col("shard").alias("obs_shard"), F.when(h % 29 == 4, 1).otherwise(99).cast("bigint").alias("branch"),
        (F.col("at") - F.col("k") * 3 - F.when(h % 23 == 6, 100).otherwise(0)).alias("persisted"), F.col("at").alias("current"),
    )
    return obs, c.select("cycle", "shard", F.lit(99).cast("bigint").alias("branch"), F.lit(3).alias("copies"))


OUTCOME_SQL = """AND c AS (SELECT shard, (seqno - 1) // 64 AS cycle, max(seqno) AS hi FROM log GROUP BY ALL),
o AS (SELECT c.shard, cycle, hi, k, shard * 31 + cycle * 7 + k AS h FROM c, range(3) r(k)),
ob AS (SELECT *, h % 17 <> 3 AS ok, h % 41 = 8 OR h % 29 = 4 AS ch, hi - k * 3 - CASE WHEN h % 23 = 6 THEN 100 ELSE 0 END AS p FROM o WHERE h % 13 <> 5),
outcome AS (SELECT c.shard, c.cycle, CASE WHEN coalesce(bool_or(ok AND ch), false) THEN 'branch_changed' WHEN count(ob.k) <> 3 THEN 'incomplete' WHEN bool_or(NOT ok OR p > ob.hi) THEN 'transient' ELSE 'persisted' END AS outcome, min(p) AS least
  FROM c LEFT JOIN ob ON c.shard = ob.shard AND c.cycle = ob.cycle GROUP BY c.shard, c.cycle)
"""


@query(OUTCOME_SQL + "SELECT shard, cycle, outcome, CASE WHEN outcome = 'persisted' THEN least END::BIGINT AS persisted FROM outcome")
def f2_observation_outcome(spark, sf_dir):
    return gate.outcomes(*_observations(_log(spark, sf_dir)))


# a watermark depends on what follows the last cycle that cleared it; the recursion goes cycle by cycle
FOLD_SQL = """AND RECURSIVE_ro AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY cycle) AS i FROM outcome),
fold AS (SELECT shard, 0::BIGINT AS i, NULL::BIGINT AS w FROM (SELECT DISTINCT shard FROM outcome)
  UNION ALL SELECT f.shard, r.i, CASE WHEN r.outcome IN ('incomplete', 'transient') THEN f.w WHEN r.outcome = 'branch_changed' OR r.least < f.w THEN NULL ELSE r.least END
  FROM fold f JOIN RECURSIVE_ro r ON r.shard = f.shard AND r.i = f.i + 1),
mark AS (SELECT shard, max_by(w, i) AS watermark, any_value(n) FROM (SELECT f.*, max(i) OVER (PARTITION BY shard) AS n FROM fold f) WHERE i = n GROUP BY shard)
"""


def _recursive(tail: str) -> str:
    body = OUTCOME_SQL.removeprefix("AND ") + ", " + FOLD_SQL.removeprefix("AND ")
    return f"WITH RECURSIVE {LOG_SQL}, {body}{tail}"


@query(_recursive("SELECT shard, (SELECT f.w FROM fold f WHERE f.shard = m.shard ORDER BY i DESC LIMIT 1) AS watermark FROM mark m"), log=False)
def f3_watermark_fold(spark, sf_dir):
    return gate.watermarks(gate.outcomes(*_observations(_log(spark, sf_dir))))


@query("""AND m AS (SELECT shard, CASE WHEN shard % 5 <> 0 THEN max(seqno) // 2 END AS w FROM log GROUP BY shard),
s AS (SELECT k.shard, arrival, coalesce(CASE WHEN kind = 'snapshot_marker' THEN snap_start ELSE seqno END <= m.w, false) AS safe FROM marked k JOIN m ON k.shard = m.shard)
SELECT shard, arrival, bool_and(safe) OVER (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS delivered FROM s""")
def f5_gate(spark, sf_dir):
    log = _log(spark, sf_dir)
    marks = log.groupBy("shard").agg(F.floor(F.max("seqno") / 2).alias("watermark")).where("shard % 5 <> 0")
    return gate.hold_unsafe(synth.with_markers(log), marks).select("shard", "arrival", "delivered")


MANIFEST = {"uid": "2a", "scopes": [{"uid": "0", "name": "_default", "collections": []}, {"uid": "8", "name": "shop", "collections": [
    {"uid": "8", "name": "clicks", "maxTTL": 60, "history": True}, {"uid": "9", "name": "views"}, {"uid": "a", "name": "purchases"}]}]}


def _dim(spark):
    return collections.parse_manifest(spark.createDataFrame([(json.dumps(MANIFEST),)], "json string"))


@query("SELECT event_id, CASE collection_id WHEN 8 THEN 'clicks' WHEN 9 THEN 'views' WHEN 10 THEN 'purchases' END AS collection_name FROM log")
def g1_decorate(spark, sf_dir):
    """Documents of collection 11, which the manifest doesn't have, have no name."""
    return collections.decorate(_log(spark, sf_dir), _dim(spark), strict=False).select("event_id", "collection_name")


def _with_schema_events(log):
    """Each shard creates collection 11 (manifest 43) at a third and drops 9 (manifest 44) at two thirds of its events."""
    h = log.groupBy("shard").agg(F.max("seqno").alias("high"))
    made = h.select("shard", F.explode(F.array(F.struct(F.lit(43).alias("u"), F.floor(F.col("high") / 3).alias("q")), F.struct(F.lit(44).alias("u"), F.floor(F.col("high") * 2 / 3).alias("q")))).alias("x"))
    sys = made.select(F.lit(None).cast("bigint").alias("event_id"), "shard", (F.col("x.q") * 4 + 2).alias("arrival"), F.lit("system_event").alias("kind"), F.lit(None).cast("bigint").alias("collection_id"), F.col("x.u").cast("bigint").alias("manifest_uid"))
    return log.select("event_id", "shard", "arrival", "kind", "collection_id", F.lit(None).cast("bigint").alias("manifest_uid")).union(sys)


SCHEMA_SQL = "AND h AS (SELECT shard, max(seqno) AS high FROM log GROUP BY shard), ev AS (SELECT event_id, shard, arrival, kind, collection_id, NULL::BIGINT AS uid FROM log UNION ALL SELECT NULL, shard, high // 3 * 4 + 2, 'system_event', NULL, 43 FROM h UNION ALL SELECT NULL, shard, high * 2 // 3 * 4 + 2, 'system_event', NULL, 44 FROM h)"


@query(SCHEMA_SQL + """, v AS (SELECT *, greatest(42, coalesce(max(uid) OVER (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 42)) AS version FROM ev)
SELECT event_id, version AS manifest_version, CASE WHEN collection_id = 8 THEN 'clicks' WHEN collection_id = 9 AND version < 44 THEN 'views' WHEN collection_id = 10 THEN 'purchases' WHEN collection_id = 11 AND version >= 43 THEN 'hotels' END AS collection_name FROM v WHERE event_id IS NOT NULL""")
def g2_versioned_names(spark, sf_dir):
    changes = spark.createDataFrame([(43, "create_collection", 11, "hotels"), (44, "drop_collection", 9, None)], "manifest_uid bigint, sys_kind string, collection_id bigint, name string")
    x = collections.decorate_versioned(_with_schema_events(_log(spark, sf_dir)), collections.name_versions(_dim(spark), changes), 42)
    return x.where("event_id IS NOT NULL").select("event_id", "manifest_version", "collection_name")


@query(SCHEMA_SQL + " SELECT event_id, shard, arrival, coalesce(last_value(uid IGNORE NULLS) OVER (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 42) AS checkpoint_manifest FROM ev")
def k1_manifest_carry(spark, sf_dir):
    x = _with_schema_events(_log(spark, sf_dir)).withColumn("start_uid", F.lit(42).cast("bigint"))
    return ack.carry_manifest(x, "start_uid").select("event_id", "shard", "arrival", "checkpoint_manifest")


# DuckDB has no crc32: its table is built from the polynomial
CRC_SQL = """WITH RECURSIVE t(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM t WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS l FROM t WHERE k = 8),
keys AS (SELECT DISTINCT user_id, 'user::' || user_id AS key FROM events),
chars AS (SELECT user_id, key, 1 AS pos, 4294967295::BIGINT AS crc FROM keys UNION ALL
  SELECT user_id, key, pos + 1, xor((SELECT l FROM tab)[(xor(crc, ascii(key[pos])) & 255) + 1], crc >> 8) FROM chars WHERE pos <= length(key))
SELECT user_id, (((xor(crc, 4294967295) >> 16) & 32767) % 1024)::INT AS shard FROM chars WHERE pos = length(key) + 1"""


@query(CRC_SQL, log=False)
def h1_shard_of_key(spark, sf_dir):
    keys = synth.events(spark, sf_dir).select("user_id").distinct()
    return keys.select("user_id", C.shard_of(F.concat(F.lit("user::"), F.col("user_id").cast("string")), 1024).alias("shard"))


MEMBERS_SQL = "m AS (SELECT 'm' || user_id AS member_id, min(event_id) AS joined_at, max(event_id) AS heartbeat_at FROM events GROUP BY user_id)"


def _members(spark, sf_dir):
    return synth.events(spark, sf_dir).groupBy("user_id").agg(F.min("event_id").alias("joined_at"), F.max("event_id").alias("heartbeat_at")).select(F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("member_id"), "joined_at", "heartbeat_at")


@query(f"WITH {MEMBERS_SQL} SELECT member_id, joined_at, heartbeat_at FROM m WHERE NOT (greatest(10000 - heartbeat_at, 0) >= 60)", log=False)
def i6_prune_stale(spark, sf_dir):
    return membership.prune(_members(spark, sf_dir), 10000, 60)


@query(f"WITH {MEMBERS_SQL} SELECT member_id, joined_at, heartbeat_at, row_number() OVER (ORDER BY joined_at, member_id)::INT AS member_number FROM m", log=False)
def i8_member_number(spark, sf_dir):
    return membership.member_numbers(_members(spark, sf_dir))


@query("SELECT k.kind, count(m.kind) AS events FROM (VALUES ('mutation'), ('deletion'), ('expiration'), ('snapshot_marker'), ('stream_end'), ('seqno_advanced'), ('system_event'), ('oso_snapshot')) k(kind) LEFT JOIN marked m ON m.kind = k.kind GROUP BY k.kind")
def j1_kind_counts(spark, sf_dir):
    return metrics.kind_counts(_marked(spark, sf_dir))


@query("""AND k AS (SELECT k.kind, count(m.kind)::DOUBLE AS n FROM (VALUES ('mutation'), ('deletion'), ('expiration'), ('snapshot_marker'), ('stream_end'), ('seqno_advanced'), ('system_event'), ('oso_snapshot')) k(kind) LEFT JOIN marked m ON m.kind = k.kind GROUP BY k.kind)
SELECT 'changelog_events_total' AS name, kind AS label, n AS value FROM k UNION ALL SELECT 'changelog_delivered_total', '', sum(n) FROM k
UNION ALL SELECT 'changelog_health_status', s, CASE WHEN s = 'healthy' THEN 1.0 ELSE 0.0 END::DOUBLE FROM (VALUES ('starting'), ('healthy'), ('degraded'), ('stopped')) v(s)""")
def j5_metric_families(spark, sf_dir):
    return metrics.families(_marked(spark, sf_dir))


@query("""AND g AS (SELECT user_id, event_id, event_type <> 'error' AS ok, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS i FROM events)
SELECT user_id AS target, event_id AS at, ok, (sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, i ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS consecutive_failures, CASE WHEN ok THEN 'healthy' ELSE 'degraded' END AS status FROM g""")
def j4_health_runs(spark, sf_dir):
    p = synth.events(spark, sf_dir).select(F.col("user_id").alias("target"), F.col("event_id").alias("at"), (F.col("event_type") != "error").alias("ok"))
    return metrics.health_runs(p)


@query(f"""WITH RECURSIVE {LOG_SQL}, fold AS (SELECT shard, 0::BIGINT AS i, 0::BIGINT AS pending, 0::BIGINT AS flushes, 0::BIGINT AS flushed FROM (SELECT DISTINCT shard FROM log)
  UNION ALL SELECT f.shard, l.seqno, CASE WHEN f.pending + 24 + l.event_id % 300 >= 4000 THEN 0 ELSE f.pending + 24 + l.event_id % 300 END, f.flushes + CASE WHEN f.pending + 24 + l.event_id % 300 >= 4000 THEN 1 ELSE 0 END,
    f.flushed + CASE WHEN f.pending + 24 + l.event_id % 300 >= 4000 THEN f.pending + 24 + l.event_id % 300 ELSE 0 END FROM fold f JOIN log l ON l.shard = f.shard AND l.seqno = f.i + 1)
SELECT shard, flushes, flushed, pending AS remainder FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY i DESC) AS k FROM fold) WHERE k = 1""", log=False)
def j10_flow_credit(spark, sf_dir):
    x = _log(spark, sf_dir).select("shard", "arrival", (F.lit(24) + F.col("event_id") % 300).alias("wire_size"))
    return metrics.flow_credit(x, metrics.credit_threshold(20_000, 0.2) - 1)


@query(STORED_SQL + ", now AS (SELECT shard, max(seqno) AS seqno, max(snap_start) AS snap_start, max(snap_end) AS snap_end FROM log WHERE acked GROUP BY shard) SELECT n.* FROM now n LEFT JOIN stored s ON n.shard = s.shard WHERE s.shard IS NULL OR s.seqno <> n.seqno")
def k5_dirty(spark, sf_dir):
    now = _log(spark, sf_dir).where("acked").groupBy("shard").agg(F.max("seqno").alias("seqno"), F.max("snap_start").alias("snap_start"), F.max("snap_end").alias("snap_end"))
    return ack.dirty(now, _stored(spark, sf_dir))


@query(STORED_SQL + """ SELECT shard, '{"checkpoint":{"snapshot":{"startSeqno":' || snap_start || ',"endSeqno":' || snap_end || '},"vbuuid":' || branch || ',"seqno":' || seqno || '},"bucketUuid":"bucket-id"}' AS document FROM stored""")
def k11_checkpoint_json(spark, sf_dir):
    return _stored(spark, sf_dir).withColumn("bucket_uuid", F.lit("bucket-id")).select("shard", checkpoints.document_json().alias("document"))


@query("SELECT event_id, lower(hex(event_id)) AS u, '{\"uid\":\"' || lower(hex(event_id)) || '\",\"collections\":[\"' || lower(hex(collection_id)) || '\"]}' AS filter FROM log")
def b24_stream_filter(spark, sf_dir):
    none = F.lit(None).cast("bigint")
    x = _log(spark, sf_dir)
    return x.select("event_id", F.lower(F.hex("event_id")).alias("u"), C.stream_filter_json(F.col("event_id"), F.array("collection_id"), none, none).alias("filter"))


@query("SELECT key, seqno, shard, kind FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rev_seqno DESC, cas DESC, shard DESC, seqno DESC) AS k FROM log) WHERE k = 1 AND kind = 'mutation'")
def x1_compaction(spark, sf_dir):
    return ack.latest_by_key(_log(spark, sf_dir)).select("key", "seqno", "shard", "kind")


@query("SELECT event_id, shard, seqno FROM log")
def x2_drop_replays(spark, sf_dir):
    log = _log(spark, sf_dir).withColumn("branch", F.lit(1))
    again = log.where("event_id % 4 = 0").withColumn("arrival", F.col("arrival") + 100_000_000)
    return ack.drop_replays(log.union(again)).select("event_id", "shard", "seqno")


@query("SELECT event_id, shard, 'mutation' AS kind, seqno, rev_seqno, collection_id, key, cas::DECIMAL(20,0) AS cas FROM log WHERE kind = 'mutation'")
def b8_wire_mutations(spark, sf_dir):
    """Frames put together with Column expressions, then decoded again."""
    be = lambda c, n: F.unhex(F.lpad(F.hex(c), 2 * n, "0"))
    log = _log(spark, sf_dir).where("kind = 'mutation'")
    extras = F.concat(be(F.col("seqno"), 8), be(F.col("rev_seqno"), 8), F.unhex(F.lit("00" * 12)))
    key = F.concat(be(F.col("collection_id"), 1), F.col("key").cast("binary"))
    size = F.lit(28) + F.length(key)
    head = F.concat(F.unhex(F.lit("8057")), be(F.length(key), 2), F.unhex(F.lit("1c00")), be(F.col("shard"), 2), be(size, 4), F.unhex(F.lit("00000000")), be(F.col("cas"), 8))
    x = wire.decode_events(wire.decode_frames(log.select("event_id", F.concat(head, extras, key).alias("frame"))))
    return x.select("event_id", "shard", "kind", "seqno", "rev_seqno", "collection_id", F.col("key").cast("string").alias("key"), "cas")


from tidelog.plans import control, streams  # noqa: E402, F401 - they register their queries
