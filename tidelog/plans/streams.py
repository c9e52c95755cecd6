"""Queries that run as streams, to their present end, over logs written to the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog import errors
from tidelog.config import Config
from tidelog.functions import wire
from tidelog.operators import order
from tidelog.plans.catalogue import _log, _marked, query
from tidelog.plans.engine import Engine
from tidelog.sources import checkpoints, files, synth
from tidelog.streaming import acks, held

_MARKED = "shard int, arrival bigint, kind string, seqno bigint, snap_start bigint, snap_end bigint, collection_id bigint, cas bigint"


@query("""AND x AS (SELECT *, last_value(CASE WHEN kind = 'snapshot_marker' THEN snap_end END IGNORE NULLS) OVER w AS e, last_value(CASE WHEN kind = 'snapshot_marker' THEN snap_start END IGNORE NULLS) OVER w AS s,
  max(seqno) OVER (PARTITION BY shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM marked WINDOW w AS (PARTITION BY shard ORDER BY arrival)),
bad AS (SELECT shard, arrival, CASE WHEN kind = 'snapshot_marker' THEN CASE WHEN snap_end < coalesce(prev, 0) THEN 'marker_behind' END WHEN seqno < s OR seqno > e THEN 'outside' WHEN seqno <= coalesce(prev, 0) THEN 'non_monotonic' END AS v FROM x),
f AS (SELECT shard, min(arrival) AS at, min_by(v, arrival) AS stopped FROM bad WHERE v IS NOT NULL GROUP BY shard)
SELECT m.shard, max(CASE WHEN f.at IS NULL OR m.arrival < f.at THEN m.seqno END)::BIGINT AS processed, any_value(f.stopped) AS stopped FROM marked m LEFT JOIN f ON m.shard = f.shard GROUP BY m.shard""")
def a2_stream_outcome(spark, sf_dir):
    """Every shard's progress and what stopped it, after a stream over a log in which some events arrive after the next marker's."""
    base = held.shared_dir(spark)
    files.write_log(_marked(spark, sf_dir).drop("event_id"), f"{base}/log")
    engine = Engine(spark, Config("b", mode="finite", bucket_uuid="u"), checkpoints.NoopStore())
    sub = engine.subscribe(files.stream(spark, f"{base}/log", schema=_MARKED), lambda df, _: df.write.mode("append").parquet(f"{base}/out"), f"{base}/checkpoint")
    for step in (sub.wait, sub.close):
        try:
            step()
        except errors.StreamError:
            pass  # its shards are told by statuses()
    rows = [(s, x["processed"], x["stopped"]) for s, x in engine.statuses().items()]
    return spark.createDataFrame(rows, "shard int, processed bigint, stopped string")


@query("""AND a AS (SELECT shard, seqno, seqno * 100000 AS d, CASE WHEN event_id % 997 <> 5 THEN (seqno + 1 + (event_id * 7919) % 75) * 100000 + 1 + seqno % 99991 END AS t FROM log),
m AS (SELECT *, max(coalesce(t, 9223372036854775807)) OVER (PARTITION BY shard ORDER BY seqno) AS m FROM a),
p AS (SELECT shard, d AS moment, 1 AS n, NULL::BIGINT AS seqno FROM m UNION ALL SELECT shard, m, -1, NULL FROM m UNION ALL SELECT shard, t, 0, seqno FROM m WHERE t IS NOT NULL),
r AS (SELECT shard, moment, seqno, sum(n) OVER (PARTITION BY shard ORDER BY moment) AS pending FROM p)
SELECT r.shard, r.seqno, r.pending::BIGINT AS pending, (SELECT max(m.seqno) FROM m WHERE m.shard = r.shard AND m.m = r.moment)::BIGINT AS advanced_to FROM r WHERE r.seqno IS NOT NULL""")
def k1_ack_stream(spark, sf_dir):
    """Acknowledgements up to 75 events late and some never, in two runs of one stream: what each of them led to."""
    base, x = held.shared_dir(spark), _log(spark, sf_dir)
    checkpoint = ["snap_start", "snap_end", F.lit(None).cast("bigint").alias("manifest_uid")]
    given = x.select("shard", (F.col("seqno") * 100000).alias("at"), F.lit("deliver").alias("action"), F.col("seqno").alias("token"), "seqno", *checkpoint)
    late = (F.col("seqno") + 1 + (F.col("event_id") * 7919) % 75) * 100000 + 1 + F.col("seqno") % 99991
    none = [F.lit(None).cast("bigint").alias(c) for c in ("seqno", "snap_start", "snap_end", "manifest_uid")]
    rows = given.union(x.where("event_id % 997 <> 5").select("shard", late.alias("at"), F.lit("ack").alias("action"), F.col("seqno").alias("token"), *none))
    half = x.agg(F.max("seqno")).first()[0] * 50000
    for part in (rows.where(F.col("at") <= half), rows.where(F.col("at") > half)):
        part.write.mode("append").parquet(f"{base}/control")
        acks.run(spark, spark.readStream.schema(acks.CONTROL).parquet(f"{base}/control"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(acks.OUTCOME).parquet(f"{base}/out").select("shard", F.col("token").alias("seqno"), "pending", "advanced_to")


@query("""AND x AS (SELECT event_id, shard, CASE WHEN shard = 15 THEN 'not_open' WHEN event_id % 13 = 5 THEN 'other_opaque' WHEN event_id % 17 = 4 OR shard % 3 = 2 AND event_id % 11 = 1 THEN 'other_stream' END AS fenced FROM log)
SELECT event_id, fenced FROM x""")
def c10_stream_fence(spark, sf_dir):
    """Rows of the open streams, of older ones (another opaque or stream id) and of a shard without a stream."""
    i, shard = F.col("event_id"), F.col("shard")
    sid = F.when(shard % 3 == 2, None).otherwise(shard)
    x = _log(spark, sf_dir).withColumns({"opaque": shard * 10 + (i % 13 == 5).cast("int"), "stream_id": F.when(i % 17 == 4, 999).when((shard % 3 == 2) & (i % 11 == 1), 7).otherwise(sid)})
    opened = spark.range(15).select(F.col("id").cast("int").alias("shard")).select("shard", F.when(shard % 3 == 2, None).otherwise(shard).alias("stream_id"), (shard * 10).alias("opaque"))
    return order.fence(x, opened).select("event_id", "fenced")


@query("""AND half AS (SELECT shard, max(seqno) // 2 AS h FROM log GROUP BY shard)
SELECT l.shard, count(*) FILTER (WHERE l.shard % 5 <> 2 OR seqno <= h) AS events, max(CASE WHEN l.shard % 5 <> 2 OR seqno <= h THEN seqno END)::BIGINT AS processed, (CASE WHEN l.shard % 5 = 2 THEN 1 ELSE 0 END)::BIGINT AS closed FROM log l JOIN half ON l.shard = half.shard GROUP BY l.shard""")
def k16_closed_shards(spark, sf_dir):
    """A running subscription of which some shards are closed between two parts of the log."""
    base = held.shared_dir(spark)
    log = _log(spark, sf_dir)
    x = synth.with_markers(log.withColumn("event_id", F.col("event_id") + 1), 1 << 40).drop("event_id").join(F.broadcast(log.groupBy("shard").agg(F.floor(F.max("seqno") / 2).alias("h"))), "shard").withColumn("late", F.col("arrival") > F.col("h") * 4).drop("h")
    engine = Engine(spark, Config("b", bucket_uuid="u"), checkpoints.NoopStore())
    files.write_log(x.where("NOT late").drop("late"), f"{base}/log")
    sink = lambda df, _: df.select("shard", "kind", "seqno").write.mode("append").parquet(f"{base}/out")
    sub = engine.subscribe(files.stream(spark, f"{base}/log", schema=_MARKED), sink, f"{base}/checkpoint", processingTime="0 seconds")
    sub.query.processAllAvailable()
    for shard in [s for s in engine.processed if s % 5 == 2]:
        sub.close_shard(shard)
    files.write_log(x.where("late").drop("late"), f"{base}/log")
    sub.query.processAllAvailable()
    sub.close()
    out = spark.read.parquet(f"{base}/out")
    return out.groupBy("shard").agg(F.count("seqno").alias("events"), F.max("seqno").alias("processed"), F.count_if(F.col("kind") == "stream_end").alias("closed"))


@query("SELECT event_id, true AS same, NULL::VARCHAR AS problem FROM log")
def b2_encoded_frames(spark, sf_dir):
    """Frames of each event put together from columns, decoded, and put together again: key with its collection, extras, value, framing extras."""
    i, magic = F.col("event_id"), F.when(F.col("event_id") % 2 == 0, wire.REQUEST).otherwise(wire.ALT_REQUEST)
    opcode = F.element_at(F.array(*[F.lit(o) for o in wire.KEYED]), F.pmod(i, F.lit(3)).cast("int") + 1)
    framing = F.when(i % 2 == 1, F.concat(F.unhex(F.lit("22")), wire.be(F.col("shard"), 2))).otherwise(F.lit(b""))
    extras = F.concat(wire.be(F.col("seqno"), 8), wire.be(F.col("rev_seqno"), 8), F.unhex(F.lit("00" * 12)))
    x = _log(spark, sf_dir).select("event_id", "shard", magic.alias("magic"), opcode.alias("opcode"), framing.alias("framing"), extras.alias("extras"), F.col("key").cast("binary").alias("key"), F.repeat("key", 3).cast("binary").alias("value"), (i * 524287 % 2**32).alias("collection_id"), "cas", i.alias("opaque"))
    first = wire.encode_frames(x)
    again = wire.encode_frames(wire.decode_frames(first.select("event_id", "frame")).withColumnRenamed("frame", "was").drop("problem"))
    parts = F.col("was").isNotNull() & (F.col("was") == F.col("frame")) & (F.col("collection_id") == i * 524287 % 2**32)
    return again.select("event_id", F.coalesce(parts, F.lit(False)).alias("same"), F.coalesce("malformed", "problem").alias("problem"))
