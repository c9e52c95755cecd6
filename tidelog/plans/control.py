"""Queries of the control plane over the driver's tables: topology, manifests, membership, metrics, requests; and the same in SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions import columns as C
from tidelog.functions import wire
from tidelog.operators import ack, collections, endpoints, gate, membership, metrics, rollback, topology
from tidelog.plans.catalogue import FAILOVER_SQL, OUTCOME_SQL, STORED_SQL, _assigned, _failover, _log, _marked, _observations, _stored, query
from tidelog.sources import synth


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def be(c, n: int):
    """A number as n big-endian bytes."""
    return F.unhex(F.lpad(F.hex(c), 2 * n, "0"))


# --- topology: each region is a bucket whose servers are its nations, in order of their keys


def _region_documents(spark, sf_dir, shift: int, rev):
    """json: a topology document of each region; every other shard is routed `shift` servers further, replicas follow the active node."""
    servers = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda n: n["n_name"])
    x = _table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(servers.alias("servers"))
    x = x.join(_table(spark, sf_dir, "region"), F.col("k") == F.col("r_regionkey")).withColumn("n", F.size("servers"))
    at = lambda s, d: ((s + d + F.when(s % 2 == 0, shift).otherwise(0)) % F.col("n")).cast("int")
    rows = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda s: F.array(at(s, 0), at(s, 1), F.when(s % 4 == 0, F.lit(-1)).otherwise(at(s, 2))))
    vmap = F.struct(F.lit("CRC").alias("hashAlgorithm"), F.lit(2).alias("numReplicas"), F.col("servers").alias("serverList"), rows.alias("vBucketMap"))
    doc = F.struct(rev.cast("bigint").alias("rev"), F.lit(1).alias("revEpoch"), F.col("r_name").alias("name"), F.lit("u").alias("uuid"), F.lit("vbucket").alias("nodeLocator"), vmap.alias("vBucketServerMap"))
    return x.select(F.to_json(doc).alias("json"))


REGION_SQL = """srv AS (SELECT n_regionkey AS k, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i, count(*) OVER (PARTITION BY n_regionkey) AS n FROM nation),
reg AS (SELECT DISTINCT r_regionkey AS k, r_name AS bucket, n FROM region JOIN srv ON k = r_regionkey),
slot AS (SELECT reg.k, bucket, s::INT AS shard, (s + d) % n AS i0, (s + d + CASE WHEN s % 2 = 0 THEN 1 ELSE 0 END) % n AS i1, d, d = 2 AND s % 4 = 0 AS none FROM reg, range(16) t(s), range(3) u(d)),
was AS (SELECT slot.k, bucket, shard, d, n_name AS node FROM slot JOIN srv ON srv.k = slot.k AND srv.i = i0 WHERE NOT none)"""


@query(f"WITH {REGION_SQL} SELECT bucket, shard, max(CASE WHEN d = 0 THEN node END) AS active, string_agg(node, ',' ORDER BY d) FILTER (WHERE d > 0) AS replicas, NULL::VARCHAR AS problem FROM was GROUP BY bucket, shard", log=False)
def h4_region_routes(spark, sf_dir):
    x = topology.parse_routes(_region_documents(spark, sf_dir, 0, F.lit(5)))
    return x.select("bucket", "shard", "active", F.array_join("replicas", ",").alias("replicas"), "problem")


_ASKED = "('auto', false, 'n' || lo || '.lan:11210'), ('auto', true, 'proxy.test:31101'), ('external', false, 'proxy.test:31101'), ('lab', false, 'proxy.test:1'), ('default', true, '[fd00::9]:11207'), (' ', false, 'proxy.test:1')"


@query(f"""WITH n AS (SELECT n_nationkey AS k, n_regionkey AS r, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i, min(n_nationkey) OVER (PARTITION BY n_regionkey) AS lo FROM nation),
q AS (SELECT n.*, requested, tls, source, CASE WHEN source LIKE '[%' THEN 'fd00::9' ELSE split_part(source, ':', 1) END AS src FROM n, LATERAL (VALUES {_ASKED}) v(requested, tls, source)),
x AS (SELECT *, CASE WHEN k % 7 = 0 THEN src WHEN k % 8 = 2 THEN 'fd00::' || k ELSE 'n' || k || '.lan' END AS host, CASE WHEN tls THEN CASE WHEN k % 9 = 4 THEN 0 ELSE 11207 END ELSE 11210 END AS port,
  CASE WHEN r = 3 AND i = 1 THEN NULL ELSE 'ext' || k || '.test' END AS ext, CASE WHEN k % 4 = 3 THEN CASE WHEN tls THEN CASE WHEN k % 9 = 4 THEN 0 ELSE 11207 END ELSE 11210 END ELSE CASE WHEN tls THEN 31101 + k ELSE 31001 + k END END AS eport FROM q),
w AS (SELECT *, CASE WHEN requested <> 'auto' THEN requested WHEN bool_or(lower(host) = lower(src) AND port = split_part(source, ':', -1)::INT AND port <> 0) OVER g THEN 'default' WHEN count(ext) OVER g = count(*) OVER g THEN 'external' ELSE 'default' END AS network FROM x WINDOW g AS (PARTITION BY r, requested, tls)),
y AS (SELECT *, CASE WHEN port = 0 THEN 'no kvSSL port' WHEN network NOT IN ('default', 'external') OR (network = 'external' AND ext IS NULL) THEN 'no address in the network' WHEN network = 'external' AND eport = 0 THEN 'no kvSSL port' END AS problem FROM w WHERE requested <> ' ')
SELECT r AS region, requested, tls, network, i::INT AS server, CASE WHEN problem IS NULL THEN CASE WHEN k % 6 = 1 THEN 'old' || k || ':11210' ELSE 'node-' || k END END AS node,
  CASE WHEN problem IS NULL THEN CASE WHEN network = 'external' THEN ext || ':' || eport WHEN host LIKE '%:%' THEN '[' || host || ']:' || port ELSE host || ':' || port END END AS address,
  CASE WHEN problem IS NULL THEN CASE WHEN host LIKE '%:%' THEN '[' || host || ']:' || port ELSE host || ':' || port END END AS canonical, CASE WHEN problem IS NULL AND k % 5 <> 2 THEN 'g' || k % 3 END AS server_group, problem FROM y
UNION ALL SELECT DISTINCT r, requested, tls, network, 0, NULL, NULL, NULL, NULL, 'bad network name' FROM w WHERE requested = ' '""", log=False)
def h5_region_endpoints(spark, sf_dir):
    """Each region's document, asked for in six ways: nodes without a name, a port, a uuid, an outer address; v6 hosts; a node that holds no data in front."""
    k, none = F.col("n_nationkey"), F.lit(None).cast("string")
    ports = lambda kv, ssl: F.struct(kv.cast("int").alias("kv"), ssl.cast("int").alias("kvSSL"))
    own = ports(F.lit(11210), F.when(k % 9 != 4, 11207))
    host = F.when(k % 7 == 0, none).when(k % 8 == 2, F.concat(F.lit("fd00::"), k)).otherwise(F.concat(F.lit("n"), k, F.lit(".lan")))
    outer = F.struct(F.concat(F.lit("ext"), k, F.lit(".test")).alias("hostname"), F.when(k % 4 != 3, ports(k + 31001, k + 31101)).alias("ports"))
    lacks = (F.col("n_regionkey") == 3) & (F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) == 2)
    node = F.struct(
        F.when(k % 6 != 1, F.concat(F.lit("node-"), k)).alias("nodeUUID"), host.alias("hostname"), F.when(k % 5 != 2, F.concat(F.lit("g"), k % 3)).otherwise("").alias("serverGroup"), own.alias("services"),
        F.when(~F.col("_lacks"), F.create_map(F.lit("external"), outer)).alias("alternateAddresses"),
    )
    x = _table(spark, sf_dir, "nation").withColumn("_lacks", lacks)
    x = x.groupBy(F.col("n_regionkey").alias("region")).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", node.alias("node"), F.concat(F.lit("old"), k, F.lit(":11210")).alias("old"))), lambda a, b: a["n_nationkey"] - b["n_nationkey"]).alias("n"), F.min("n_nationkey").alias("lo"))
    front = F.expr("named_struct('nodeUUID', 'query', 'hostname', 'q.lan', 'serverGroup', CAST(NULL AS STRING), 'services', named_struct('kv', CAST(NULL AS INT), 'kvSSL', CAST(NULL AS INT)), 'alternateAddresses', CAST(NULL AS MAP<STRING, STRUCT<hostname: STRING, ports: STRUCT<kv: INT, kvSSL: INT>>>))")
    doc = F.to_json(F.struct(F.concat(F.array(front), F.transform("n", lambda r: r["node"])).alias("nodesExt"), F.struct(F.transform("n", lambda r: r["old"]).alias("serverList")).alias("vBucketServerMap")))
    asked = [("auto", False, F.concat(F.lit("n"), F.col("lo"), F.lit(".lan:11210"))), ("auto", True, F.lit("proxy.test:31101")), ("external", False, F.lit("proxy.test:31101")), ("lab", False, F.lit("proxy.test:1")), ("default", True, F.lit("[fd00::9]:11207")), (" ", False, F.lit("proxy.test:1"))]
    rows = F.array(*[F.struct(F.lit(a).alias("requested"), F.lit(b).alias("tls"), c.alias("source")) for a, b, c in asked])
    docs = x.select("region", doc.alias("json"), F.explode(rows).alias("a")).select("region", "json", "a.*")
    return endpoints.endpoints(docs).drop("source")


@query(f"WITH {REGION_SQL} SELECT node, shard FROM was GROUP BY node, shard", log=False)
def h3_region_nodes(spark, sf_dir):
    x = topology.shards_by_node(topology.parse_routes(_region_documents(spark, sf_dir, 0, F.lit(5))), with_replicas=True)
    return x.select("node", F.explode("shards").alias("shard"))


@query(f"WITH {REGION_SQL} SELECT bucket, shard, node, (count(*) OVER (PARTITION BY bucket, shard))::INT AS expected_copies FROM (SELECT DISTINCT bucket, shard, node FROM was)", log=False)
def f1_region_observation_plan(spark, sf_dir):
    x = topology.parse_routes(_region_documents(spark, sf_dir, 0, F.lit(5)))
    return gate.observation_plan(x.withColumn("shard", F.struct("bucket", "shard"))).select("shard.bucket", "shard.shard", "node", "expected_copies")


@query(f"""WITH {REGION_SQL}, now AS (SELECT slot.bucket, slot.k, shard, n_name AS node FROM slot JOIN srv ON srv.k = slot.k AND srv.i = i1 WHERE d = 0)
SELECT w.bucket, 4::BIGINT AS generation, w.shard, w.node AS was, n.node AS now, 'rerouted' AS change FROM was w JOIN now n ON w.bucket = n.bucket AND w.shard = n.shard WHERE w.d = 0 AND w.node <> n.node AND 4 + w.k > 5""", log=False)
def h8_region_revisions(spark, sf_dir):
    """Of the later documents some are older than what is there, and one is as old."""
    old = topology.parse_routes(_region_documents(spark, sf_dir, 0, F.lit(5)))
    return topology.apply_revisions(old, topology.parse_routes(_region_documents(spark, sf_dir, 1, F.col("k") + 4)), 3)


@query("""SELECT n_nationkey AS key, CASE WHEN n_nationkey < 2 THEN 'negative revision' WHEN n_nationkey % 7 = 3 THEN 'no bucket name' WHEN n_nationkey % 5 = 4 THEN 'node locator' WHEN n_nationkey % 6 = 5 THEN 'hash algorithm' END AS problem FROM nation""", log=False)
def h10_document_problems(spark, sf_dir):
    k = F.col("n_nationkey")
    doc = F.struct((k - 2).cast("bigint").alias("rev"), F.lit(1).alias("revEpoch"), F.when(k % 7 == 3, " ").otherwise(F.col("n_name")).alias("name"), F.when(k % 5 == 4, "ketama").otherwise("vbucket").alias("nodeLocator"), F.struct(F.when(k % 6 == 5, "MD5").otherwise("CRC").alias("hashAlgorithm")).alias("vBucketServerMap"))
    return topology.document_problems(_table(spark, sf_dir, "nation").select(k.alias("key"), F.to_json(doc).alias("json"))).select("key", "problem")


# --- manifests: regions as scopes, nations as collections


@query("SELECT 42::BIGINT AS manifest_uid, r_regionkey + 8 AS scope_id, r_name AS scope, n_nationkey + 16 AS collection_id, n_name AS collection, n_nationkey * 10 AS max_ttl, n_nationkey % 2 = 0 AS history FROM region JOIN nation ON n_regionkey = r_regionkey", log=False)
def a12_nation_manifest(spark, sf_dir):
    low = lambda c: F.lower(F.hex(c))
    k = F.col("n_nationkey")
    c = F.struct(low(k + 16).alias("uid"), F.col("n_name").alias("name"), (k * 10).alias("maxTTL"), (k % 2 == 0).alias("history"))
    scopes = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_regionkey", "r_name").agg(F.collect_list(c).alias("collections"))
    scopes = scopes.select(F.struct(low(F.col("r_regionkey") + 8).alias("uid"), F.col("r_name").alias("name"), "collections").alias("s"))
    return collections.parse_manifest(scopes.agg(F.collect_list("s").alias("scopes")).select(F.to_json(F.struct(F.lit("2a").alias("uid"), "scopes")).alias("json")))


@query("SELECT n_name AS collection, n_nationkey::BIGINT + 16 AS collection_id, NULL::BIGINT AS scope_id FROM nation WHERE n_name IN ('NATION_12', 'NATION_2') UNION ALL SELECT NULL, NULL, r_regionkey::BIGINT + 8 FROM region WHERE r_name = 'EUROPE'", log=False)
def a13_resolved_collections(spark, sf_dir):
    """Two collections of a scope by their names, and a whole scope."""
    dim = a12_nation_manifest(spark, sf_dir)
    names = ("NATION_2", "NATION_12")
    _, ids = collections.resolve(dim, "ASIA", names)
    scope, _ = collections.resolve(dim, "EUROPE", ())
    return spark.createDataFrame([*zip(names, ids, (None, None)), (None, None, scope)], "collection string, collection_id bigint, scope_id bigint")


@query("""WITH d AS (SELECT r_regionkey AS scope_id, r_name AS scope, n_nationkey % 22 AS collection_id, substr(n_name, 1, 1) AS collection FROM region JOIN nation ON n_regionkey = r_regionkey)
SELECT 'collection id' AS problem, collection_id::VARCHAR AS what, count(*) AS n FROM d GROUP BY collection_id HAVING count(*) > 1
UNION ALL SELECT 'collection name', scope || '/' || collection, count(*) FROM d GROUP BY scope, collection HAVING count(*) > 1""", log=False)
def g4_nation_manifest_problems(spark, sf_dir):
    x = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return collections.manifest_problems(x.select(F.col("r_regionkey").alias("scope_id"), F.col("r_name").alias("scope"), (F.col("n_nationkey") % 22).alias("collection_id"), F.substring("n_name", 1, 1).alias("collection")))


def _schema_changes(spark, sf_dir):
    """Each signup creates a collection, each error drops one, each purchase is of an unknown kind, views and clicks touch scopes."""
    e, u = synth.events(spark, sf_dir), F.col("user_id")
    kind = F.when(F.col("event_type") == "signup", "create_collection").when(F.col("event_type") == "error", "drop_collection").when(F.col("event_type") == "purchase", "unknown").otherwise("create_scope")
    return e.select((F.col("event_id") + 1).alias("manifest_uid"), kind.alias("sys_kind"), F.when(u % 4 == 0, 9).otherwise(8).cast("bigint").alias("scope_id"), (u % 500 + 100).alias("collection_id"), F.concat(F.lit("c"), ((u * 7 + F.col("event_id") % 2) % 450).cast("string")).alias("name"))


def _empty_scope(spark):
    return spark.createDataFrame([(0, 8, "shop", None, None)], "manifest_uid bigint, scope_id bigint, scope string, collection_id bigint, collection string")


CHANGES_SQL = """ch AS (SELECT event_id + 1 AS uid, event_type AS t, user_id % 500 + 100 AS id, 'c' || ((user_id * 7 + event_id % 2) % 450) AS name FROM events WHERE user_id % 4 <> 0),
iv AS (SELECT id, name, uid AS f, lead(uid) OVER (PARTITION BY id ORDER BY uid) AS e, t FROM ch WHERE t IN ('signup', 'error')),
v AS (SELECT id, name, f, e FROM iv WHERE t = 'signup')"""


@query(f"WITH {CHANGES_SQL} SELECT id AS collection_id, name, f AS from_uid, e AS to_uid FROM v", log=False)
def g2_name_intervals(spark, sf_dir):
    return collections.name_versions(_empty_scope(spark), _schema_changes(spark, sf_dir), 8)


@query(f"""WITH {CHANGES_SQL}, m AS (SELECT * FROM ch WHERE t = 'signup')
SELECT m.uid AS manifest_uid, 'id renamed' AS problem, m.id AS collection_id, m.name FROM m JOIN v ON v.id = m.id AND v.f < m.uid AND (v.e IS NULL OR m.uid <= v.e) AND v.name <> m.name
UNION ALL SELECT m.uid, 'name taken', m.id, m.name FROM m JOIN v ON v.id <> m.id AND v.name = m.name AND v.f < m.uid AND (v.e IS NULL OR m.uid <= v.e)
UNION ALL SELECT c.uid, 'drop of an absent id', c.id, c.name FROM ch c WHERE t = 'error' AND NOT EXISTS (SELECT 1 FROM v WHERE v.id = c.id AND v.f < c.uid AND (v.e IS NULL OR c.uid <= v.e))""", log=False)
def g3_registry_problems(spark, sf_dir):
    return collections.registry_problems(_empty_scope(spark), _schema_changes(spark, sf_dir), 8)


@query("SELECT max(event_id) + 1 AS manifest_uid, coalesce(bool_or(event_type = 'purchase'), false) AS stale FROM events", log=False)
def g7_registry_status(spark, sf_dir):
    return collections.registry_status(_empty_scope(spark), _schema_changes(spark, sf_dir))


# --- wire: record lists, responses, compressed values


@query(FAILOVER_SQL + " SELECT shard, pos, branch::DECIMAL(20,0) AS branch, seqno::DECIMAL(20,0) AS seqno FROM f")
def a10_failover_decode(spark, sf_dir):
    entry = F.struct("pos", F.concat(be(F.col("branch"), 8), be(F.col("seqno"), 8)).alias("bytes"))
    x = _failover(_log(spark, sf_dir)).groupBy("shard").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    value = F.aggregate("e", F.lit(b""), lambda a, b: F.concat(a, b["bytes"]))
    return x.select("shard", F.posexplode(wire.failover_list(value)).alias("pos", "r")).select("shard", "pos", "r.branch", "r.seqno")


@query("SELECT shard, max(seqno)::DECIMAL(20,0) AS seqno FROM log GROUP BY shard")
def b18_seqno_list(spark, sf_dir):
    """One answer with the last seqno of every shard, put together and read."""
    record = F.struct("shard", F.concat(be(F.col("shard"), 2), be(F.col("high_seqno"), 8)).alias("bytes"))
    x = rollback.high_seqnos(_log(spark, sf_dir)).agg(F.array_sort(F.collect_list(record)).alias("e"))
    value = F.aggregate("e", F.lit(b""), lambda a, b: F.concat(a, b["bytes"]))
    return x.select(F.explode(wire.seqno_list(value)).alias("r")).select(F.col("r.shard").cast("int").alias("shard"), "r.seqno")


@query(FAILOVER_SQL + """ SELECT shard, CASE WHEN shard % 3 = 0 THEN max(seqno) END::DECIMAL(20,0) AS rollback, CASE WHEN shard % 3 = 1 THEN count(*) END AS entries, CASE WHEN shard % 3 = 1 THEN min_by(branch, pos) END::DECIMAL(20,0) AS newest FROM f GROUP BY shard""")
def b20_stream_responses(spark, sf_dir):
    """Answers to stream requests by shard: a rollback, a failover log, an error."""
    entry = F.struct("pos", F.concat(be(F.col("branch"), 8), be(F.col("seqno"), 8)).alias("bytes"))
    x = _failover(_log(spark, sf_dir)).groupBy("shard").agg(F.array_sort(F.collect_list(entry)).alias("e"), F.max("seqno").alias("high"))
    k = F.col("shard") % 3
    value = F.when(k == 0, be(F.col("high"), 8)).when(k == 1, F.aggregate("e", F.lit(b""), lambda a, b: F.concat(a, b["bytes"]))).otherwise(F.lit(b""))
    y = x.select("shard", wire.stream_response(F.when(k == 0, 0x23).when(k == 1, 0).otherwise(0x24), value).alias("r"))
    log = F.col("r.log")
    return y.select("shard", "r.rollback", F.when(log.isNotNull(), F.size(log)).cast("bigint").alias("entries"), F.get(log["branch"], F.lit(0)).alias("newest"))


@query(OUTCOME_SQL + """SELECT shard, cycle, k, h % 41 = 8 AS did_failover, CASE WHEN h % 29 = 4 THEN 1 ELSE 99 END::DECIMAL(20,0) AS branch, greatest(p, 0)::DECIMAL(20,0) AS persisted, hi::DECIMAL(20,0) AS current,
  CASE WHEN h % 41 = 8 THEN 7::DECIMAL(20,0) END AS old_branch FROM ob""")
def a14_observe_decode(spark, sf_dir):
    obs, _ = _observations(_log(spark, sf_dir))
    tail = F.when(F.col("did_failover"), F.concat(be(F.lit(7), 8), be(F.col("current"), 8))).otherwise(F.lit(b""))
    value = F.concat(F.when(F.col("did_failover"), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))), be(F.col("shard"), 2), be(F.col("branch"), 8), be(F.greatest("persisted", F.lit(0)), 8), be(F.col("current"), 8), tail)
    x = obs.select("cycle", F.substring("node", 2, 1).cast("bigint").alias("k"), wire.observe_response(value).alias("r"))
    return x.select("r.shard", "cycle", "k", "r.did_failover", "r.branch", "r.persisted", "r.current", "r.old_branch")


@query("SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 'bad snappy value' END AS problem, CASE WHEN event_id % 4 <> 1 THEN repeat(key, 20) END AS value, (CASE WHEN event_id % 2 = 0 THEN 1 WHEN event_id % 4 = 1 THEN 1 ELSE 4 END)::SMALLINT AS datatype FROM log")
def b6_snappy_values(spark, sf_dir):
    """Values packed and unpacked: even events are compressed JSON, a quarter is marked so but isn't, the rest is plain."""
    import pyarrow as pa

    @F.pandas_udf("binary")
    def pack(s: pd.Series) -> pd.Series:
        codec = pa.Codec("snappy")
        return s.map(lambda v: codec.compress(v, asbytes=True))

    k = F.col("event_id")
    plain = F.repeat("key", 20).cast("binary")
    kind = F.when(k % 2 == 0, 3).when(k % 4 == 1, 3).otherwise(4).cast("smallint")
    value = F.when(k % 2 == 0, pack(plain)).when(k % 4 == 1, F.concat(F.unhex(F.lit("ffff03")), plain)).otherwise(plain)
    x = _log(spark, sf_dir).select("event_id", kind.alias("datatype"), value.alias("value"), F.lit(None).cast("string").alias("malformed"))
    return wire.decompressed(x).select("event_id", F.col("malformed").alias("problem"), F.col("value").cast("string").alias("value"), "datatype")


@query("""SELECT event_id, CASE WHEN event_id % 6 = 0 THEN key END AS value, CASE event_id % 6 WHEN 3 THEN 'status' WHEN 4 THEN 'wrong length' WHEN 5 THEN 'path status' END AS problem FROM log""")
def b23_lookup_values(spark, sf_dir):
    """One-path lookups: found, path missing, document missing, failed, cut short, path failed."""
    k, key = F.col("event_id") % 6, F.col("key").cast("binary")
    own = F.when(k == 1, wire.PATH_NOT_FOUND).when(k == 5, 0xC2).otherwise(0)
    status = F.when(k == 2, wire.NOT_FOUND).when(k == 3, 0x20).when(k == 1, wire.PATHS_FAILED).otherwise(0)
    value = F.concat(be(own, 2), be(F.length(key) + F.when(k == 4, 3).otherwise(0), 4), key)
    return _log(spark, sf_dir).select("event_id", wire.lookup_value(status, value).alias("r")).select("event_id", F.col("r.value").cast("string").alias("value"), "r.problem")


# --- membership


@query("SELECT a AS shard, CASE WHEN a >= 16 THEN 'unknown shard' ELSE 'no active node' END AS problem FROM (SELECT DISTINCT (user_id % 20)::INT AS a FROM events) WHERE a >= 16 OR a % 5 = 3", log=False)
def i3_assignment_problems(spark, sf_dir):
    assigned = synth.events(spark, sf_dir).select((F.col("user_id") % 20).cast("int").alias("shard"))
    return membership.assignment_problems(assigned, _assigned(spark).select("shard", F.when(F.col("shard") % 5 != 3, "n").alias("active")))


REGISTRY_SQL = """WITH RECURSIVE e AS (SELECT 'm' || user_id AS m, event_id AS ts_, CASE WHEN event_type IN ('click', 'purchase') THEN 'join' WHEN event_type = 'error' THEN 'leave' ELSE 'heartbeat' END AS a, CASE WHEN event_type = 'purchase' THEN 'y' ELSE 'x' END AS i,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
f AS (SELECT m, 0::BIGINT AS k, NULL::VARCHAR AS inc, NULL::BIGINT AS j, NULL::BIGINT AS h FROM (SELECT DISTINCT m FROM e) UNION ALL
  SELECT m, k, CASE c WHEN 1 THEN inc WHEN 2 THEN i WHEN 3 THEN NULL ELSE inc END, CASE c WHEN 2 THEN ts_ WHEN 3 THEN NULL ELSE j END, CASE c WHEN 1 THEN greatest(h, ts_) WHEN 2 THEN ts_ WHEN 3 THEN NULL ELSE h END
  FROM (SELECT e.m, e.k, e.i, e.ts_, f.inc, f.j, f.h, CASE WHEN f.inc = e.i AND a <> 'leave' THEN 1 WHEN a = 'join' AND (f.inc IS NULL OR greatest(e.ts_ - f.h, 0) >= 300) THEN 2 WHEN f.inc = e.i AND a = 'leave' THEN 3 ELSE 4 END AS c FROM f JOIN e ON e.m = f.m AND e.k = f.k + 1))
SELECT m AS member_id, inc AS incarnation, j AS joined_at, h AS heartbeat_at FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY k DESC) AS r FROM f) WHERE r = 1 AND inc IS NOT NULL"""


@query(REGISTRY_SQL, log=False)
def i4_user_registry(spark, sf_dir):
    t = F.col("event_type")
    action = F.when(t.isin("click", "purchase"), "join").when(t == "error", "leave").otherwise("heartbeat")
    x = synth.events(spark, sf_dir).select(F.col("event_id").alias("at"), action.alias("action"), F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("member_id"), F.when(t == "purchase", "y").otherwise("x").alias("incarnation"))
    return membership.fold_registry(x, 300)


@query("""WITH m AS (SELECT user_id AS u, 'm' || user_id AS key, min(event_id) AS j, max(event_id) AS h FROM events GROUP BY user_id)
SELECT CASE WHEN u % 13 = 0 THEN key || chr(228) ELSE key END AS key, CASE WHEN u % 13 = 0 THEN 'member id' WHEN u % 11 = 0 THEN 'incarnation' WHEN u % 7 = 0 THEN 'key is not the member id' ELSE 'heartbeat before join' END AS problem FROM m WHERE u % 13 = 0 OR u % 11 = 0 OR u % 7 = 0 OR (u % 5 = 0)
UNION ALL SELECT NULL, p FROM (VALUES ('schema version'), ('stale timeout')) v(p) UNION ALL SELECT NULL, 'more members than shards' FROM m HAVING count(*) > 16""", log=False)
def i11_registry_problems(spark, sf_dir):
    u = F.col("user_id")
    x = synth.events(spark, sf_dir).groupBy("user_id").agg(F.min("event_id").alias("joined_at"), F.max("event_id").alias("h"))
    key = F.concat(F.lit("m"), u.cast("string"))
    own = F.when(u % 13 == 0, F.concat(key, F.lit("ä"))).otherwise(key)
    x = x.select(own.alias("key"), F.when(u % 7 == 0, "x").otherwise(own).alias("member_id"), F.when(u % 11 == 0, "").otherwise("inc").alias("incarnation"), "joined_at", F.when(u % 5 == 0, -1).otherwise(F.col("h")).alias("heartbeat_at"))
    return membership.registry_problems(x, 2, 16, 0)


@query("SELECT user_id, CASE WHEN user_id % 3 <> 0 THEN user_id::INT END AS ordinal FROM (SELECT DISTINCT user_id FROM events)", log=False)
def i12_user_ordinals(spark, sf_dir):
    """Pod names; of every third user the number has a leading zero or another prefix, which is no ordinal."""
    u = F.col("user_id").cast("string")
    name = F.when(F.col("user_id") % 6 == 0, F.concat(F.lit("app-0"), u)).when(F.col("user_id") % 3 == 0, F.concat(F.lit("web-"), u)).otherwise(F.concat(F.lit("app-"), u))
    return synth.events(spark, sf_dir).select("user_id").distinct().select("user_id", membership.stateful_ordinal(name, "app").alias("ordinal"))


def _pod_events(spark, sf_dir):
    """Four clusters: an empty list first, then events; every error begins a list of the pods of the two events before, which ends at once."""
    e = synth.events(spark, sf_dir)
    c = (F.col("user_id") % 4).alias("cluster")
    pod, uid = F.concat(F.lit("p"), (F.col("user_id") % 40).cast("string")), F.concat(F.lit("u"), (F.col("event_id") % 3).cast("string"))
    none = F.lit(None).cast("string")
    row = lambda cluster, at, action, pod, uid, effective: [cluster.alias("cluster"), at.cast("bigint").alias("at"), F.lit(action).alias("action"), pod.alias("pod"), uid.alias("uid"), effective.alias("effective")]
    at, t = F.col("event_id") * 10 + 100, F.col("event_type")
    first = spark.range(4).select(*row(F.col("id"), F.lit(1), "init", none, none, F.lit(False))).union(spark.range(4).select(*row(F.col("id"), F.lit(2), "init_done", none, none, F.lit(False))))
    sets = e.where(t.isin("click", "view", "signup")).select(*row(c, at, "apply", pod, uid, t != "view"))
    drops = e.where(t == "purchase").select(*row(c, at, "delete", pod, uid, F.lit(True)))
    lists = [e.where(t == "error").select(*r) for r in (row(c, at, "init", none, none, F.lit(False)), row(c, at + 1, "init_apply", pod, uid, F.lit(True)), row(c, at + 2, "init_apply", F.lit("px"), F.lit("ux"), F.lit(True)), row(c, at + 3, "init_done", none, none, F.lit(False)))]
    out = first.union(sets).union(drops)
    for x in lists:
        out = out.union(x)
    return out


@query("""WITH e AS (SELECT (user_id % 4)::BIGINT AS c, event_id * 10 + 100 AS t, 'p' || user_id % 40 AS pod, 'u' || event_id % 3 AS uid, event_type AS y FROM events),
done AS (SELECT c, t + 3 AS ends FROM e WHERE y = 'error' UNION ALL SELECT c::BIGINT, 2 FROM range(4) r(c)),
own AS (SELECT c, t, pod, CASE WHEN y <> 'view' THEN uid END AS uid, y <> 'purchase' AS sets FROM e WHERE y <> 'error' UNION ALL SELECT c, t + 3, pod, uid, true FROM e WHERE y = 'error' UNION ALL SELECT c, t + 3, 'px', 'ux', true FROM e WHERE y = 'error'),
seen AS (SELECT o.*, d.ends FROM (SELECT *, lead(t) OVER (PARTITION BY c, pod ORDER BY t) AS nxt FROM own) o ASOF LEFT JOIN done d ON o.c = d.c AND o.t < d.ends),
y AS (SELECT c, t, pod, uid, sets FROM own UNION ALL SELECT c, ends, pod, NULL, true FROM seen WHERE ends IS NOT NULL AND (nxt IS NULL OR nxt > ends)),
n AS (SELECT *, count(*) FILTER (WHERE sets) OVER (PARTITION BY c, pod ORDER BY t) AS n FROM y),
s AS (SELECT *, CASE WHEN n > 0 THEN first_value(uid) OVER (PARTITION BY c, pod, n ORDER BY t) END AS st FROM n),
g AS (SELECT *, CASE WHEN sets THEN uid WHEN NOT coalesce(bool_or(NOT sets AND uid = st) OVER (PARTITION BY c, pod, n ORDER BY t), false) THEN st END AS now FROM s),
f AS (SELECT *, now IS DISTINCT FROM lag(now) OVER (PARTITION BY c, pod ORDER BY t) AS changed FROM g),
gen AS (SELECT c, count(DISTINCT CASE WHEN changed THEN t END) AS generation FROM f GROUP BY c),
last AS (SELECT c, pod, now FROM f QUALIFY row_number() OVER (PARTITION BY c, pod ORDER BY t DESC) = 1)
SELECT gen.c AS cluster, generation, pod, now AS uid FROM gen LEFT JOIN (SELECT * FROM last WHERE now IS NOT NULL) l ON gen.c = l.c""", log=False)
def i13_pods_after(spark, sf_dir):
    pods, generation = membership.pods_after(_pod_events(spark, sf_dir))
    return generation.join(pods, "cluster", "left").select("cluster", "generation", "pod", "uid")


@query("""WITH n AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_type || '-' || user_id WHEN 1 THEN upper(event_type) WHEN 2 THEN event_type || '.' || user_id || '.svc' WHEN 3 THEN '-' || event_type ELSE event_type || chr(9) END AS s FROM events)
SELECT event_id, event_id % 5 <> 4 AS identifier, event_id % 5 = 0 AS label, event_id % 5 IN (0, 2) AS dns_name FROM n""", log=False)
def i16_identifiers(spark, sf_dir):
    k, t, u = F.col("event_id") % 5, F.col("event_type"), F.col("user_id").cast("string")
    name = F.when(k == 0, F.concat(t, F.lit("-"), u)).when(k == 1, F.upper(t)).when(k == 2, F.concat(t, F.lit("."), u, F.lit(".svc"))).when(k == 3, F.concat(F.lit("-"), t)).otherwise(F.concat(t, F.lit("\t")))
    return synth.events(spark, sf_dir).select("event_id", C.is_identifier(name).alias("identifier"), C.is_dns_label(name).alias("label"), C.is_dns_name(name).alias("dns_name"))


# --- metrics


def _labelled(spark, sf_dir):
    """The log with its markers; of the events some are held, some are of an older connection, some failed."""
    k = F.coalesce("event_id", F.lit(1))
    x = _marked(spark, sf_dir).withColumns({"kind": F.when(k % 101 == 7, "frame_9").otherwise(F.col("kind")), "held": k % 10 == 3, "stale": k % 50 == 9, "failed": F.when(k % 1000 == 11, "stream").when(k % 1000 == 12, "mitigation"), "acked": k % 7 != 3})
    return x.withColumn("delivered", ~F.col("held"))


LABELLED_SQL = """AND lab AS (SELECT CASE WHEN k % 101 = 7 THEN 'frame_9' ELSE kind END AS kind, k, k % 10 <> 3 AND k % 50 <> 9 AS sent FROM (SELECT kind, coalesce(event_id, 1) AS k FROM marked)),
c AS (SELECT 3::BIGINT AS bootstrap_attempts, 2::BIGINT AS bootstrap_successes, 1::BIGINT AS bootstrap_failures, 0::BIGINT AS topology_updates, 0::BIGINT AS reconnects, 0::BIGINT AS health_checks, 0::BIGINT AS health_failures, 2::BIGINT AS active_connections, 16::BIGINT AS assigned_shards,
  count(*) FILTER (WHERE sent AND kind <> 'frame_9') AS delivered_events, count(*) FILTER (WHERE sent AND kind = 'mutation') AS mutations, count(*) FILTER (WHERE sent AND kind = 'deletion') AS deletions, count(*) FILTER (WHERE sent AND kind = 'expiration') AS expirations,
  count(*) FILTER (WHERE sent AND kind = 'snapshot_marker') AS snapshot_markers, 0::BIGINT AS seqno_advanced_events, 0::BIGINT AS system_events, 0::BIGINT AS stream_ends, 0::BIGINT AS oso_snapshots,
  count(*) FILTER (WHERE k % 7 <> 3 AND k % 50 <> 9) AS processed_events, count(*) FILTER (WHERE kind = 'frame_9') AS unknown_frames, count(*) FILTER (WHERE k % 1000 = 11) AS stream_errors, count(*) FILTER (WHERE k % 50 = 9) AS stale_generation_drops,
  5::BIGINT AS rollbacks, count(*) FILTER (WHERE k % 10 = 3) AS rollback_mitigation_delays, count(*) FILTER (WHERE k % 1000 = 12) AS rollback_mitigation_failures FROM lab)"""


@query(LABELLED_SQL + " SELECT * FROM c")
def j2_metrics_snapshot(spark, sf_dir):
    return metrics.snapshot(_labelled(spark, sf_dir), {"bootstrap_attempts": 3, "bootstrap_successes": 2, "bootstrap_failures": 1, "active_connections": 2, "assigned_shards": 16}, rollbacks=5)


_PLAIN = [f"('{k}', '', {k}, {'true' if k in metrics.GAUGES else 'false'})" for k in (*metrics.OUTSIDE, "delivered_events", "processed_events", "unknown_frames", "stream_errors", "stale_generation_drops", "rollbacks", "rollback_mitigation_delays", "rollback_mitigation_failures")]


@query(LABELLED_SQL + f""" SELECT 'changelog_' || n || CASE WHEN g THEN '' ELSE '_total' END AS name, l AS label, v::DOUBLE AS value FROM c, LATERAL (VALUES {', '.join(_PLAIN)}, {', '.join(f"('event_deliveries', '{kind}', {k}, false)" for kind, k in metrics.BY_KIND.items())}) f(n, l, v, g)
UNION ALL SELECT 'changelog_health_status', s, CASE WHEN s = 'degraded' THEN 1.0 ELSE 0.0 END::DOUBLE FROM (VALUES ('starting'), ('healthy'), ('degraded'), ('stopped')) h(s)
UNION ALL SELECT 'changelog_health_' || n, '', v::DOUBLE FROM (VALUES ('consecutive_failures', 2), ('topology_generation', 4), ('last_check_timestamp_seconds', 99.5)) h(n, v)""")
def j5_all_families(spark, sf_dir):
    return metrics.all_families(j2_metrics_snapshot(spark, sf_dir), "degraded", 2, 4, 99.5)


@query("SELECT user_id, least(sum(event_id::HUGEINT * 1125899906842624), 18446744073709551615)::DECIMAL(20,0) AS rollbacks FROM events GROUP BY user_id", log=False)
def j3_saturating_count(spark, sf_dir):
    return synth.events(spark, sf_dir).groupBy("user_id").agg(C.saturating_sum(F.col("event_id").cast("decimal(20,0)") * F.lit(2**50)).alias("rollbacks"))


# --- requests, rollbacks, reopening


@query("""SELECT shard, event_id AS at, k AS tries, CASE WHEN k > 16 THEN 'too many' WHEN event_id % 5 = 0 THEN 'does not go back' END AS problem FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY event_id) AS k FROM log)""")
def e9_rollback_chains(spark, sf_dir):
    x = _log(spark, sf_dir).select("shard", F.col("event_id").alias("at"), F.col("seqno").alias("requested"), (F.col("seqno") - F.col("event_id") % 5).alias("rollback"))
    return rollback.chain_problems(x).select("shard", "at", "tries", "problem")


@query(STORED_SQL + """, highs AS (SELECT shard, max(seqno) AS high FROM log GROUP BY shard), """ + FAILOVER_SQL.removeprefix("AND ") + """
SELECT a.shard::INT AS shard, CASE WHEN s.seqno > h.high THEN (SELECT min_by(f.branch, f.pos) FROM f WHERE f.shard = a.shard AND f.seqno <= h.high) ELSE coalesce(s.branch, a.shard * 100) END::BIGINT AS branch,
  CASE WHEN s.seqno > h.high THEN h.high ELSE coalesce(s.seqno, 0) END::BIGINT AS start_seqno, coalesce(h.high, 0)::BIGINT AS end_seqno, CASE WHEN s.seqno > h.high THEN s.seqno END::BIGINT AS requested, CASE WHEN s.seqno > h.high THEN h.high END::BIGINT AS rolled_back_to
FROM range(16) a(shard) LEFT JOIN highs h ON a.shard = h.shard LEFT JOIN stored s ON a.shard = s.shard WHERE h.shard IS NOT NULL""")
def e10_open_report(spark, sf_dir):
    log = _log(spark, sf_dir)
    highs, failover = rollback.high_seqnos(log), _failover(log)
    assigned = _assigned(spark).join(highs.select("shard"), "shard", "left_semi")
    starts = rollback.resolve_starts(rollback.initial_starts(assigned, _stored(spark, sf_dir)), highs, rollback.newest_branch(failover), finite=True)
    x = rollback.open_report(starts, failover)
    return x.select("shard", *[F.col(c).cast("bigint").alias(c) for c in ("branch", "start_seqno", "end_seqno", "requested", "rolled_back_to")])


@query("""SELECT shard, p AS problem FROM (SELECT shard, CASE WHEN s > e THEN 'start after end' WHEN q > e THEN 'seqno after end' WHEN q <> 0 AND q < s THEN 'seqno before start' WHEN q > 300 THEN 'start after stream end' END AS p
  FROM (SELECT shard, seqno - event_id % 3 * 40 AS q, snap_start + event_id % 11 * 10 AS s, snap_end AS e FROM log)) WHERE p IS NOT NULL UNION ALL SELECT shard, 'requested twice' FROM log GROUP BY shard HAVING count(*) > 1""")
def e14_invalid_requests(spark, sf_dir):
    k = F.col("event_id")
    x = _log(spark, sf_dir).select("shard", (F.col("seqno") - k % 3 * 40).alias("seqno"), (F.col("snap_start") + k % 11 * 10).alias("snap_start"), "snap_end", F.lit(300).alias("end_seqno"))
    return rollback.invalid_requests(x)


@query("""AND now AS (SELECT shard, max(seqno) AS seqno, max(snap_start) AS s, max(snap_end) AS e FROM log GROUP BY shard)
SELECT shard, CASE WHEN shard % 3 = 0 THEN s ELSE seqno END AS seqno, s AS snap_start, e AS snap_end, shard % 3 = 0 AND s <> seqno AS moved FROM now""")
def k9_rebase(spark, sf_dir):
    """Every third shard goes back to the start of its last snapshot."""
    now = _log(spark, sf_dir).groupBy("shard").agg(F.max("seqno").alias("seqno"), F.max("snap_start").alias("snap_start"), F.max("snap_end").alias("snap_end"))
    after, _ = ack.rebase(now, now.where("shard % 3 = 0").withColumn("seqno", F.col("snap_start")))
    return after


# --- starts, ends and order of a finite stream


@query("""AND b AS (SELECT shard, max(seqno) // 2 AS stop FROM log GROUP BY shard),
a AS (SELECT m.*, b.stop, last_value(snap_start IGNORE NULLS) OVER w AS s, last_value(snap_end IGNORE NULLS) OVER w AS e, greatest(5, coalesce(max(seqno) OVER (PARTITION BY m.shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS prev
  FROM marked m JOIN b ON m.shard = b.shard WINDOW w AS (PARTITION BY m.shard ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT shard, arrival, CASE WHEN kind = 'snapshot_marker' THEN CASE WHEN e < prev THEN 'marker_behind' WHEN e > stop THEN 'marker_beyond_end' END WHEN e IS NULL THEN 'no_snapshot' WHEN seqno < s OR seqno > e OR seqno > stop THEN 'outside' WHEN seqno <= prev THEN 'non_monotonic' END AS violation FROM a""")
def d3_finite_order(spark, sf_dir):
    """Streams from seqno 5 to half of what each shard has."""
    from tidelog.operators import order

    log = _marked(spark, sf_dir)
    ends = log.groupBy("shard").agg(F.floor(F.max("seqno") / 2).alias("stop"))
    x = order.check_order(log.join(F.broadcast(ends), "shard").withColumn("begin", F.lit(5)), "begin", "stop")
    return x.select("shard", "arrival", "violation")


@query("SELECT a.shard::INT AS shard, coalesce(h.high, 0)::BIGINT AS start_seqno, coalesce(h.high, 0)::BIGINT AS snap_end, (a.shard * 100)::BIGINT AS branch, false AS strict_branch FROM range(16) a(shard) JOIN (SELECT shard, max(seqno) AS high FROM log GROUP BY shard) h ON a.shard = h.shard")
def e2_latest_starts(spark, sf_dir):
    log = _log(spark, sf_dir)
    highs = rollback.high_seqnos(log)
    assigned = _assigned(spark).join(highs.select("shard"), "shard", "left_semi")
    x = rollback.resolve_starts(rollback.initial_starts(assigned, _stored(spark, sf_dir).limit(0), "latest"), highs, rollback.newest_branch(_failover(log)))
    return x.select("shard", "start_seqno", "snap_end", F.col("branch").cast("bigint").alias("branch"), "strict_branch")


@query(STORED_SQL + """ SELECT shard, '{"uid":"' || lower(hex(shard * 3 + 1)) || '","collections":["8","a"]}' AS filter FROM stored""")
def e6_start_filters(spark, sf_dir):
    """A checkpoint's manifest goes into the filter of its stream."""
    stored = _stored(spark, sf_dir).withColumn("manifest_uid", F.col("shard").cast("bigint") * 3 + 1)
    log = _log(spark, sf_dir)
    starts = rollback.resolve_starts(rollback.initial_starts(_assigned(spark), stored), rollback.high_seqnos(log), rollback.newest_branch(_failover(log)))
    ids = F.array(F.lit(8).cast("bigint"), F.lit(10).cast("bigint"))
    none = F.lit(None).cast("bigint")
    return starts.where("start = 'checkpoint'").select("shard", C.stream_filter_json(F.col("manifest_uid"), ids, none, none).alias("filter"))


@query("""AND k AS (SELECT event_id AS id, seqno AS q, key, event_id % 9 AS k FROM log)
SELECT id, CASE k WHEN 0 THEN 'deletion' WHEN 1 THEN 'expiration' WHEN 2 THEN 'snapshot_marker' WHEN 3 THEN 'snapshot_marker' WHEN 4 THEN 'stream_end' WHEN 5 THEN 'seqno_advanced' WHEN 6 THEN 'system_event' ELSE 'oso_snapshot' END AS kind,
  CASE WHEN k IN (0, 1, 5, 6) THEN q END AS seqno, CASE WHEN k IN (0, 1) THEN q + 9 END AS delete_time, CASE WHEN k IN (2, 3) THEN q END AS snap_start, CASE WHEN k IN (2, 3) THEN q + 6 END AS snap_end, CASE WHEN k = 3 THEN q + 1 END AS max_visible_seqno, CASE WHEN k = 3 THEN q + 3 END AS purge_seqno,
  CASE WHEN k = 4 THEN CASE id % 8 WHEN 0 THEN 'ok' WHEN 1 THEN 'closed' WHEN 2 THEN 'state_changed' WHEN 3 THEN 'disconnected' WHEN 4 THEN 'too_slow' WHEN 5 THEN 'backfill_failed' WHEN 7 THEN 'filter_empty' ELSE 'unknown' END END AS end_reason,
  CASE WHEN k = 6 THEN CASE id % 6 WHEN 0 THEN 'create_collection' WHEN 1 THEN 'drop_collection' WHEN 2 THEN 'flush_collection' WHEN 3 THEN 'create_scope' WHEN 4 THEN 'drop_scope' ELSE 'change_collection' END END AS sys_kind,
  CASE WHEN k = 6 THEN q + 42 END AS manifest_uid, CASE WHEN k = 6 AND id % 6 IN (0, 1, 3, 4) THEN 8 END::BIGINT AS scope_id, CASE WHEN k IN (0, 1) THEN 300 WHEN k = 6 AND id % 6 IN (0, 1) THEN 17 WHEN k = 6 AND id % 6 IN (2, 5) THEN 8 END::BIGINT AS collection_id,
  CASE WHEN k = 6 AND id % 6 = 0 THEN 60 WHEN k = 6 AND id % 6 = 5 THEN 17 END::BIGINT AS max_ttl, CASE WHEN k = 7 THEN CASE id % 2 WHEN 0 THEN 'begin' ELSE 'end' END END AS oso_state, CASE WHEN k IN (0, 1, 6) THEN key ELSE '' END AS key, NULL::VARCHAR AS malformed FROM k WHERE k < 8""")
def b9_wire_events(spark, sf_dir):
    """A frame of every other kind for each event, put together with Column expressions; no-ops leave."""
    i, q, key, none = F.col("event_id"), F.col("seqno"), F.col("key").cast("binary"), F.lit(b"")
    k = i % 9

    def by_kind(*values, default=none):
        out = default
        for n, v in reversed(list(enumerate(values))):
            out = F.when(k == n, v).otherwise(out)
        return out

    gone = F.concat(be(q, 8), be(F.lit(1), 8), be(q + 9, 4))
    system = F.concat(be(q, 8), be(i % 6, 4), be(F.lit(1), 1))
    extras = by_kind(gone, gone, F.concat(be(q, 8), be(q + 6, 8), be(F.lit(1), 4)), be(F.lit(2), 1), be(i % 8, 4), be(q, 8), system, be(i % 2 + 0, 4))
    v2 = F.concat(be(q, 8), be(q + 6, 8), be(F.lit(1), 4), *[be(q + d, 8) for d in (1, 2, 4, 3)])
    value = by_kind(none, none, none, v2, none, none, F.concat(be(q + 42, 8), be(F.lit(8), 4), be(F.lit(17), 4), be(F.lit(60), 4)))
    name = by_kind(*[F.concat(F.unhex(F.lit("ac02")), key)] * 2, none, none, none, none, key)
    opcode = F.unhex(by_kind(*[F.lit(x) for x in ("58", "59", "56", "56", "55", "64", "5f", "65")], default=F.lit("5c")))
    x = _log(spark, sf_dir).select("event_id", extras.alias("e"), value.alias("v"), name.alias("n"), opcode.alias("o"))
    size = F.length("e") + F.length("v") + F.length("n")
    head = F.concat(F.unhex(F.lit("80")), F.col("o"), be(F.length("n"), 2), be(F.length("e"), 1), F.unhex(F.lit("000000")), be(size, 4), F.unhex(F.lit("00" * 12)))
    y = wire.decode_events(wire.decode_frames(x.select("event_id", F.concat(head, "e", "n", "v").alias("frame"))))
    return y.select(
        F.col("event_id").alias("id"), "kind", "seqno", "delete_time", "snap_start", "snap_end", "max_visible_seqno", "purge_seqno", "end_reason", "sys_kind", "manifest_uid", "scope_id", "collection_id", "max_ttl", "oso_state", F.col("key").cast("string").alias("key"), "malformed"
    )


@query("SELECT event_id, event_id % 256 BETWEEN 80 AND 101 AS counts FROM events", log=False)
def c11_flow_opcodes(spark, sf_dir):
    return synth.events(spark, sf_dir).select("event_id", C.counts_for_flow(F.col("event_id") % 256).alias("counts"))


@query("SELECT event_id, user_id % 3 > 1 OR (user_id % 3 = 1 AND (event_id % 7 = 0 OR event_id % 7 > 3)) AS newer FROM events", log=False)
def h7_newer_revisions(spark, sf_dir):
    return synth.events(spark, sf_dir).select("event_id", C.is_newer_revision(F.col("user_id") % 3, F.col("event_id") % 7, F.lit(1), F.lit(3)).alias("newer"))


PODS_SQL = "p AS (SELECT user_id AS u, min(event_id) // 10 AS created_at, CASE WHEN user_id % 4 = 1 THEN 'Pending' ELSE 'Running' END AS phase, user_id % 5 <> 2 AS ready, user_id % 7 = 3 AS terminating FROM events GROUP BY user_id)"


@query(f"WITH {PODS_SQL} SELECT 'p' || u AS name, (row_number() OVER (ORDER BY created_at, 'u' || (u % 10), 'p' || u))::INT AS member_number FROM p WHERE phase = 'Running' AND ready AND NOT terminating", log=False)
def c13_effective_pods(spark, sf_dir):
    u = F.col("user_id")
    pods = synth.events(spark, sf_dir).groupBy("user_id").agg(F.floor(F.min("event_id") / 10).alias("created_at"))
    pods = pods.select(F.concat(F.lit("p"), u.cast("string")).alias("name"), F.concat(F.lit("u"), (u % 10).cast("string")).alias("uid"), "created_at", F.when(u % 4 == 1, "Pending").otherwise("Running").alias("phase"), (u % 5 != 2).alias("ready"), (u % 7 == 3).alias("terminating"))
    return membership.effective_pods(pods).select("name", "member_number")


@query("SELECT event_id, CASE WHEN event_id % 4 = 1 THEN '_default' ELSE CASE collection_id WHEN 8 THEN 'clicks' WHEN 9 THEN 'views' WHEN 10 THEN 'purchases' END END AS collection_name FROM log")
def g6_legacy_names(spark, sf_dir):
    """Documents without a collection id are of the default collection; unmapped ones have no name where that isn't an error."""
    from tidelog.plans.catalogue import _dim

    x = _log(spark, sf_dir).withColumn("collection_id", F.when(F.col("event_id") % 4 != 1, F.col("collection_id")))
    return collections.decorate(x, _dim(spark), strict=False).select("event_id", "collection_name")


@query(STORED_SQL + """ SELECT shard, CASE WHEN shard % 7 <> 6 THEN seqno END AS seqno, CASE WHEN shard >= 14 THEN 'not asked for' WHEN shard % 7 = 6 THEN 'unreadable' WHEN shard % 5 = 4 THEN 'another bucket' END AS problem FROM stored""")
def e3_checkpoint_identity(spark, sf_dir):
    """Stored documents read back: some of another bucket, some broken, some of shards that nobody asked for."""
    from tidelog.sources import checkpoints

    x = _stored(spark, sf_dir).withColumn("bucket_uuid", F.when(F.col("shard") % 5 == 4, "other").otherwise("bucket-id"))
    json = F.when(F.col("shard") % 7 == 6, "{").otherwise(checkpoints.document_json())
    return checkpoints.identities(x.select("shard", json.alias("json")), "bucket-id", spark.range(14).select(F.col("id").cast("int").alias("shard")))
