"""Assignment of shards to members, and membership as tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.errors import InvalidConfiguration
from tidelog.functions.columns import is_identifier
from tidelog.operators import order

MOST_SHARDS = 65536


def owner(shard: Column, shards: int, members: int) -> Column:
    """The member (from 1) of a shard: contiguous runs, the first shards % members have one more. Arithmetic, no window."""
    small, extra = divmod(shards, members)
    border = extra * (small + 1)
    late = F.lit(extra) + F.floor((shard - border) / max(small, 1))
    return (F.when(shard < border, F.floor(shard / (small + 1))).otherwise(late) + 1).cast("int")


def balanced(spark: SparkSession, shards: int, members: int, generation: int = 1) -> DataFrame:
    """generation, shard, member for all shards."""
    if not 0 < shards <= MOST_SHARDS or not 0 < members <= shards:
        raise InvalidConfiguration(f"{members} members cannot share {shards} shards")
    x = spark.range(shards).select(F.col("id").cast("int").alias("shard"))
    return x.select(F.lit(generation).cast("bigint").alias("generation"), "shard", owner(F.col("shard"), shards, members).alias("member"))


def member_numbers(members: DataFrame, ranges: int = 64, by: tuple[str, ...] = ("joined_at", "member_id")) -> DataFrame:
    """members with member_number, in order of the columns `by`, which have no nulls.

    A sample of at most about 16 rows per range gives the ranges' bounds; each range
    is numbered by itself, from the count of all before it (a row per range).
    """
    at, kind = F.struct(*by), {f.name: f.dataType for f in members.schema.fields}
    share = min(1.0, 16 * ranges / max(members.count(), 1))
    drawn = members.select(*by).where(F.pmod(F.xxhash64(*by), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).orderBy(*by).collect()
    bounds = [F.struct(*[F.lit(r[c]).cast(kind[c]).alias(c) for c in by]) for r in drawn[:: max(1, len(drawn) // ranges)]]
    part = F.size(F.filter(F.array(*bounds), lambda b: b <= at)) if bounds else F.lit(0)
    x = members.withColumn("_range", part)
    before = x.groupBy("_range").count().withColumn("_before", F.sum("count").over(Window.orderBy("_range")) - F.col("count")).drop("count")
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*by))
    return x.withColumn("_n", number).join(F.broadcast(before), "_range").withColumn("member_number", (F.col("_n") + F.col("_before")).cast("int")).drop("_range", "_n", "_before")


def is_stale(now: Column, heartbeat: Column, stale_after: int) -> Column:
    return F.greatest(now - heartbeat, F.lit(0)) >= stale_after


def prune(members: DataFrame, now: int, stale_after: int) -> DataFrame:
    return members.where(~is_stale(F.lit(now), F.col("heartbeat_at"), stale_after))


def fold_registry(events: DataFrame, stale_after: int) -> DataFrame:
    """Final members from events (at, action, member_id, incarnation), action: join, heartbeat or leave.

    Of each member the last join that took effect counts: the same incarnation
    joins again as a heartbeat; another one is refused while the first is live.
    A member's events are sorted by Spark, which can spill, and folded in batches with
    the state carried on, so a long history needs no more memory than a short one.
    """

    def step(m: tuple, rows: pd.DataFrame) -> tuple:
        for at, action, incarnation in zip(rows["at"].tolist(), rows["action"], rows["incarnation"]):
            if m and incarnation is not None and m[0] == incarnation:
                m = () if action == "leave" else (incarnation, m[1], max(m[2], at)) if action in ("join", "heartbeat") else m
            elif action == "join" and (not m or max(at - m[2], 0) >= stale_after):
                m = (incarnation, at, at)
        return m

    rows = events.select(F.col("member_id").alias("shard"), "at", "action", "incarnation")
    kind = events.schema["member_id"].dataType.simpleString()
    out = order.fold_shards(rows, ["at", "action", "incarnation"], step, (), lambda m: m or (None, None, None), f"shard {kind}, incarnation string, joined_at bigint, heartbeat_at bigint")
    return out.where("joined_at IS NOT NULL").withColumnRenamed("shard", "member_id")


def stateful_ordinal(name: Column, prefix: str) -> Column:
    """The canonical ordinal of a pod name `prefix-N`; null if it is none."""
    digits = F.regexp_extract(name, f"^{prefix}-(0|[1-9][0-9]*)$", 1)
    return F.when(digits != "", digits.cast("int"))


def effective_pods(pods: DataFrame) -> DataFrame:
    """Pods that count, numbered by (created_at, uid, name): running, ready and not terminating."""
    x = pods.where((F.col("phase") == "Running") & F.col("ready") & ~F.col("terminating"))
    return member_numbers(x, by=("created_at", "uid", "name"))


def assignment_problems(assigned: DataFrame, routes: DataFrame) -> DataFrame:
    """shard, problem: assigned shards that the topology doesn't have or that have no active node; nothing assigned is a row without a shard."""
    r = F.broadcast(routes.select("shard", "active", F.lit(True).alias("_there")))  # at most 65536
    x = assigned.select("shard").distinct().join(r, "shard", "left")
    problem = F.when(F.col("_there").isNull(), "unknown shard").when(F.col("active").isNull(), "no active node")
    none = assigned.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("int").alias("shard"), F.lit("no shard assigned").alias("problem"))
    return x.select("shard", problem.alias("problem")).where("problem IS NOT NULL").union(none)


SCHEMA_VERSION = 1


def registry_problems(members: DataFrame, schema_version: int, shards: int, stale_after: int) -> DataFrame:
    """key, problem of a registry: members (key, member_id, incarnation, joined_at, heartbeat_at), the first problem of each; its settings as rows without a key."""
    k = F.col("key")
    own = (
        F.when(~is_identifier(k), "member id").when(~is_identifier(F.col("incarnation")), "incarnation").when(~k.eqNullSafe(F.col("member_id")), "key is not the member id")
        .when(F.col("heartbeat_at") < F.col("joined_at"), "heartbeat before join")
    )
    n = F.col("n")
    checks = [(F.lit(schema_version != SCHEMA_VERSION), "schema version"), (F.lit(not 0 < shards <= MOST_SHARDS), "shard count"), (F.lit(stale_after == 0), "stale timeout"), (n > shards, "more members than shards")]
    heads = F.filter(F.array(*[F.when(c, F.lit(what)) for c, what in checks]), lambda p: p.isNotNull())
    settings = members.agg(F.count("*").alias("n")).select(F.lit(None).cast("string").alias("key"), F.explode(heads).alias("problem"))
    return members.select("key", own.alias("problem")).where("problem IS NOT NULL").union(settings)


def _next_mark(rows: DataFrame, marks: DataFrame, name: str, bucket_rows: int = 50_000) -> DataFrame:
    """rows (cluster, at, ...) with the struct `name` (at, action) of the first mark of their cluster after them, or null.

    Rows meet the marks of their own stretch of time; a stretch without a later mark
    takes the first one of those after it, found on a row per cluster and stretch. So
    a cluster of very many rows is spread over tasks.
    """
    mark = F.struct("at", "action").alias("m")
    u = rows.select(F.struct("*").alias("r"), "cluster", "at", F.lit(None).cast("struct<at:bigint,action:string>").alias("m")).union(marks.select(F.lit(None).cast(rows.schema).alias("r"), "cluster", "at", mark))
    low, high, n = u.agg(F.min("at"), F.max("at"), F.count("*")).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // max(1, -(-n // bucket_rows))))
    u = u.withColumn("stretch", F.floor((F.col("at") - F.lit(low or 0)) / F.lit(width)))
    back = Window.partitionBy("cluster", "stretch").orderBy(F.desc("at"), F.col("m").isNotNull())
    u = u.withColumn("own", F.last("m", ignorenulls=True).over(back))
    heads = u.groupBy("cluster", "stretch").agg(F.min("m").alias("head"))
    after = Window.partitionBy("cluster").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("cluster", "stretch", F.last("head", ignorenulls=True).over(after).alias("later"))
    return u.where("r IS NOT NULL").join(heads, ["cluster", "stretch"]).select("r.*", F.coalesce("own", "later").alias(name))


def pod_timeline(events: DataFrame) -> DataFrame:
    """What each watch event does to each pod's place among the effective pods: cluster, at, pod, uid (null: none) and changed.

    events: cluster, at, action (init, init_apply, init_done, apply, delete), pod, uid,
    effective. A relist takes effect at its init_done, for all pods at once: those not
    in the list go. A delete counts only for the uid that is there.

    A pod has a row for each event of its own, and one for the first list after it that
    the pod is not in: later lists without it change nothing. So there are at most twice
    as many rows as events, however many pods and lists a cluster has.
    """
    lists, dones = (events.where(F.col("action").isin(*kinds)).select("cluster", "at", "action") for kinds in (("init", "init_done"), ("init_done",)))
    listed = _next_mark(events.where("action = 'init_apply' AND effective").select("cluster", "at", "pod", "uid"), lists, "ends").where("ends.action = 'init_done'")
    listed = listed.select("cluster", F.col("ends.at").alias("at"), "pod", "uid", F.lit("set").alias("does"))
    single = events.where("action IN ('apply', 'delete')").select("cluster", "at", "pod", F.when((F.col("action") == "delete") | F.col("effective"), F.col("uid")).alias("uid"), F.when(F.col("action") == "delete", "remove").otherwise("set").alias("does"))
    own = listed.union(single)
    by_pod = Window.partitionBy("cluster", "pod").orderBy("at")
    seen = _next_mark(own.withColumn("next", F.lead("at").over(by_pod)), dones, "list")
    mine = F.struct("at", "uid", "does")
    missed = F.when(F.col("list").isNotNull() & (F.col("next").isNull() | (F.col("next") > F.col("list.at"))), F.struct(F.col("list.at").alias("at"), F.lit(None).cast("string").alias("uid"), F.lit("set").alias("does")))
    before = by_pod.rowsBetween(Window.unboundedPreceding, -1)
    y = seen.select("cluster", "pod", F.explode(F.array_compact(F.array(mine, missed))).alias("e")).select("cluster", "pod", "e.*")
    y = y.withColumns({"_set": F.last(F.when(F.col("does") == "set", F.struct("at", "uid")), ignorenulls=True).over(before), "_n": F.sum((F.col("does") == "set").cast("int")).over(by_pod)})
    # within a run that begins with a set, the first delete of its uid removes it
    run = Window.partitionBy("cluster", "pod", "_n").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.first("uid").over(Window.partitionBy("cluster", "pod", "_n").orderBy("at"))
    y = y.withColumn("_start", F.when(F.col("_n") > 0, start))
    hit = (F.col("does") == "remove") & F.col("uid").eqNullSafe(F.col("_start")) & F.col("uid").isNotNull()
    y = y.withColumn("_gone", F.coalesce(F.max(hit.cast("int")).over(run), F.lit(0)) == 1).withColumn("_hit", hit)
    y = y.withColumn("now", F.when((F.col("does") == "set"), F.col("uid")).otherwise(F.when(~F.col("_gone") & ~F.col("_hit"), F.col("_start"))))
    y = y.withColumn("was", F.lag("now").over(by_pod))
    return y.select("cluster", "at", "pod", F.col("now").alias("uid"), (~F.col("now").eqNullSafe(F.col("was"))).alias("changed"))


def pods_after(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cluster, pod, uid) of the effective pods after all events, and (cluster, generation): one more for each event that changed any."""
    t = pod_timeline(events)
    last = t.groupBy("cluster", "pod").agg(F.max_by(F.struct("uid"), "at").alias("r")).select("cluster", "pod", "r.uid").where("uid IS NOT NULL")
    return last, t.groupBy("cluster").agg(F.count_distinct(F.when(F.col("changed"), F.col("at"))).alias("generation"))


def pod_problems(events: DataFrame) -> DataFrame:
    """events out of sequence: cluster, at, problem. A list entry or an end without a list, a single event before or during one, a pod twice in a list."""
    order = Window.partitionBy("cluster").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    last = lambda kinds: F.max(F.when(F.col("action").isin(*kinds), F.col("at"))).over(order)
    x = events.withColumns({"_init": last(["init"]), "_done": last(["init_done"])})
    open_ = F.col("_init").isNotNull() & (F.col("_done").isNull() | (F.col("_init") > F.col("_done")))
    x = x.withColumn("_again", F.count("*").over(Window.partitionBy("cluster", "_init", "action", "pod").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)) > 0)
    single = F.col("action").isin("apply", "delete")
    problem = (
        F.when(F.col("action").isin("init_apply", "init_done") & ~open_, "no list is open").when((F.col("action") == "init_apply") & F.col("_again"), "pod twice in a list")
        .when(single & F.col("_done").isNull(), "before the first list").when(single & open_, "during a list")
    )
    return x.select("cluster", "at", problem.alias("problem")).where("problem IS NOT NULL")
