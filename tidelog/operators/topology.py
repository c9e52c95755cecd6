"""Cluster topology: routes, nodes, differences between revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import is_newer_revision

MAP = "rev bigint, revEpoch bigint, name string, uuid string, nodeLocator string, nodesExt array<struct<hostname:string,nodeUUID:string,services:map<string,int>>>, vBucketServerMap struct<hashAlgorithm:string,numReplicas:int,serverList:array<string>,vBucketMap:array<array<int>>>"


def parse_routes(docs: DataFrame) -> DataFrame:
    """json -> rev, epoch, bucket, bucket_uuid, shard, active, replicas (server addresses), problem: a row per shard."""
    m = docs.select(F.from_json("json", MAP).alias("m")).select("m.rev", F.col("m.revEpoch").alias("epoch"), F.col("m.name").alias("bucket"), F.col("m.uuid").alias("bucket_uuid"), F.col("m.vBucketServerMap").alias("v"))
    x = m.select("rev", "epoch", "bucket", "bucket_uuid", F.col("v.serverList").alias("servers"), F.col("v.numReplicas").alias("replicas_n"), F.posexplode("v.vBucketMap").alias("shard", "row"))
    n = F.size("servers")
    problem = (
        F.when(F.size("row") != F.col("replicas_n") + 1, "row width").when(F.element_at("row", 1) < 0, "no active node").when(F.exists("row", lambda i: (i < -1) | (i >= n)), "node out of range")
    )
    name = lambda i: F.when(i >= 0, F.get(F.col("servers"), i))
    return x.select(
        "rev", "epoch", "bucket", "bucket_uuid", "shard", name(F.element_at("row", 1)).alias("active"),
        F.filter(F.transform(F.slice("row", 2, F.size("row")), name), lambda s: s.isNotNull()).alias("replicas"), problem.alias("problem"),
    )


def shards_by_node(routes: DataFrame, with_replicas: bool = False) -> DataFrame:
    """node, shards (sorted, distinct) of active copies, or of all."""
    nodes = F.array_distinct(F.concat(F.array("active"), F.col("replicas"))) if with_replicas else F.array("active")
    return routes.select("shard", F.explode(nodes).alias("node")).groupBy("node").agg(F.array_sort(F.collect_set("shard")).alias("shards"))


def route_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """shard, change (added, removed, rerouted) between two tables (shard, active)."""
    j = old.select("shard", F.col("active").alias("was"), F.lit(True).alias("_o")).join(new.select("shard", F.col("active").alias("now"), F.lit(True).alias("_n")), "shard", "full_outer")
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "rerouted")
    return j.select("shard", "was", "now", change.alias("change")).where("change IS NOT NULL")


def node_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """node, change (added, removed, reconnect) between two tables (node, address)."""
    j = old.select("node", F.col("address").alias("was"), F.lit(True).alias("_o")).join(new.select("node", F.col("address").alias("now"), F.lit(True).alias("_n")), "node", "full_outer")
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "reconnect")
    return j.select("node", change.alias("change")).where("change IS NOT NULL")


def document_problems(docs: DataFrame) -> DataFrame:
    """docs (json and other columns) with rev, epoch, bucket and problem: what makes a document unusable before its map is read."""
    m = F.col("_m")
    x = docs.withColumn("_m", F.from_json("json", MAP))
    problem = (
        F.when(m.isNull() | m["rev"].isNull() & m["name"].isNull(), "no document").when((m["rev"] < 0) | (F.coalesce(m["revEpoch"], F.lit(0)) < 0), "negative revision")
        .when(F.trim(F.coalesce(m["name"], F.lit(""))) == "", "no bucket name").when(F.coalesce(m["nodeLocator"], F.lit("")) != "vbucket", "node locator")
        .when(F.coalesce(m["vBucketServerMap"]["hashAlgorithm"], F.lit("")) != "CRC", "hash algorithm")
    )
    return x.withColumns({"rev": m["rev"], "epoch": m["revEpoch"], "bucket": m["name"], "problem": problem}).drop("_m")


def apply_revisions(current: DataFrame, candidate: DataFrame, generation: int) -> DataFrame:
    """bucket, generation, shard, was, now, change: what a newer revision of a bucket's routes changes; an older or equal one changes nothing.

    Both as parse_routes() gives them. A bucket whose uuid differs has one row with
    the change `bucket uuid changed`. A row per shard and bucket on either side.
    """
    head = lambda x, k: x.groupBy("bucket").agg(*[F.max(c).alias(f"{k}_{c}") for c in ("rev", "epoch", "bucket_uuid")])
    both = head(current, "old").join(head(candidate, "new"), "bucket")
    newer = is_newer_revision(F.col("new_epoch"), F.col("new_rev"), F.col("old_epoch"), F.col("old_rev"))
    both = both.select("bucket", newer.alias("newer"), F.coalesce(F.col("old_bucket_uuid") != F.col("new_bucket_uuid"), F.lit(False)).alias("other"))
    side = lambda x, name: x.join(F.broadcast(both.where("newer AND NOT other").select("bucket")), "bucket").select("bucket", "shard", F.col("active").alias(name), F.lit(True).alias(f"_{name}"))
    j = side(current, "was").join(side(candidate, "now"), ["bucket", "shard"], "full_outer")
    change = F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "rerouted")
    out = j.select("bucket", F.lit(generation + 1).cast("bigint").alias("generation"), "shard", "was", "now", change.alias("change")).where("change IS NOT NULL")
    none = F.lit(None)
    return out.union(both.where("other").select("bucket", none.cast("bigint"), none.cast("int"), none.cast("string"), none.cast("string"), F.lit("bucket uuid changed")))
