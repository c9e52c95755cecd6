"""Collection names: manifests, name lookup, versions by schema events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.errors import CollectionError
from tidelog.functions.columns import hex_number

MANIFEST = "uid string, scopes array<struct<uid:string,name:string,collections:array<struct<uid:string,name:string,maxTTL:bigint,history:boolean>>>>"


def parse_manifest(manifests: DataFrame) -> DataFrame:
    """json -> manifest_uid, scope_id, scope, collection_id, collection, max_ttl, history; a row per collection (or empty scope)."""
    m = manifests.select(F.from_json("json", MANIFEST).alias("m")).select(hex_number(F.col("m.uid")).alias("manifest_uid"), F.explode("m.scopes").alias("s"))
    m = m.select("manifest_uid", hex_number(F.col("s.uid")).alias("scope_id"), F.col("s.name").alias("scope"), F.explode_outer("s.collections").alias("c"))
    return m.select(
        "manifest_uid", "scope_id", "scope", hex_number(F.col("c.uid")).alias("collection_id"), F.col("c.name").alias("collection"),
        F.coalesce("c.maxTTL", F.lit(0)).alias("max_ttl"), F.coalesce("c.history", F.lit(False)).alias("history"),
    )


def manifest_problems(dim: DataFrame) -> DataFrame:
    """problem, what, n: ids or names used twice. Collection ids are unique over all scopes, names within one."""
    scopes = dim.select("scope_id", "scope").distinct()
    c = dim.where("collection_id IS NOT NULL")

    def twice(df: DataFrame, by: list[str], problem: str) -> DataFrame:
        return df.groupBy(*by).count().where("count > 1").select(F.lit(problem).alias("problem"), F.concat_ws("/", *by).alias("what"), F.col("count").alias("n"))

    out = twice(scopes, ["scope_id"], "scope id").union(twice(scopes, ["scope"], "scope name"))
    return out.union(twice(c, ["collection_id"], "collection id")).union(twice(c, ["scope", "collection"], "collection name"))


def resolve(dim: DataFrame, scope: str, names: tuple[str, ...]) -> tuple[int | None, list[int]]:
    """(scope id, []) for a whole scope, else (None, ids in the order of names). Missing ones are an error. dim is one manifest."""
    rows = dim.where(F.col("scope") == scope).select("scope_id", "collection", "collection_id").collect()
    if not rows:
        raise CollectionError(f"no scope {scope!r}")
    if not names:
        return rows[0]["scope_id"], []
    ids = {r["collection"]: r["collection_id"] for r in rows if r["collection"] is not None}
    if missing := [n for n in names if n not in ids]:
        raise CollectionError(f"no collection {missing}")
    return None, [ids[n] for n in names]


def decorate(log: DataFrame, dim: DataFrame, strict: bool = True) -> DataFrame:
    """log with collection_name of document events; a null id is the legacy default collection.

    A manifest is small (a row per collection), so Spark's own threshold decides on
    a broadcast. With strict, a document outside the selection fails the job.
    """
    names = dim.where("collection_id IS NOT NULL").select(F.col("collection_id").alias("_id"), F.col("collection").alias("_name"))
    x = log.drop("collection_name").join(names, F.col("collection_id") == F.col("_id"), "left")
    doc = F.col("kind").isin("mutation", "deletion", "expiration")
    name = F.when(doc, F.when(F.col("collection_id").isNull(), F.lit("_default")).otherwise(F.col("_name")))
    if strict:
        name = F.when(doc & F.col("collection_id").isNotNull() & F.col("_name").isNull(), F.raise_error(F.concat(F.lit("unmapped collection "), F.col("collection_id").cast("string")))).otherwise(name)
    return x.withColumn("collection_name", name).drop("_id", "_name")


def name_versions(dim: DataFrame, changes: DataFrame, scope_id: int | None = None, whole_scope: bool = True) -> DataFrame:
    """collection_id, name, from_uid, to_uid: which name an id has at which manifest version.

    changes: manifest_uid, sys_kind, collection_id, name (and scope_id, if given).
    Only events above the manifest take effect, and only those of the scope. Creates
    count for a selection of the whole scope; a drop closes the name; a dropped scope
    closes all of its own names (all names, where changes don't tell scopes). Tables of
    a row per collection and change; a scope's names meet its drops by its id.
    """
    base = dim.where("collection_id IS NOT NULL").select("collection_id", F.col("collection").alias("name"), F.col("manifest_uid").alias("from_uid"), F.lit(True).alias("live"))
    first = dim.agg(F.max("manifest_uid").alias("_first"))  # one row
    later = changes.join(F.broadcast(first)).where(F.col("manifest_uid") > F.coalesce("_first", F.lit(-1)))
    if scope_id is not None:
        later = later.where(F.col("scope_id") == scope_id)
    made = later.where((F.col("sys_kind") == "create_collection") & F.lit(whole_scope)).select("collection_id", "name", F.col("manifest_uid").alias("from_uid"), F.lit(True).alias("live"))
    none = F.lit(None).cast("string")
    gone = later.where("sys_kind = 'drop_collection'").select("collection_id", none.alias("name"), F.col("manifest_uid").alias("from_uid"), F.lit(False).alias("live"))
    scope = F.col("scope_id") if "scope_id" in changes.columns else F.lit(0).cast("bigint")
    ids = dim.where("collection_id IS NOT NULL").select("collection_id", scope.alias("_scope"))
    ids = ids.union(later.where((F.col("sys_kind") == "create_collection") & F.lit(whole_scope)).select("collection_id", scope.alias("_scope"))).distinct()
    dropped = later.where("sys_kind = 'drop_scope'").select(scope.alias("_scope"), F.col("manifest_uid").alias("from_uid"))
    cleared = ids.join(dropped, "_scope").select("collection_id", none.alias("name"), "from_uid", F.lit(False).alias("live"))
    w = Window.partitionBy("collection_id").orderBy("from_uid")
    x = base.union(made).union(gone).union(cleared).withColumn("to_uid", F.lead("from_uid").over(w))
    return x.where("live").drop("live")


def registry_problems(dim: DataFrame, changes: DataFrame, scope_id: int, whole_scope: bool = True) -> DataFrame:
    """manifest_uid, problem, collection_id, name: changes that contradict what is live before them.

    An id created again under another name, a name created for another id, or a drop
    of an id that is not there.
    """
    v = name_versions(dim, changes, scope_id, whole_scope).select(F.col("collection_id").alias("_id"), F.col("name").alias("_name"), "from_uid", "to_uid")
    first = dim.agg(F.max("manifest_uid").alias("_first"))
    later = changes.join(F.broadcast(first)).where((F.col("manifest_uid") > F.coalesce("_first", F.lit(-1))) & (F.col("scope_id") == scope_id))
    live = (F.col("from_uid") < F.col("manifest_uid")) & (F.col("to_uid").isNull() | (F.col("manifest_uid") <= F.col("to_uid")))
    made = later.where((F.col("sys_kind") == "create_collection") & F.lit(whole_scope))
    renamed = made.join(v, live & (F.col("collection_id") == F.col("_id")) & (F.col("name") != F.col("_name"))).select("manifest_uid", F.lit("id renamed").alias("problem"), "collection_id", "name")
    taken = made.join(v, live & (F.col("collection_id") != F.col("_id")) & (F.col("name") == F.col("_name"))).select("manifest_uid", F.lit("name taken").alias("problem"), "collection_id", "name")
    absent = later.where("sys_kind = 'drop_collection'").join(v, live & (F.col("collection_id") == F.col("_id")), "left_anti").select("manifest_uid", F.lit("drop of an absent id").alias("problem"), "collection_id", "name")
    return renamed.union(taken).union(absent)


def registry_status(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """manifest_uid, stale: the newest manifest seen, and whether an event of an unknown kind came after the first. One row."""
    first = dim.agg(F.max("manifest_uid").alias("_first"))
    later = changes.join(F.broadcast(first), F.col("manifest_uid") > F.col("_first"), "right")
    known = F.col("sys_kind").isin("create_collection", "drop_collection", "flush_collection", "create_scope", "drop_scope", "change_collection")
    return later.agg(F.coalesce(F.max("manifest_uid"), F.max("_first")).alias("manifest_uid"), F.coalesce(F.max(~known), F.lit(False)).alias("stale"))


def decorate_versioned(log: DataFrame, versions: DataFrame, initial_uid: int, before: str | None = None) -> DataFrame:
    """log (with manifest_uid on system events) with the version in force and the name at that version; null where none is.

    before: a column with the version that a shard had before the log's first row, if any.
    """
    w = Window.partitionBy("shard").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.greatest(F.lit(initial_uid).cast("bigint"), F.max(F.when(F.col("kind") == "system_event", F.col("manifest_uid"))).over(w), *([F.col(before)] if before else []))
    x = log.withColumn("manifest_version", seen)
    v = versions.select(F.col("collection_id").alias("_id"), F.col("name").alias("_name"), "from_uid", "to_uid")
    inside = (F.col("collection_id") == F.col("_id")) & (F.col("from_uid") <= F.col("manifest_version")) & (F.col("to_uid").isNull() | (F.col("manifest_version") < F.col("to_uid")))
    return x.join(v, inside, "left").withColumn("collection_name", F.col("_name")).drop("_id", "_name", "from_uid", "to_uid")


def decorate_by_log(log: DataFrame, dim: DataFrame) -> DataFrame:
    """log with collection_name of document events by the manifest and the log's own system events, each shard from where it sees them.

    dim is one manifest. The changes are few, a row per schema change and shard at most.
    """
    changes = log.where("kind = 'system_event'").select("manifest_uid", "sys_kind", "scope_id", "collection_id", F.col("key").cast("string").alias("name")).distinct()
    first = dim.agg(F.max("manifest_uid")).first()[0]
    x = decorate_versioned(log.drop("collection_name"), name_versions(dim, changes), first if first is not None else -1, "_before" if "_before" in log.columns else None)
    name = F.when(F.col("collection_id").isNull(), F.lit("_default")).otherwise(F.col("collection_name"))
    return x.withColumn("collection_name", F.when(F.col("kind").isin("mutation", "deletion", "expiration"), name)).drop("manifest_version")
