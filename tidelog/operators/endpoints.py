"""Endpoints of a topology document: hosts and ports by network and transport, and which network a client is in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SERVICES = "struct<kv:int,kvSSL:int>"
_NODES = f"array<struct<nodeUUID:string,hostname:string,serverGroup:string,services:{_SERVICES},alternateAddresses:map<string,struct<hostname:string,ports:{_SERVICES}>>>>"
DOCUMENT = f"nodesExt {_NODES}, vBucketServerMap struct<serverList:array<string>>"


def split_endpoint(address: Column) -> Column:
    """host and port of `name:port` or `[v6]:port`; null if it is neither."""
    host = F.coalesce(F.nullif(F.regexp_extract(address, r"^\[([^\]]+)\]:[0-9]+$", 1), F.lit("")), F.nullif(F.regexp_extract(address, r"^([^:\[\]]+):[0-9]+$", 1), F.lit("")))
    port = F.try_to_number(F.regexp_extract(address, r":([0-9]{1,5})$", 1), F.lit("99999")).cast("int")
    return F.when(host.isNotNull() & port.between(1, 65535), F.struct(host.alias("host"), port.alias("port")))


def format_endpoint(host: Column, port: Column) -> Column:
    """`host:port`, v6 hosts in brackets; null for an empty host or one with white space."""
    bare = F.regexp_replace(host, r"^\[(.*)\]$", "$1")
    return F.when((bare != "") & ~bare.rlike(r"\s"), F.concat(F.when(bare.contains(":"), F.concat(F.lit("["), bare, F.lit("]"))).otherwise(bare), F.lit(":"), port.cast("string")))


def _is_data(node: Column) -> Column:
    return (F.coalesce(node["services"]["kv"], F.lit(0)) != 0) | (F.coalesce(node["services"]["kvSSL"], F.lit(0)) != 0)


def own_address(node: Column, source_host: Column, tls: Column) -> Column:
    """A node's address in the default network; one without a host name is at the source's host. Null without a port."""
    port = F.when(tls, node["services"]["kvSSL"]).otherwise(node["services"]["kv"])
    return F.when(port > 0, format_endpoint(F.coalesce(F.nullif(node["hostname"], F.lit("")), source_host), port))


def network_of(data: Column, servers: Column, source: Column, source_host: Column, tls: Column) -> Column:
    """The network of a client that came by `source`: default if a data node is there under its own address, external if all have such an address, else default."""
    first = F.slice(data, 1, F.greatest(F.size(servers), F.lit(1)))
    inside = F.exists(first, lambda n: F.coalesce(F.lower(own_address(n, source_host, tls)) == F.lower(source), F.lit(False)))
    outside = (F.size(data) >= F.size(servers)) & F.forall(first, lambda n: F.coalesce(F.map_contains_key(n["alternateAddresses"], F.lit("external")), F.lit(False)))
    return F.when((F.size(data) > 0) & ~inside & outside, "external").otherwise("default")


def endpoints(docs: DataFrame) -> DataFrame:
    """network, server (place in the server list), node, address, canonical, server_group, problem beside the columns of docs.

    docs: json, requested (auto, default, external or a name), tls, source (host:port by
    which the document came). Data nodes and servers belong together by their order;
    other nodes don't count. A node is named by its uuid, else by its server's address.
    A document that can't be used is one row with its problem.
    """
    x = docs.withColumn("_d", F.from_json("json", DOCUMENT))
    nodes = F.coalesce(F.col("_d.nodesExt"), F.array().cast(_NODES))
    x = x.withColumns({"_nodes": nodes, "_servers": F.coalesce(F.col("_d.vBucketServerMap.serverList"), F.array().cast("array<string>"))})
    x = x.withColumns({"_data": F.filter("_nodes", _is_data), "_s": split_endpoint(F.col("source"))})
    x = x.withColumns({"_host": F.col("_s.host"), "_source": format_endpoint(F.col("_s.host"), F.col("_s.port"))})
    auto = network_of(F.col("_data"), F.col("_servers"), F.col("_source"), F.col("_host"), F.col("tls"))
    x = x.withColumn("network", F.when(F.col("requested") == "auto", auto).otherwise(F.col("requested")))
    bare = F.size("_nodes") == 0
    wrong = (
        F.when(F.trim("requested").isin("") | F.col("requested").rlike(r"\s"), "bad network name").when(F.size("_servers") == 0, "no servers").when(bare & F.col("tls"), "tls needs nodes")
        .when(bare & (F.col("network") != "default"), "the network needs nodes").when(~bare & (F.size("_data") < F.size("_servers")), "fewer data nodes than servers")
    )
    kept = [c for c in docs.columns if c != "json"]
    x = x.withColumn("_wrong", wrong)
    x = x.select("*", F.posexplode(F.when(F.col("_wrong").isNull(), F.col("_servers")).otherwise(F.array(F.lit(None).cast("string")))).alias("server", "_legacy"))
    default = F.col("network") == "default"
    x = x.withColumns({"_node": F.get("_data", F.col("server")), "_l": split_endpoint(F.col("_legacy"))})
    x = x.withColumns({"_other": F.get(F.map_values(F.map_filter("_node.alternateAddresses", lambda k, _: k == F.col("network"))), F.lit(0)), "_main": own_address(F.col("_node"), F.col("_host"), F.col("tls")), "_l": format_endpoint(F.col("_l.host"), F.col("_l.port"))})
    ports = F.when(F.col("_other.ports").isNull(), F.col("_node.services")).otherwise(F.col("_other.ports"))
    x = x.withColumn("_port", F.when(F.col("tls"), ports["kvSSL"]).otherwise(ports["kv"]))
    outer = F.when(F.col("_port") > 0, format_endpoint(F.coalesce(F.nullif(F.col("_other.hostname"), F.lit("")), F.col("_host")), F.col("_port")))
    x = x.withColumn("_there", F.when(default, F.col("_main")).otherwise(F.when(F.col("_other").isNotNull(), outer)))
    named = F.trim(F.coalesce(F.col("_node.nodeUUID"), F.lit(""))) != ""
    x = x.withColumn("_name", F.when(named, F.col("_node.nodeUUID")).otherwise(F.col("_l")))
    own_port = F.coalesce(F.when(F.col("tls"), F.col("_node.services.kvSSL")).otherwise(F.col("_node.services.kv")), F.lit(0))
    no_port = F.when(F.col("tls"), "no kvSSL port").otherwise("no kv port")
    of_node = (
        F.when(own_port == 0, no_port).when(F.col("_main").isNull(), "bad host name").when(~default & F.col("_other").isNull(), "no address in the network")
        .when(~default & (F.coalesce("_port", F.lit(0)) == 0), no_port).when(F.col("_there").isNull(), "bad host name").when(F.col("_name").isNull(), "bad server address")
    )
    problem = F.coalesce(F.col("_wrong"), F.when(F.col("_node").isNull(), F.when(F.col("_l").isNull(), "bad server address")).otherwise(of_node))
    x = x.withColumn("problem", problem)
    good = F.col("problem").isNull()
    return x.select(
        *kept, "network", "server", F.when(good, F.col("_name")).alias("node"), F.when(good, F.coalesce("_there", "_l")).alias("address"), F.when(good, F.coalesce("_main", "_l")).alias("canonical"),
        F.when(good, F.nullif(F.col("_node.serverGroup"), F.lit(""))).alias("server_group"), "problem",
    )
