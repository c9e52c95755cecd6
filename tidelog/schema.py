"""Schemas of the change log and of what goes with it.

seqno and cas are unsigned 64-bit in the source; cas and branch ids use
decimal(20,0), seqno uses bigint (larger ones are quarantined on decoding).
"""

from __future__ import annotations

EVENTS = """
kind string, shard int, stream_id int, opaque bigint, arrival bigint,
seqno bigint, rev_seqno bigint, cas decimal(20,0),
flags bigint, expiry bigint, lock_time bigint, delete_time bigint,
datatype smallint, collection_id bigint, collection_name string, key binary, value binary,
snap_start bigint, snap_end bigint, snap_flags bigint, max_visible_seqno bigint, high_completed_seqno bigint, purge_seqno bigint, snap_timestamp bigint,
end_reason string, end_reason_code bigint,
sys_kind string, sys_code bigint, sys_version smallint, manifest_uid bigint, scope_id bigint, max_ttl bigint, sys_data binary,
oso_state string, connection_generation bigint, assignment_generation bigint, wire_size int
"""
CHECKPOINTS = "bucket_uuid string, shard int, branch decimal(20,0), seqno bigint, snap_start bigint, snap_end bigint, manifest_uid bigint"
FAILOVER = "shard int, pos int, branch decimal(20,0), seqno bigint"
OBSERVATIONS = "cycle bigint, shard int, node string, ok boolean, did_failover boolean, obs_shard int, branch decimal(20,0), persisted bigint, current bigint"

#: Kinds of event that carry a document, and those that carry a seqno.
DOCUMENTS = ("mutation", "deletion", "expiration")
KINDS = (*DOCUMENTS, "snapshot_marker", "stream_end", "seqno_advanced", "system_event", "oso_snapshot")
WITHOUT_SEQNO = ("snapshot_marker", "stream_end", "oso_snapshot")

# Bits of the wire format.
DATATYPE_BITS = {"json": 1, "snappy": 2, "xattr": 4}
SNAPSHOT_BITS = {"memory": 1, "disk": 2, "checkpoint": 4, "ack": 8, "history": 16, "may_contain_duplicates": 32}
