"""Checkpoint stores. A checkpoint is a dict: bucket_uuid, shard, branch, seqno, snap_start, snap_end, manifest_uid."""

from __future__ import annotations

import json
import os
import tempfile
from abc import ABC, abstractmethod

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidelog.errors import CheckpointStoreError

# The stored forms.
KEY_FORMAT = "_connector:cbgo:{group}:checkpoint:{shard}"
ATTRIBUTE = "cbgo"


def document_json() -> Column:
    """The stored document of a row (branch, seqno, snap_start, snap_end, bucket_uuid, manifest_uid); a null manifest is left out."""
    snap = F.struct(F.col("snap_start").alias("startSeqno"), F.col("snap_end").alias("endSeqno"))
    return F.to_json(F.struct(F.struct(snap.alias("snapshot"), F.col("branch").alias("vbuuid"), "seqno").alias("checkpoint"), F.col("bucket_uuid").alias("bucketUuid"), F.col("manifest_uid").alias("manifestUid")))


def to_document(c: dict) -> dict:
    d = {"checkpoint": {"snapshot": {"startSeqno": c["snap_start"], "endSeqno": c["snap_end"]}, "vbuuid": int(c["branch"]), "seqno": c["seqno"]}, "bucketUuid": c["bucket_uuid"]}
    if c.get("manifest_uid") is not None:
        d["manifestUid"] = c["manifest_uid"]
    return d


def from_document(shard: int, d: dict) -> dict:
    k = d["checkpoint"]
    return {
        "bucket_uuid": d["bucketUuid"], "shard": shard, "branch": int(k["vbuuid"]), "seqno": int(k["seqno"]), "snap_start": int(k["snapshot"]["startSeqno"]), "snap_end": int(k["snapshot"]["endSeqno"]), "manifest_uid": d.get("manifestUid"),
    }


class CheckpointStore(ABC):
    writes = True

    @abstractmethod
    def load(self, bucket_uuid: str, shards: list[int]) -> dict[int, dict]: ...

    @abstractmethod
    def save(self, checkpoints: list[dict]) -> None: ...

    @abstractmethod
    def clear(self, shards: list[int]) -> None: ...


def check_batch(checkpoints: list[dict]) -> None:
    if len({c["bucket_uuid"] for c in checkpoints}) > 1:
        raise CheckpointStoreError("checkpoints of several buckets")
    if len({c["shard"] for c in checkpoints}) != len(checkpoints):
        raise CheckpointStoreError("a shard has two checkpoints")


class NoopStore(CheckpointStore):
    writes = False

    def load(self, bucket_uuid, shards):
        return {}

    def save(self, checkpoints):
        check_batch(checkpoints)

    def clear(self, shards):
        pass


class ReadOnlyStore(CheckpointStore):
    writes = False

    def __init__(self, inner: CheckpointStore):
        self.inner = inner

    def load(self, bucket_uuid, shards):
        return self.inner.load(bucket_uuid, shards)

    def save(self, checkpoints):
        pass

    def clear(self, shards):
        pass


class FileStore(CheckpointStore):
    """One JSON file by shard, replaced atomically. At most 65536 entries; written by the driver after a batch's sink."""

    def __init__(self, path: str):
        self.path = path

    def _read(self) -> dict:
        try:
            with open(self.path, encoding="utf-8") as f:
                return {int(k): v for k, v in json.load(f).items()}
        except FileNotFoundError:
            return {}
        except (ValueError, AttributeError) as e:
            raise CheckpointStoreError(f"malformed checkpoint file: {e}") from e

    def _write(self, entries: dict) -> None:
        if not entries:
            if os.path.exists(self.path):
                os.remove(self.path)
            return
        folder = os.path.dirname(os.path.abspath(self.path))
        handle, tmp = tempfile.mkstemp(dir=folder)
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            json.dump({str(k): entries[k] for k in sorted(entries)}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(tmp, self.path)

    def load(self, bucket_uuid, shards):
        found = {s: from_document(s, d) for s, d in self._read().items() if s in set(shards)}
        if any(c["bucket_uuid"] != bucket_uuid for c in found.values()):
            raise CheckpointStoreError("checkpoints of another bucket")
        return found

    def save(self, checkpoints):
        check_batch(checkpoints)
        entries = self._read()
        if checkpoints and any(d["bucketUuid"] != checkpoints[0]["bucket_uuid"] for d in entries.values()):
            raise CheckpointStoreError("checkpoints of another bucket")
        entries.update({c["shard"]: to_document(c) for c in checkpoints})
        self._write(entries)

    def clear(self, shards):
        entries = self._read()
        self._write({k: v for k, v in entries.items() if k not in set(shards)})


class SharedFileStore(FileStore):
    """The same file anywhere that Spark can reach (a cluster's shared folder or an object store), through its file systems.

    A new file is written beside the old one and renamed over it, so a driver that is
    lost leaves a whole file.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(path)
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._at = self._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(conf)

    def _read(self) -> dict:
        if not self._fs.exists(self._at):
            return {}
        stream = self._fs.open(self._at)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return {int(k): v for k, v in json.loads(text).items()}
        except (ValueError, AttributeError) as e:
            raise CheckpointStoreError(f"malformed checkpoint file: {e}") from e

    def _write(self, entries: dict) -> None:
        if not entries:
            self._fs.delete(self._at, False)
            return
        beside = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}.new")
        stream = self._fs.create(beside, True)
        try:
            stream.write(bytearray(json.dumps({str(k): entries[k] for k in sorted(entries)}).encode()))
        finally:
            stream.close()
        self._fs.delete(self._at, False)
        if not self._fs.rename(beside, self._at):
            raise CheckpointStoreError(f"{self.path} could not be replaced")


class KeyedStore(CheckpointStore):
    """Checkpoints in any mapping by document key; all failures of a batch are reported together.

    With attribute, the checkpoint is an attribute of its document, whose other
    content stays as it is.
    """

    def __init__(self, documents: dict, group: str, attribute: bool = False):
        self.documents, self.group, self.attribute = documents, group, attribute

    def key(self, shard: int) -> str:
        return KEY_FORMAT.format(group=self.group, shard=shard)

    def load(self, bucket_uuid, shards):
        there = {s: json.loads(self.documents[self.key(s)]) for s in shards if self.key(s) in self.documents}
        if self.attribute:
            there = {s: d[ATTRIBUTE] for s, d in there.items() if ATTRIBUTE in d}
        found = {s: from_document(s, d) for s, d in there.items()}
        if any(c["bucket_uuid"] != bucket_uuid for c in found.values()):
            raise CheckpointStoreError("checkpoints of another bucket")
        return found

    def save(self, checkpoints):
        check_batch(checkpoints)
        failed = []
        for c in checkpoints:
            try:
                key, own = self.key(c["shard"]), to_document(c)
                if self.attribute:
                    own = json.loads(self.documents.get(key, "{}")) | {ATTRIBUTE: own}
                self.documents[key] = json.dumps(own)
            except Exception as e:  # noqa: BLE001 - gathered and raised below
                failed.append((c["shard"], e))
        if failed:
            raise CheckpointStoreError(f"not saved: {failed}")

    def clear(self, shards):
        for s in shards:
            self.documents.pop(self.key(s), None)


def load_checked(store: CheckpointStore, bucket_uuid: str, shards: list[int]) -> dict[int, dict]:
    """Loads and checks that the store gives only what was asked for."""
    if not bucket_uuid:
        raise CheckpointStoreError("no bucket uuid")
    if len(set(shards)) != len(shards):
        raise CheckpointStoreError("a shard is asked for twice")
    found = store.load(bucket_uuid, shards)
    for s, c in found.items():
        if s not in set(shards) or c["shard"] != s or c["bucket_uuid"] != bucket_uuid:
            raise CheckpointStoreError(f"shard {s}: not the checkpoint asked for")
    return found


#: A stored document as Spark reads it.
DOCUMENT = "checkpoint struct<snapshot:struct<startSeqno:bigint,endSeqno:bigint>,vbuuid:decimal(20,0),seqno:bigint>, bucketUuid string, manifestUid bigint"


def identities(stored: DataFrame, bucket_uuid: str, asked: DataFrame) -> DataFrame:
    """shard, seqno, problem of stored documents (shard, json) for the shards that are asked for (shard), as load_checked has them.

    A document of another bucket, an unreadable one and one that was not asked for
    are problems; a shard without a document is none. asked has at most 65536 rows.
    """
    x = stored.select("shard", F.from_json("json", DOCUMENT).alias("d")).join(F.broadcast(asked.select("shard", F.lit(True).alias("_asked"))), "shard", "left")
    problem = F.when(F.col("_asked").isNull(), "not asked for").when(F.col("d.checkpoint.seqno").isNull(), "unreadable").when(~F.col("d.bucketUuid").eqNullSafe(bucket_uuid), "another bucket")
    return x.select("shard", F.col("d.checkpoint.seqno").alias("seqno"), problem.alias("problem"))
