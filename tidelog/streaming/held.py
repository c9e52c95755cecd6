"""Tables that a stream carries from one micro-batch to the next, in a folder that all executors share."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.errors import InvalidConfiguration
from tidelog.operators import order

#: What the stages after the order check add; it is made anew when a held row comes again.
_MADE = ("delivered", "acked", "checkpoint_manifest", "collection_name", "_before")


def shared_dir(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, which all executors share; a temporary one on a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise InvalidConfiguration("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
    return f"{found.rstrip('/')}/{uuid.uuid4().hex}"


class Versions:
    """Versions epoch-turn of a table: each micro-batch (or drain) reads the last one and writes the next.

    A micro-batch that is repeated after a failure reads what it read before, as
    versions of its own epoch are written over. Of earlier epochs the last version is
    kept, which is all that a repetition can ask for.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str | None = None):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _path(self, name: str = ""):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def numbers(self) -> list[tuple[int, int]]:
        fs, path = self._path()
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(tuple(map(int, n.split("-"))) for n in names if fs.exists(self._path(f"{n}/_SUCCESS")[1]))

    def before(self, epoch: int) -> DataFrame | None:
        """The last version of an earlier epoch (-1: of any)."""
        found = [v for v in self.numbers() if epoch < 0 or v[0] < epoch]
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet("{}/{}-{}".format(self.folder, *found[-1])) if found else None

    def write(self, rows: DataFrame, epoch: int, *by: str) -> str:
        """Gives the version's folder, with folders by the columns `by` in it."""
        found = self.numbers()
        at = (epoch, 0) if epoch >= 0 else (found[-1][0], found[-1][1] + 1) if found else (0, 0)
        made = "{}/{}-{}".format(self.folder, *at)
        rows.write.mode("overwrite").partitionBy(*by).parquet(made)
        for old in [v for v in found if v[0] < at[0]][:-1] + [v for v in found if v[0] == at[0] and v[1] < at[1] - 1]:
            fs, path = self._path("{}-{}".format(*old))
            fs.delete(path, True)
        return made


class HeldRows:
    """Rows that the persistence gate holds, each with the time since when."""

    def __init__(self, spark: SparkSession, folder: str):
        self.versions = Versions(spark, folder)

    def with_new(self, new: DataFrame | None, epoch: int) -> DataFrame | None:
        """The rows held before the epoch (-1: by the last version) and the new ones, with `_since` (seconds)."""
        old = self.versions.before(epoch)
        new = None if new is None else new.withColumn("_since", F.lit(time.time()))
        return new if old is None else old if new is None else new.unionByName(old, allowMissingColumns=True)

    def keep(self, rows: DataFrame, epoch: int) -> None:
        self.versions.write(rows.drop(*_MADE), epoch)


class CarriedOrder:
    """The order check over micro-batches: what each shard's rows left behind is a row per shard, at most 65536.

    Within a micro-batch it is the window form: Spark sorts a shard by arrival and can
    spill, so memory does not grow with a shard's share of it.
    """

    SEEDS = "shard int, c_start bigint, c_end bigint, c_last bigint, c_stopped boolean"

    def __init__(self, spark: SparkSession, folder: str, starts: DataFrame | None, opened: DataFrame | None = None):
        self.spark, self.versions, self.starts, self.opened = spark, Versions(spark, folder), starts, opened

    def _seeds(self, epoch: int) -> DataFrame:
        found = self.versions.before(epoch)
        return self.spark.createDataFrame([], self.SEEDS) if found is None else found

    def labelled(self, new: DataFrame, epoch: int) -> DataFrame:
        """new with the snapshot attached, violation and unreached; rows that are not of their shard's open stream are violations."""
        if self.opened is None:
            return self._ordered(new, epoch)
        x = self._ordered(order.fence(new, self.opened), epoch)
        stopped = F.col("unreached") & F.col("fenced").isNull()  # by what came before
        x = order.stop_after(x.withColumns({"_was": stopped, "violation": F.coalesce("fenced", "violation")}))
        return x.withColumn("unreached", F.col("unreached") | F.col("_was")).drop("fenced", "_was")

    def _ordered(self, new: DataFrame, epoch: int) -> DataFrame:
        x = new.join(F.broadcast(self._seeds(epoch)), "shard", "left")
        if self.starts is not None:
            x = x.join(F.broadcast(self.starts.select("shard", F.col("start_seqno").alias("_start"), F.col("end_seqno").alias("_stop"))), "shard", "left")
            return order.check_order(x, "_start", "_stop", carried=True).drop("_start", "_stop")
        return order.check_order(x, carried=True)

    def keep(self, labelled: DataFrame, epoch: int) -> None:
        """The seeds after the epoch. labelled: with the columns of SEEDS dropped."""
        marker = F.when(F.col("kind") == "snapshot_marker", F.struct("snap_start", "snap_end"))
        stops = F.col("violation").isNotNull() | (F.col("kind") == "stream_end")
        now = labelled.groupBy("shard").agg(F.max_by(marker, F.when(marker.isNotNull(), F.col("arrival"))).alias("m"), F.max("seqno").alias("last"), F.max(stops).alias("stops"))
        x = self._seeds(epoch).join(now, "shard", "full_outer")
        after = x.select(
            "shard", F.when(F.col("m").isNotNull(), F.col("m.snap_start")).otherwise(F.col("c_start")).alias("c_start"), F.when(F.col("m").isNotNull(), F.col("m.snap_end")).otherwise(F.col("c_end")).alias("c_end"),
            F.greatest("c_last", "last").alias("c_last"), (F.coalesce("c_stopped", F.lit(False)) | F.coalesce("stops", F.lit(False))).alias("c_stopped"),
        )
        self.versions.write(after.coalesce(1), epoch)
