"""Shared helpers: reading tables, materialising intermediate results, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow table (ids, digests) that may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000
#: Bytes that may be broadcast, about.
BROADCAST_BYTES = 64 << 20
#: A key is hot if it holds more than one row in so many; so there are fewer hot keys than this.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a temporary one on a local master (tests); a cluster must name it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """Keeps what a Python worker gets at once to a few MB, however long the texts are: workers are reused and keep their peak."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(2000, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def materialise(df: DataFrame, label: str, scratch: list[str] | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there and lost executors lose nothing.

    The folder's path is added to scratch, for forget() once nothing reads it any more.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, scratch: list[str]) -> None:
    """Deletes intermediate folders whose readers have all been written; the list is emptied."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while scratch:
        path = jvm.org.apache.hadoop.fs.Path(scratch.pop())
        path.getFileSystem(conf).delete(path, True)


def packed(df: DataFrame, **keys) -> DataFrame:
    """df's rows as one struct `_row` beside key columns, so that no name of df can clash; select("_row.*") unpacks."""
    return df.select(F.struct("*").alias("_row"), *[c.alias(k) for k, c in keys.items()])


def checked_broadcast(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a materialised narrow table for broadcast if it has at most `most` rows; else Spark shuffles it."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


def _width(df: DataFrame):
    """Bytes of a row, about: its strings and eight for every other column."""
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    out = F.lit(8 * (len(df.columns) - len(strings)))
    for c in strings:
        out = out + F.coalesce(F.octet_length(c), F.lit(0))
    return out.cast("long")


def hot_join(rows: DataFrame, groups: DataFrame, on: list[str], size: str, how: str = "inner", most: int | None = None, total: int | None = None) -> DataFrame:
    """Join of rows with groups (materialised, one row per key, no arrays), where `size` is a key's number of rows; how: inner or left.

    Groups of few rows in all (`most`) and few bytes are broadcast. Else the hot ones
    are, of which there are fewer than HOT_KEYS, so that their rows stay where they
    are; all others, and the few hot ones with very long strings, are shuffled as
    usual. total: a bound of the sum of sizes, where it is known and rows are narrow.
    The columns are those of rows.join(groups, on, how).
    """
    most = BROADCAST_ROWS if most is None else most
    if total is not None and total <= most:
        return rows.join(F.broadcast(groups), on, how)
    width = _width(groups)
    total, length = groups.agg(F.sum(size), F.sum(width)).first()
    if (total or 0) <= most and (length or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(groups), on, how)
    is_hot = (F.col(size) * HOT_KEYS > total) & (width <= BROADCAST_BYTES // HOT_KEYS)
    hot = groups.where(is_hot)
    few = rows.join(F.broadcast(hot), on)
    return few.unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups.where(~is_hot), on, how))


def dealt_join(rows: DataFrame, groups: DataFrame, on: str, by: str, most: int = 2000) -> DataFrame:
    """Inner join of rows (materialised) with wide groups (one row per key), where a key may hold very many rows.

    A key with more than `most` rows and more than one in HOT_KEYS is dealt over
    several parts by a hash of `by`, and its group copied to each: the rows of one
    part stay few, and only the names of the hot keys (fewer than HOT_KEYS) are
    broadcast. The columns are those of rows.join(groups, on).
    """
    sizes = rows.groupBy(on).agg(F.count("*").alias("_n"))
    floor = max(most, rows.count() // HOT_KEYS)
    hot = F.broadcast(sizes.where(F.col("_n") > floor).select(on, F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    left = rows.join(hot, on, "left").withColumn("_part", F.pmod(F.xxhash64(by), parts).cast("int")).drop("_parts")
    right = groups.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))).drop("_parts")
    return left.join(right, [on, "_part"]).drop("_part")


def one_of_each(rows: DataFrame, key: dict, judged: DataFrame) -> DataFrame:
    """rows without those whose key does not stay; of rows that repeat a key one stays. All columns as they are.

    judged: a row per key with `stays` and `rows` (how many there are). Only keys
    that go or repeat are joined. Repeats are met by an aggregation that combines
    before the shuffle, so that very many of one key are no hot spot; of repeats
    with different other columns the least row stays (maps don't count).
    """
    names = list(key)
    odd = materialise(judged.where("NOT stays OR rows > 1").select(*[F.col(k).alias(f"_{k}") for k in names], "stays", "rows"), "odd-keys")
    x = packed(rows, **key)
    on = F.lit(True)
    for k in names:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    n, total = odd.agg(F.count("*"), F.sum("rows")).first()
    if n <= BROADCAST_ROWS:
        hot, rest = F.broadcast(odd), odd.limit(0)
    else:  # keys of very many rows are broadcast, so that these stay where they are
        is_hot = F.col("rows") * HOT_KEYS > total
        hot, rest = F.broadcast(odd.where(is_hot)), odd.where(~is_hot)
    cold = x.join(hot, on, "left_anti")
    out = (cold if n <= BROADCAST_ROWS else cold.join(rest, on, "left_anti")).select("_row.*")
    twice = F.expr("stays AND rows > 1")
    if odd.where(twice).isEmpty():
        return out
    plain = [f.name for f in rows.schema.fields if not f.dataType.simpleString().startswith(("map", "variant")) and "map<" not in f.dataType.simpleString()]
    least = F.min_by("_row", F.struct(*[F.col("_row").getField(c) for c in plain]))
    again = x.join(hot.where(twice), on, "left_semi")
    if n > BROADCAST_ROWS:
        again = again.union(cold.join(rest.where(twice), on, "left_semi"))
    one = again.groupBy(*names).agg(least.alias("_row"))
    return out.unionByName(one.select("_row.*"))


def lower_ascii(col):
    """A-Z lower-cased, all else as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo folds; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
