"""Exact deduplication by deterministic block naming.

A text without white space is cut into blocks of fixed length. The distinct
blocks are sorted and numbered: the number is the block's name. Adjacent names
are then paired and the distinct pairs numbered again, level by level, until one
number is left. Names come from comparing the blocks themselves, so two
documents share their last name exactly if their texts are equal.

Blocks are found again by a digest that is first checked to belong to one block
only; blocks whose digest is shared are looked up by their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm._common import forget, hot_join, materialise, one_of_each

#: Characters in a block.
BLOCK = 4096
_SPACE = r"[\x20\x09-\x0D]+"


def _normal():
    return F.regexp_replace(F.coalesce("text", F.lit("")), _SPACE, "")


def _named(keys: DataFrame, by: list[str], label: str, scratch: list[str], **more: Column) -> DataFrame:
    """Distinct keys, how often each is there, and its number in sorted order: hash partitions, sorted, one after the other."""
    counted = keys.groupBy(*by).agg(F.count("*").alias("times")).withColumns(more)
    return materialise(counted.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id()), label, scratch)


def _sha256(block: Column) -> Column:
    return F.sha2(block, 256)


def identities(documents: DataFrame, block: int = BLOCK, digest: Callable[[Column], Column] = _sha256, scratch: list[str] | None = None) -> DataFrame:
    """Per row: rid, doc_id, n_points (code points of the text), text_sha256 (of the normalised text), level, name.

    level and name together are the identity of the normalised text. rid tells
    repeated rows apart. Null texts count as empty; an empty text is one empty block.
    Blocks, pairs and documents that are very frequent are joined with their names
    by a broadcast of the few hot ones.
    """
    scratch = [] if scratch is None else scratch
    text = documents.select("doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_points"), _normal().alias("_t"))
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.length("_t"), F.lit(1)), F.lit(block)), lambda i: F.substring("_t", i, F.lit(block)))
    names = _named(text.select(F.explode(parts).alias("block")), ["block"], "dedup-names", scratch, digest=digest(F.col("block")))
    unique = names.groupBy("digest").count().where("count > 1").isEmpty()  # else the blocks themselves are looked up
    names = names.select(F.col("digest" if unique else "block").alias("part"), "name", "times")
    rows = text.select("doc_id", "n_points", F.sha2("_t", 256).alias("text_sha256"), (F.transform(parts, digest) if unique else parts).alias("parts"))
    rows = materialise(rows.withColumn("rid", F.monotonically_increasing_id()), "dedup-rows", scratch)
    facts = rows.select("rid", F.size("parts").alias("n"), F.posexplode("parts").alias("pos", "part"))
    facts = materialise(hot_join(facts, names, ["part"], "times").select("rid", "n", "pos", "name"), "dedup-level", scratch)
    level, done = 0, facts.where("n = 1").select("rid", F.lit(0).alias("level"), "name")
    while True:
        open_ = facts.where("n > 1")
        if open_.isEmpty():
            break
        level += 1
        pairs = open_.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("at"), F.ceil(F.col("n") / 2).cast("int").alias("n")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")
        )
        pairs = materialise(pairs, "dedup-pairs", scratch)
        names = _named(pairs.select("left", "right"), ["left", "right"], "dedup-pair-names", scratch)
        facts = materialise(hot_join(pairs, names, ["left", "right"], "times").select("rid", "n", F.col("at").alias("pos"), "name"), "dedup-level", scratch)
        done = done.union(facts.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
    return rows.drop("parts").join(done, "rid")


def dedup(documents: DataFrame, block: int = BLOCK, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """Per row: rid, doc_id, n_points, text_sha256, keep_id, group_size, kept.

    Of equal texts (white space apart) the row with the most code points stays,
    then the smallest doc_id (null last), then one of the repeated rows. Null texts
    are empty ones. An empty table gives no rows; other columns are ignored.
    """
    scratch: list[str] = []
    named = materialise(identities(documents, block, digest, scratch), "dedup-identities")
    forget(documents.sparkSession, scratch)
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("null"), "doc_id", "rid"))
    groups = materialise(named.groupBy("level", "name").agg(F.count("*").alias("group_size"), best.alias("best")), "dedup-groups")
    return hot_join(named, groups, ["level", "name"], "group_size").select(
        "rid", "doc_id", "n_points", "text_sha256", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept")
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """documents without the rows that dedup drops, all columns as they are.

    So one row of each group of equal texts stays, null and empty ones being one
    group; ties and repeats as in dedup. An empty table gives no rows; names of
    other columns cannot clash.
    """
    judged = materialise(dedup(documents), "dedup-judged")
    key = {"doc_id": F.col("doc_id"), "n_points": F.length(F.coalesce("text", F.lit(""))).cast("long"), "text_sha256": F.sha2(_normal(), 256)}
    return one_of_each(documents, key, judged.groupBy(*key).agg(F.max("kept").alias("stays"), F.count("*").alias("rows")))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS p, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY p DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY p DESC, doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
