"""Mixing sources to target weights by hash-random keys and distributed prefix sums.

Every document gets a hash-random key. Keys are uniform, so equal ranges of the
key (its leading hex digits) are equal shares of a source: two levels of range
sums give each range's offset within its source, and a running sum inside a
range gives each document's position. A source's budget is then cut at the exact
word; budgets above the source's size repeat it in whole epochs first.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm._common import materialise, packed
from llm._text import WORD

WEIGHTS = (5, 2, 1)
#: The mix has MASS[0] / MASS[1] of all words.
MASS = (3, 2)
#: No source is repeated more often than this.
MOST_EPOCHS = 2
SEED = "mix-1"
#: Documents in a key range, all sources together; ranges only spread the work, results don't depend on them.
RANGE_ROWS = 1000
#: Rows made at once of those that are equal in id, source and size.
CHUNK = 10_000


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, s_null, s (the source), size in words, key."""
    return documents.select(
        "doc_id",
        F.col("source").isNull().alias("s_null"),
        F.coalesce("source", F.lit("")).alias("s"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _key().alias("key"),
    )


def _key():
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED)).cast("binary"))


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: source_size, target, budget (whole words), epochs, rest.

    Targets share the mass by weight; what exceeds a source's cap is reshared
    by weight. Ordered by cap per weight, the sources that fill up come first:
    the level is fixed by the first source that its share does not fill.
    This table has a row per source, so its windows are small.
    """
    by_source = sized.groupBy("s_null", "s").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("s_null", "s"))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    x = by_source.select("*", rank.alias("rank"), F.sum("source_size").over(Window.partitionBy()).alias("total"))
    x = x.select("*", F.element_at(weights, F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))) + 1).cast("long").alias("w"), (F.lit(MOST_EPOCHS) * F.col("source_size")).alias("cap"))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    x = x.select(
        "*",
        F.row_number().over(fill).alias("at"),
        F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("filled"),
        F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)).alias("w_left"),
    )
    x = x.select("*", (F.lit(MASS[0]) * F.col("total") - F.lit(MASS[1]) * F.col("filled")).alias("left"))
    level = F.min(F.when(F.col("left") * F.col("w") <= F.lit(MASS[1]) * F.col("cap") * F.col("w_left"), F.struct("at", "left", "w_left"))).over(Window.partitionBy())
    x = x.select("*", level.alias("level"))
    target = F.when(
        F.col("level").isNull() | (F.col("at") < F.col("level.at")), F.col("cap").cast("double")
    ).otherwise((F.col("level.left") * F.col("w")).cast("double") / (F.lit(MASS[1]) * F.col("level.w_left")).cast("double"))
    x = x.select("s_null", "s", "source_size", target.alias("target")).withColumn("budget", F.floor("target"))
    safe = F.greatest("source_size", F.lit(1))
    return x.select("*", F.floor(F.col("budget") / safe).cast("long").alias("epochs")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))


def positions(sized: DataFrame, of_source: DataFrame) -> DataFrame:
    """A row per distinct (source, key, doc_id, size) with its source's row, `times` and `before`: words of its source with smaller keys.

    Rows equal in all of that are one here, so very many of one id are no hot spot;
    the i-th of them begins at before + i * size.
    """
    digits = max(2, math.ceil(math.log(max(sized.count(), 1) / RANGE_ROWS + 1, 16)))
    x = sized.groupBy("s_null", "s", "key", "doc_id", "size").agg(F.count("*").alias("times")).withColumn("range", F.substring("key", 1, digits))
    x = x.withColumn("words", F.col("size") * F.col("times"))
    sums = x.groupBy("s_null", "s", "range").agg(F.sum("words").alias("words")).withColumn("block", F.substring("range", 1, digits // 2))
    earlier = (Window.unboundedPreceding, -1)
    blocks = sums.groupBy("s_null", "s", "block").agg(F.sum("words").alias("words"))
    in_source = Window.partitionBy("s_null", "s").orderBy("block").rowsBetween(*earlier)
    blocks = blocks.select("s_null", "s", "block", F.coalesce(F.sum("words").over(in_source), F.lit(0)).alias("block_at"))
    in_block = Window.partitionBy("s_null", "s", "block").orderBy("range").rowsBetween(*earlier)
    sums = sums.select("s_null", "s", "block", "range", F.coalesce(F.sum("words").over(in_block), F.lit(0)).alias("range_at"))
    offsets = sums.join(blocks, ["s_null", "s", "block"]).join(of_source, ["s_null", "s"]).withColumn("offset", F.col("block_at") + F.col("range_at")).drop("block", "block_at", "range_at")
    in_range = Window.partitionBy("s_null", "s", "range").orderBy("key", "doc_id", "size").rowsBetween(*earlier)
    x = x.select("*", F.coalesce(F.sum("words").over(in_range), F.lit(0)).alias("inside")).drop("words")
    return x.join(offsets, ["s_null", "s", "range"]).withColumn("before", F.col("offset") + F.col("inside")).drop("offset", "inside", "range")


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: words the mix takes of each document.

    A null source is a source of its own, after all others; null and empty texts
    have size 0 and give nothing. Repeated rows count each by itself, rows with null
    ids too. An empty table gives no rows; other columns are ignored. The document
    at a cut gives only the words up to it; equal keys go by doc_id, then size.
    """
    sized = materialise(sizes(documents), "mix-sizes")
    at = positions(sized, targets(sized))
    at = at.withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("times") - 1, F.lit(CHUNK)))).withColumn("_i", F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK, F.col("times")) - 1)))
    at = at.withColumn("before", F.col("before") + F.col("_i") * F.col("size"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return at.select(
        "doc_id", F.when(~F.col("s_null"), F.col("s")).alias("source"), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + last).cast("long").alias("taken"),
    )


def repeat(documents: DataFrame) -> DataFrame:
    """The mixed corpus itself: documents' columns, a row for each time that the mix takes the document.

    Documents stay whole here: one at a cut is taken if at least half of it lies
    before the cut. The cut is a key per source, so texts are not shuffled. Null
    sources are one source; rows equal in id and size are taken together; texts
    without words are taken as often as their neighbours by key. An empty table
    gives no rows; names of other columns cannot clash.
    """
    sized = materialise(sizes(documents), "mix-sizes")
    at = positions(sized, targets(sized))
    inside = F.col("before") + F.col("size") * F.col("times") / 2 <= F.col("rest")
    cuts = at.groupBy("s_null", "s").agg(F.min("epochs").alias("epochs"), F.max(F.when(inside, F.struct("key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "size"))).alias("cut"))
    cuts = materialise(cuts, "mix-cuts")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    own = F.struct(_key().alias("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), words.alias("size"))
    x = packed(documents, s_null=F.col("source").isNull(), s=F.coalesce("source", F.lit("")), own=own)
    times = F.col("epochs") + F.when(F.col("own") <= F.col("cut"), 1).otherwise(0)
    x = x.join(cuts, ["s_null", "s"]).select("_row", times.cast("int").alias("_times")).where("_times > 0")
    return x.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_time")).select("_row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS s_null, coalesce(source, '') AS s, md5(coalesce(doc_id::VARCHAR, '') || ':mix-1') AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
src AS (SELECT s_null, s, sum(size)::BIGINT AS source_size FROM d GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY s_null, s) AS rank, sum(source_size) OVER () AS total FROM src),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap FROM r),
f AS (SELECT *, row_number() OVER o AS pos,
        coalesce(sum(cap) OVER (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
        sum(w) OVER (ORDER BY cap / w, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
      FROM w WINDOW o AS (ORDER BY cap / w, rank)),
lev AS (SELECT pos AS l_at, 3 * total - 2 * filled AS l_left, w_left AS l_w FROM f
        WHERE (3 * total - 2 * filled) * w <= 2 * cap * w_left ORDER BY pos LIMIT 1),
t AS (SELECT s_null, s, source_size, CASE WHEN l_at IS NULL OR pos < l_at THEN cap::DOUBLE
        ELSE (l_left * w)::DOUBLE / (2 * l_w)::DOUBLE END AS target
      FROM f LEFT JOIN lev ON true),
b AS (SELECT *, floor(target)::BIGINT AS budget FROM t),
e AS (SELECT *, budget // greatest(source_size, 1) AS epochs, budget - budget // greatest(source_size, 1) * source_size AS rest FROM b),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.s_null, d.s ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e USING (s_null, s))
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p
"""
