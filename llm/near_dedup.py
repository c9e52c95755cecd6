"""Near-duplicate detection by fast similarity sketching, banding and exact verification.

Sketch: in rounds, every shingle of a document is hashed to a bin and a value;
a bin keeps the least (round, value). Rounds go on while bins are empty; after
as many rounds as there are bins, round k fills bin k, so every coordinate is
filled, and agreement of coordinates estimates the similarity with
concentration bounds.

Documents with equal shingle sets form one class; only one document of each
class goes on. Classes that agree on a whole band of coordinates meet in a
bucket. A bucket does not emit its pairs: first all its members are compared
with one of them, and verified links join components. Where members of a bucket
are still in different components, small buckets compare the pairs left; large
ones that overlap form a cluster. Members of a cluster's largest component need no
comparison with each other: they are dealt into blocks of bounded size, and the
others, in blocks of their own, meet each of these and each other. A task compares
two blocks and gives links that join components, at most one per member. So no link
between components is missed, and large groups make few rows.

Classes are told apart by numbers of their own, so ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from llm._common import bounded_batches, checked_broadcast, dealt_join, forget, hot_join, materialise, one_of_each
from llm._graph import components
from llm._text import mix64, shingle_sets, slices

#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80
WIDTH = 5
#: Coordinates of a sketch, coordinates in a band at most, and the chance that a pair at the threshold meets in no band: 3e-6 at 80.
COORDINATES, BAND, MISSED = 96, 4, 4e-6
#: Buckets with more members left than this go to clusters.
SMALL = 8
#: Bytes of shingle sets in a block of a cluster, about.
BLOCK_BYTES = 512 << 10
#: Characters of text sketched together, about.
SLICE_BYTES = 2 << 20
#: Pairs whose sketches agree on fewer coordinates than so many standard deviations below the threshold are not verified.
DEVIATIONS = 5

_NONE = np.iinfo(np.uint64).max


def sketches(hashes: np.ndarray, bounds: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """A row of t filled coordinates per non-empty set; rows of empty sets stay unfilled."""
    n = len(bounds) - 1
    out = np.full((n, t), _NONE, np.uint64)
    flat, who, x = out.reshape(-1), np.repeat(np.arange(n), np.diff(bounds)), hashes
    for i in range(2 * t):
        h = mix64(x + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        at = ((h >> np.uint64(32)) % np.uint64(t)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, who * t + at, (np.uint64(i) << np.uint64(48)) | (mix64(h) >> np.uint64(16)))
        keep = (out == _NONE).any(1)[who]
        if not keep.any():
            break
        who, x = who[keep], x[keep]
    return out


def least_agreeing(percent: int) -> int:
    """Coordinates on which a pair at the threshold agrees, but for a chance below 1e-6."""
    q = percent / 100
    return max(0, math.floor(COORDINATES * q - DEVIATIONS * math.sqrt(COORDINATES * q * (1 - q))))


def band_width(percent: int) -> int:
    """The widest band whose miss rate at the threshold is small enough; too low a threshold has none."""
    for rows in range(BAND, 0, -1):
        if (1 - (percent / 100) ** rows) ** (COORDINATES // rows) <= MISSED:
            return rows
    raise ValueError(f"{COORDINATES} coordinates cannot find pairs of {percent} percent")


def bands(coordinates: np.ndarray, rows: int = BAND) -> np.ndarray:
    """One 64-bit key per band of coordinates (16 bits each), the band's number mixed in."""
    n, t = coordinates.shape
    filled = np.zeros((n, t // rows, 4), "<u2")  # at most four coordinates of 16 bits
    filled[:, :, :rows] = coordinates.reshape(n, t // rows, rows)
    joined = filled.view(np.uint64).reshape(n, t // rows)
    return mix64(mix64(joined) + np.arange(t // rows, dtype=np.uint64)).view(np.int64)


def _digests(sets: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    raw = sets.tobytes()
    return [hashlib.blake2b(raw[8 * s : 8 * e], digest_size=16).digest() for s, e in zip(bounds[:-1], bounds[1:])]


def _sketcher(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches, SLICE_BYTES):
            sets, bounds = shingle_sets(b["text"], width)
            sketch = sketches(sets, bounds)
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "text_key": b["text_key"], "n": np.diff(bounds),
                "digest": _digests(sets, bounds),
                "coordinates": [x.tobytes() for x in mix64(sketch).astype(np.uint16)],
            })

    return run


def _bander(rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                keys = bands(np.frombuffer(b"".join(b["coordinates"]), "<u2").reshape(len(b), -1), rows)
                yield pd.DataFrame({"bucket": keys.reshape(-1), "node": np.repeat(b["node"].to_numpy(), keys.shape[1])})

    return run


def _set_maker(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches, SLICE_BYTES):
            sets, bounds = shingle_sets(b["text"], width)
            yield pd.DataFrame({"digest": _digests(sets, bounds), "shingles": [sets[s:e].view(np.int64) for s, e in zip(bounds[:-1], bounds[1:])]})

    return run


@F.pandas_udf(IntegerType())
def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).sum(1).astype(np.int32))


@F.pandas_udf(LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)], dtype="int64")


def _verified(pairs: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int, scratch: list[str]) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, by size, then sketch, then intersection.

    a may stand in very many pairs; such a row is dealt over parts.
    """

    def with_sides(p: DataFrame, of: DataFrame, columns: list[str]) -> DataFrame:
        a, b = (of.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "ab")
        return dealt_join(p, a, "a", "b").join(b, "b")

    p = with_sides(materialise(pairs, "near-pairs", scratch), sketch, ["n", "coordinates"])
    p = p.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    p = materialise(p.where(_agreeing("coordinates_a", "coordinates_b") >= least_agreeing(percent)).select("a", "b"), "near-likely", scratch)
    p = with_sides(p, sets, ["shingles"])
    p = p.select("a", "b", (F.size("shingles_a") + F.size("shingles_b")).alias("both"), _common("shingles_a", "shingles_b").alias("common"))
    return materialise(p.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b"), "near-links", scratch)


def _compare(percent: int):
    """Links between members of different components in two blocks (or within one): enough of them to join what they join."""
    least = least_agreeing(percent)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node, root, side = pdf["node"].to_numpy(), pdf["root"].to_numpy(), pdf["side"].to_numpy()
        names, at = np.unique(root, return_inverse=True)
        parent = list(range(len(names)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        coordinates = np.frombuffer(b"".join(pdf["coordinates"]), np.uint16).reshape(len(pdf), -1)
        sets = [np.asarray(x).view(np.uint64) for x in pdf["shingles"]]  # sorted as unsigned
        n = np.array([len(x) for x in sets])
        most = np.bincount(at).argmax()
        same = len(np.unique(side)) == 1
        links = []
        for x in np.flatnonzero(at != most):  # those in the largest component need no comparison with each other
            other = np.flatnonzero((same | (side != side[x])) & (at != at[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])))
            other = other[(coordinates[other] == coordinates[x]).sum(1) >= least]
            own = find(at[x])
            joined = np.array([find(k) for k in np.unique(at[other])], int) if len(other) else np.zeros(0, int)
            other = other[(joined != own)[np.searchsorted(np.unique(at[other]), at[other])]] if len(other) else other
            if not len(other):
                continue
            flat = np.concatenate([sets[k] for k in other])
            hit = np.searchsorted(sets[x], flat)
            hit = sets[x][np.minimum(hit, n[x] - 1)] == flat
            common = np.add.reduceat(hit, np.concatenate(([0], np.cumsum(n[other])[:-1])))
            for k in other[100 * common >= percent * (n[x] + n[other] - common)]:
                a, b = find(at[x]), find(at[k])
                if a != b:
                    parent[a] = b
                    links.append((node[x], node[k]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _cluster_links(rest: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int, scratch: list[str]) -> DataFrame:
    """Links between components among the members of large buckets."""
    cluster = components(rest.select(F.col("first").alias("a"), F.col("node").alias("b")), scratch)
    inside = rest.select("node", "root").distinct().join(cluster.withColumnRenamed("root", "cluster"), "node")
    inside = materialise(inside.join(sketch.select("node", "n", "coordinates"), "node"), "near-clusters", scratch)
    main = inside.groupBy("cluster", "root").count().groupBy("cluster").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    apart = F.col("root") != F.col("main")
    blocks = inside.join(materialise(main, "near-main", scratch), "cluster").groupBy("cluster", "main").agg(
        F.count("*").alias("size"), *[F.ceil(F.sum(F.when(c, F.col("n") * 8).otherwise(0)) / BLOCK_BYTES).cast("int").alias(k) for k, c in (("mains", ~apart), ("others", apart))]
    )
    x = hot_join(inside, materialise(blocks, "near-blocks", scratch), ["cluster"], "size").join(sets, "node")
    own = F.pmod(F.xxhash64("node"), F.when(apart, F.col("others")).otherwise(F.col("mains"))).cast("int")
    every = lambda n, make: F.transform(F.sequence(F.lit(0), n - 1), make)
    task = lambda kind, low, high: F.struct(F.lit(kind).alias("kind"), low.cast("int").alias("low"), high.cast("int").alias("high"))
    # a block of the others meets every block of the largest component, and every block of the others
    tasks = F.when(apart, F.concat(every(F.col("mains"), lambda k: task(0, F.col("own"), k)), every(F.col("others"), lambda k: task(1, F.least("own", k), F.greatest("own", k)))))
    tasks = tasks.otherwise(every(F.col("others"), lambda k: task(0, k, F.col("own"))))
    x = x.withColumn("own", own).select("cluster", "node", "root", "coordinates", "shingles", F.when(apart, F.col("own")).otherwise(-1).alias("side"), F.explode(tasks).alias("task"))
    x = x.select("task.*", "cluster", "node", "root", "coordinates", "shingles", "side")
    return materialise(x.groupBy("cluster", "kind", "low", "high").applyInPandas(_compare(percent), "a long, b long"), "near-cluster-links", scratch)


def _open_links(rest: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int, scratch: list[str]) -> DataFrame:
    """Links between members of a bucket (bucket, node, root, size, first) that are in different components."""
    few = rest.where(F.col("size") <= SMALL)
    pairs = few.select("bucket", F.col("node").alias("a"), F.col("root").alias("ra")).join(few.select("bucket", F.col("node").alias("b"), F.col("root").alias("rb")), "bucket")
    links = _verified(pairs.where("a < b AND ra <> rb").select("a", "b").distinct(), sketch, sets, percent, scratch)
    many = rest.where(F.col("size") > SMALL)
    return links if many.isEmpty() else links.union(_cluster_links(many, sketch, sets, percent, scratch))


def _linked(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, text_key, n, root, first: a row per row of documents. root: the component's name (null without words), first: its smallest doc_id."""
    spark, scratch = documents.sparkSession, []
    bounded_batches(spark)
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    sketched = base.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(_sketcher(width), "doc_id string, text_key long, n long, digest binary, coordinates binary")
    all_ = materialise(sketched.withColumn("doc_id", F.col("doc_id").cast("long")), "near-sketches")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_key", "n", "coordinates"))
    classes = all_.where("n > 0").groupBy("digest").agg(one.alias("r"), F.count("*").alias("copies")).select("digest", "copies", "r.*").drop("null")
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes", scratch)
    members = materialise(classes.select("node", "coordinates").mapInPandas(_bander(band_width(percent)), "bucket long, node long"), "near-bands", scratch)
    buckets = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("leader")).where("size > 1")
    star = materialise(hot_join(members, materialise(buckets, "near-buckets", scratch), ["bucket"], "size").drop("size"), "near-stars", scratch)
    sketch = classes.select("node", "n", "coordinates", "digest", F.col("doc_id").alias("of"), F.col("text_key").alias("of_key")).join(star.select("node").distinct(), "node")
    sketch = materialise(sketch, "near-coordinates", scratch)
    # one row of each class that meets another one; its set is known again by its digest
    wanted = checked_broadcast(sketch.select("of", "of_key"), most=1_000_000)
    texts = base.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_key")), "left_semi").select("text")
    sets = texts.mapInPandas(_set_maker(width), "digest binary, shingles array<long>").join(sketch.select("digest", "node"), "digest")
    sets = materialise(sets.select("node", "shingles").dropDuplicates(["node"]), "near-sets", scratch)

    links = _verified(star.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), sketch, sets, percent, scratch)
    roots = materialise(components(links, scratch), "near-roots", scratch)

    # each bucket's members without the one that all were compared with
    rest = star.where("node <> leader").join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    open_ = rest.groupBy("bucket").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"), F.min("node").alias("first")).where("low <> high")
    open_ = materialise(open_.select("bucket", "size", "first"), "near-open", scratch)
    if not open_.isEmpty():
        links = links.union(_open_links(materialise(hot_join(rest, open_, ["bucket"], "size"), "near-rest", scratch), sketch, sets, percent, scratch))
        roots = components(links, scratch)
    named = materialise(classes.select("digest", "copies", "node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "near-named", scratch)
    heads = materialise(named.groupBy("root").agg(F.min("doc_id").alias("first"), F.count("*").alias("size")), "near-heads", scratch)
    named = materialise(hot_join(named.select("digest", "copies", "root"), heads, ["root"], "size").drop("size"), "near-named")
    forget(spark, scratch)
    none = F.lit(None).cast("long")
    out = hot_join(all_.where("n > 0").select("doc_id", "text_key", "n", "digest"), named, ["digest"], "copies").select("doc_id", "text_key", "n", "root", "first")
    return out.union(all_.where("n = 0").select("doc_id", "text_key", "n", none.alias("root"), F.col("doc_id").alias("first")))


def link(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept, for every row of documents.

    Null and empty texts have no shingles and are linked with nothing; texts of
    fewer words than `width` have their whole sequence as one shingle. Rows with
    equal sets are one class, so repeated rows and ties share a component. A row
    without an id can be linked; its component is named by the others' ids, and null
    if no row of it has one (then kept is true). An empty table gives no rows; other
    columns are ignored. doc_id is an integer.
    """
    x = _linked(documents, width, percent)
    return x.select("doc_id", F.col("n").alias("n_shingles"), F.col("first").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("first")).alias("kept"))


def keep_one(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """documents with one row of each component, all columns as they are.

    The row with the smallest doc_id stays (null last), of several the one with the
    least text hash, of rows that repeat id and text one. Texts without words all
    stay, null and empty ones too. An empty table gives no rows; names of other
    columns cannot clash.
    """
    x = materialise(_linked(documents, width, percent).where("n > 0"), "near-linked")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_key"))
    keys = materialise(x.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("rows")), "near-keys")
    heads = materialise(keys.groupBy("root").agg(best.alias("best"), F.count("*").alias("size")), "near-best")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("text_key") == F.col("best.text_key"))
    judged = hot_join(keys, heads, ["root"], "size").select("doc_id", "text_key", "rows", stays.alias("stays"))
    return one_of_each(documents, {"doc_id": F.col("doc_id").cast("long"), "text_key": F.xxhash64("text")}, judged)
