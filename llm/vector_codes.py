"""Vector compression by product codes, with an exponion search of the nearest entry.

Vectors become integers (floor of 256 x) and are cut into equal parts; each part has
its own codebook, improved in rounds. A search starts at the part's previous entry,
at the squared distance s: an entry that is nearer, or as near, is not farther than
2 sqrt(s) from the previous one. So its list of neighbours, sorted by distance, is
scanned only while the neighbour's squared distance is at most 4 s. Distances are
exact integers, ties go to the lower index.

Each round reads the vectors with their codes, assigns, writes them to the shared
folder, and sums per entry: tasks sum first, so that only entries are shuffled, and
only codebooks (entries times dimensions, by parameters) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm._common import bounded_batches, forget, hot_join, materialise

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components up to this one have distances that 64-bit integers hold; with larger ones Python's integers count.
_SMALL = 1 << 24
#: Components from here on have no fixed-point form.
_LARGEST = 2.0**62


def _exact(x: np.ndarray) -> np.ndarray:
    return x if not x.size or -_SMALL < x.min() and x.max() < _SMALL else x.astype(object)


def nearest(points: np.ndarray, entries: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point and its squared distance; ties to the lower index.

    start: an entry's index per point. All points go through their start's list of
    neighbours together, and leave it where the next neighbour is too far off.
    """
    if len(points) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = _exact(np.concatenate((points, entries)))
    points, entries = joined[: len(points)], joined[len(points) :]
    apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    order = np.argsort(apart, axis=1, kind="stable")
    apart = np.take_along_axis(apart, order, 1)
    best, found = ((points - entries[start]) ** 2).sum(1), start.astype(np.int64)
    reach, going = 4 * best, np.arange(len(points))
    for k in range(len(entries)):
        going = going[(apart[start[going], k] <= reach[going]).astype(bool)]
        if not len(going):
            break
        entry = order[start[going], k]
        far = ((points[going] - entries[entry]) ** 2).sum(1)
        wins = ((far < best[going]) | ((far == best[going]) & (entry < found[going]))).astype(bool)
        best[going[wins]], found[going[wins]] = far[wins], entry[wins]
    return found, best


def assign(vectors: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """New codes (rows by parts) and their squared distances, from vectors of integers and the codes before."""
    width = vectors.shape[1] // len(books)
    out, error = np.empty_like(codes), []
    for p, book in enumerate(books):
        out[:, p], far = nearest(vectors[:, p * width : (p + 1) * width], book, codes[:, p].astype(np.int64))
        error.append(far)
    return out, np.stack(error, 1) if error else np.zeros((len(vectors), 0), np.int64)


def entry_sums(vectors: np.ndarray, codes: np.ndarray) -> Iterator[tuple[int, int, int, list[int]]]:
    """part, entry, count and componentwise sums of the parts that have the entry."""
    width = vectors.shape[1] // codes.shape[1]
    vectors = _exact(vectors)
    for p in range(codes.shape[1]):
        order = np.argsort(codes[:, p], kind="stable")
        used, at, count = np.unique(codes[order, p], return_index=True, return_counts=True)
        sums = np.add.reduceat(vectors[order, p * width : (p + 1) * width], at, axis=0)
        yield from ((p, int(e), int(n), [int(s) for s in row]) for e, n, row in zip(used, count, sums))


def fixed_point(embeddings: DataFrame, key: str = "vec_id", label: str = "label", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """key, label, v (integers): rows with a whole, finite vector that the parts divide and that has the table's length.

    The table's length is that of the row with the smallest key (null last, longest
    first). Vectors without components are dropped like null ones; so are those with
    a component of 2^62 / scale or more, which has no fixed-point form.
    """
    x = F.col("embedding")
    whole = embeddings.where(x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0)).where(
        F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * scale < F.lit(_LARGEST)))
    )
    length = whole.orderBy(F.col(key).asc_nulls_last(), F.size(x).desc()).select(F.size(x).alias("n")).limit(1).collect()
    n = length[0].n if length else 0
    return whole.where(F.size(x) == n).select(F.col(key).alias("key"), F.col(label).alias("label"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def first_books(kept: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """Codebooks of the parts of the first vectors by key (null last), then components."""
    rows = kept.orderBy(F.col("key").asc_nulls_last(), "v").select("v").limit(entries).collect()
    return np.split(np.array([r.v for r in rows], np.int64), parts, axis=1) if rows else []


def _rows(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    vectors = np.stack(batch["v"].to_numpy()).astype(np.int64, copy=False)
    return vectors, np.frombuffer(b"".join(batch["code"]), np.uint8).reshape(len(batch), -1)


def _assigned(state: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """state with new codes, and the error of each row; null where it is no 64-bit integer."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                codes, far = assign(*_rows(b), books)
                total = far.sum(1)
                error = [int(t) if t < 1 << 63 else None for t in total]
                yield b.assign(code=[c.tobytes() for c in codes], error=pd.array(error, "Int64"))

    columns = ["key", "label", "v", "code"]
    schema = ", ".join(f"{c} {dict(state.dtypes)[c]}" for c in columns) + ", error long"
    return state.select(columns).mapInPandas(run, schema)


def improve(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks of the floored means of the parts that have each entry; unused entries stay."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame(
                    [(p, e, n, i, str(s)) for p, e, n, row in entry_sums(*_rows(b)) for i, s in enumerate(row)], columns=["part", "entry", "n", "at", "s"]
                )

    sums = state.select("v", "code").mapInPandas(run, "part int, entry int, n long, at int, s string")
    summed = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).alias("s"))
    out = [b.copy() for b in books]
    for r in summed.collect():  # entries times dimensions at most
        out[r.part][r.entry, r["at"]] = int(r.s) // r.n
    return out


def books_sha256(books: list[np.ndarray]) -> str:
    """Of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(c)) for b in books for c in b.ravel()).encode()).hexdigest()


def learn(embeddings: DataFrame, key: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """The kept vectors with their last codes (key, label, v, code), and the codebooks after all rounds."""
    if not 0 < entries <= 256 or parts <= 0 or rounds < 0:
        raise ValueError("an entry's index is one byte; there is at least one part")
    spark, scratch = embeddings.sparkSession, []
    bounded_batches(spark)
    kept = fixed_point(embeddings, key, label, parts, scale).withColumn("code", F.unhex(F.lit("00" * parts)))
    state = materialise(kept, "codes-kept", scratch)
    books = first_books(state, parts, entries)
    for _ in range(rounds if books else 0):
        state = materialise(_assigned(state, books).drop("error"), "codes-state", scratch)
        books = improve(state, books)
        before, scratch[:] = scratch[:-1], scratch[-1:]
        forget(spark, before)
    return state, books


def compress(embeddings: DataFrame, key: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """key, code (two hex digits per part), error, label_error, codebooks_sha256: a row per kept row.

    Rows whose vector is null or has null or non-finite components are dropped (more
    in fixed_point). Rows with a null key are kept, and come last among those that
    the codebooks start from; equal keys go by their components there, so repeated
    rows count each by itself. With fewer rows than entries there are fewer entries.
    Null labels are one label, however many rows have it; error and label_error are
    null where they exceed a 64-bit integer. An empty table gives no rows; other
    columns are ignored.
    """
    state, books = learn(embeddings, key, label, parts, entries, rounds, scale)
    done = materialise(_assigned(state, books).select("key", "label", "code", "error"), "codes-done")
    by = done.select("key", F.col("label").isNull().alias("l_null"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("l"), "code", "error")
    total = F.when(F.count("error") == F.count("*"), F.expr("CAST(try_sum(CAST(error AS DECIMAL(20,0))) AS DECIMAL(38,0))"))
    groups = by.groupBy("l_null", "l").agg(F.count("*").alias("size"), F.when(total <= F.lit(2**63 - 1), total).cast("long").alias("label_error"))
    return hot_join(by, materialise(groups, "codes-labels"), ["l_null", "l"], "size").select(
        F.col("key").alias(key), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")
    )


def decode(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """codes (with `code` in hex) and `vector`: the entries' components, as doubles."""
    if not books:
        return codes.withColumn("vector", F.array().cast("array<double>"))
    flat = np.concatenate([b.astype(float) / scale for b in books]).tolist()

    @F.pandas_udf("array<double>")
    def run(code: pd.Series) -> pd.Series:
        table, at = np.array(flat), np.cumsum([0] + [len(b) for b in books[:-1]])
        return pd.Series([table[np.frombuffer(bytes.fromhex(c), np.uint8) + at].ravel().tolist() for c in code])

    return codes.withColumn("vector", run("code"))


def _sql() -> str:
    head = """
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
p AS (SELECT vec_id, j AS part, v[j * (len(v) // 16) + 1:(j + 1) * (len(v) // 16)] AS x FROM k, range(16) t(j)),
c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, x FROM p
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64))"""
    assigned = """,
a{r} AS (
  SELECT vec_id, part, any_value(x) AS x, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d
  FROM (SELECT p.vec_id, p.part, p.x, c.e, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM p JOIN c{r} c USING (part))
  GROUP BY vec_id, part)"""
    improved = """,
s{r} AS (SELECT part, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, (SELECT max(len(x)) + 1 FROM p)) t(i) GROUP BY ALL),
m{r} AS (SELECT part, e, list((s - (s % n + n) % n) // n ORDER BY i) AS x FROM s{r} GROUP BY ALL),
c{n} AS (SELECT c.part, c.e, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (part, e))"""
    tail = """,
e AS (SELECT vec_id, string_agg(printf('%02x', e::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{n} GROUP BY vec_id)
SELECT e.vec_id, e.code, e.error, sum(e.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) FROM c{n}) AS codebooks_sha256
FROM e JOIN k USING (vec_id)
"""
    return head + "".join(assigned.format(r=r) + improved.format(r=r, n=r + 1) for r in range(ROUNDS)) + assigned.format(r=ROUNDS) + tail.format(n=ROUNDS)


SQL = _sql()
