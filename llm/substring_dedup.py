"""Substring dedup: words of passages that stand earlier in the corpus, found by FM-indexes over shards of it.

Every window of WIDTH words has an anchor: of its runs of ANCHOR words the one with
the least hash. Neighbouring windows with one anchor make a segment, so each window
is in one segment, and equal windows have equal anchors. Segments are dealt by
anchor. Anchors that stand once in the corpus need no search; of equal segments the
first one is indexed. Shards of whole anchors get an FM-index each, and the shard's
segments are streamed against it by backward search: matching statistics of WIDTH or
more report the windows, and where each stands first.

Anchors of very many segments are cut finer: every window is then a segment of its
own, named and dealt by all its words, so that equal windows are equal segments. That
holds for the hottest (one in HOT_KEYS of all segments, so fewer than that) before
segments are shuffled, and for all others with more than MOST_SEGMENTS different ones,
which would not fit a shard. Segments are equal where two 64-bit hashes of theirs are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm._common import HOT_KEYS, bounded_batches, checked_broadcast, materialise
from llm._fm_index import FMIndex
from llm._text import RangeHasher, mix64, slices, word_hashes

WIDTH, ANCHOR = 20, 5
#: Words of a shard, about.
SHARD_WORDS = 1 << 18
#: Different segments of one anchor that go to a shard together: with some 27 words each they fill one.
MOST_SEGMENTS = 8000
#: Rows made at once of those that are equal in id and text.
CHUNK = 10_000
_LAST = (1 << 63) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

#: anchor, body: hashes of the anchor and of the segment's words. doc, tie: which text. start: its first word. windows: how many begin in it. done: known to be repeated as a whole.
SEGMENT = "anchor long, body long, doc long, tie long, start long, windows long, done boolean"
SPAN = "doc long, tie long, start long, end long"


def keyed(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, text, doc, tie, times: a row per distinct pair of id and text.

    doc and tie order the texts: by id, null last; rows that repeat an id by a hash
    of their text. times: rows that are equal in both. Ids are seldom repeated, so
    texts are grouped only where they are.
    """
    x = documents.select(F.col(key).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("doc"))
    if x.groupBy("doc").count().where("count > 1").isEmpty():
        return x.select("*", F.lit(0).cast("long").alias("tie"), F.lit(1).cast("long").alias("times"))
    x = x.withColumn("tie", F.xxhash64("text"))
    equal = materialise(x.groupBy("doc", "tie").agg(F.count("*").alias("times")).where("times > 1"), "spans-equal")
    if equal.isEmpty():
        return x.withColumn("times", F.lit(1).cast("long"))
    x = x.join(checked_broadcast(equal), ["doc", "tie"], "left").select("doc_id", "text", "doc", "tie", "times")
    once = x.where("times IS NOT NULL").groupBy("doc", "tie").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "times")])
    return x.where("times IS NULL").withColumn("times", F.lit(1).cast("long")).unionByName(once)


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """Place of the least of values[i:i+n] for every i, the first of equal ones; what lies beyond the end counts as greatest."""
    at, done = np.arange(len(values)), 1
    while done < n:
        step = min(done, n - done)
        right = np.minimum(np.arange(len(values)) + step, len(values) - 1)
        right = at[right]
        at = np.where(values[right] < values[at], right, at)
        done += step
    return at


def _alone(body: np.ndarray) -> np.ndarray:
    """Names of windows that are segments of their own."""
    return mix64(body ^ np.uint64(0x2545F4914F6CDD1D)).view(np.int64)


def segments(texts: list[str], hot: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR) -> dict[str, np.ndarray]:
    """Columns anchor, body, row (number of the text), start, windows: in the order of the texts. hot: sorted anchors whose windows stand alone."""
    words, bounds = word_hashes(texts, fold=None)
    counts = np.diff(bounds)
    row_of = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(bounds[1:][row_of] - np.arange(len(words)) >= width)  # windows
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in ("anchor", "body", "row", "start", "windows")}
    ranges = RangeHasher(words)
    grams = np.arange(len(words) - anchor + 1)
    hashes = ranges(grams, grams + anchor)
    least = _least(hashes, width - anchor + 1)[at]
    alone = np.isin(hashes[least], hot) if len(hot) else np.zeros(len(at), bool)
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | alone[1:] | alone[:-1]
    first = np.flatnonzero(new)
    start, windows = at[first], np.diff(np.append(first, len(at)))
    body = ranges(start, start + windows + width - 1)
    name = np.where(alone[first], _alone(body), hashes[least[first]].view(np.int64))
    return {"anchor": name, "body": body.view(np.int64), "row": row_of[start], "start": start - bounds[row_of[start]], "windows": windows}


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and adjoining spans of a row as one; starts and ends ascend within a row."""
    if not len(row):
        return row, start, end
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return row[first], start[first], end[np.append(first[1:], len(row)) - 1]


def _combined(b: pd.DataFrame, found: dict[str, np.ndarray], width: int) -> pd.DataFrame:
    """The batch's segments, of equal ones the first; the others as spans that are done, under names that spread them."""
    doc, tie = b["doc"].to_numpy()[found["row"]], b["tie"].to_numpy()[found["row"]]
    order = np.lexsort((found["start"], tie, doc, found["body"], found["anchor"]))
    later = np.zeros(len(order), bool)
    later[order[1:]] = (found["anchor"][order[1:]] == found["anchor"][order[:-1]]) & (found["body"][order[1:]] == found["body"][order[:-1]])
    first = pd.DataFrame({"anchor": found["anchor"], "body": found["body"], "doc": doc, "tie": tie, "start": found["start"], "windows": found["windows"], "done": False})[~later]
    row, start, end = merged(found["row"][later], found["start"][later], found["start"][later] + found["windows"][later] + width - 1)
    spread = mix64(b["doc"].to_numpy().astype(np.uint64)[row] + start.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    rest = pd.DataFrame({"anchor": spread, "body": 0, "doc": b["doc"].to_numpy()[row], "tie": b["tie"].to_numpy()[row], "start": start, "windows": end - start - width + 1, "done": True})
    return pd.concat((first, rest), ignore_index=True)


def hot_anchors(texts: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, least: int = MOST_SEGMENTS) -> np.ndarray:
    """Anchors of more than one in HOT_KEYS of all segments (equal ones of a batch count once), and of more than `least`: fewer than HOT_KEYS."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            found = segments(b["text"], np.zeros(0, np.uint64), width, anchor)
            pairs = np.unique(np.stack((found["anchor"], found["body"])), axis=1)
            names, n = np.unique(pairs[0], return_counts=True)
            often = n * (2 * HOT_KEYS) >= n.sum()  # what is hot everywhere is so in some batch
            yield pd.DataFrame({"anchor": pd.array([*names[often].tolist(), None], "Int64"), "n": [*n[often].tolist(), int(n.sum())]})

    seen = texts.select("text").mapInPandas(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    seen = materialise(seen, "spans-hot")
    total = seen.where("anchor IS NULL").select("n").collect()
    floor = max(least, total[0].n // HOT_KEYS if total else 0)
    return np.sort(np.array([r.anchor for r in seen.where(f"anchor IS NOT NULL AND n > {floor}").collect()], np.int64).view(np.uint64))


def _told(rows: DataFrame) -> DataFrame:
    """rows of segments (one task per anchor) with first (of its equals), found (rows of its anchor) and different (segments of it that differ)."""
    equal = Window.partitionBy("anchor", "body").orderBy("doc", "tie", "start")
    x = rows.repartition("anchor").withColumn("first", (F.row_number().over(equal) == 1) & ~F.col("done"))
    of_anchor = Window.partitionBy("anchor")
    return x.select("*", F.count("*").over(of_anchor).alias("found"), F.sum(F.col("first").cast("long")).over(of_anchor).alias("different")).where("found > 1 OR done")


def repeated_segments(texts: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, most: int = MOST_SEGMENTS) -> DataFrame:
    """Segments whose anchor stands more than once, with first and different; done ones too. Written to the shared folder."""
    hot = hot_anchors(texts, width, anchor, most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            yield _combined(b, segments(b["text"], hot, width, anchor), width)

    return materialise(_told(texts.select("doc", "tie", "text").mapInPandas(run, SEGMENT)), "spans-segments")


def _word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    word = np.zeros(len(raw) + 2, np.int8)
    word[1:-1] = ~_SPACE[np.frombuffer(raw, np.uint8)]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _with_words(texts: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """The rows' segments with their words. Of wide ones each window as a segment of its own, named by all its words, without them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            out, row, start = [], [], []
            for i, (doc, tie, text, wanted) in enumerate(zip(b["doc"], b["tie"], b["text"], b["rows"])):
                raw = text.encode("utf-8", "surrogatepass")
                starts, ends = _word_bounds(raw)
                for r in sorted(wanted, key=lambda r: r["start"]):
                    at, n = r["start"], r["windows"]
                    if r["wide"]:
                        start.append(np.arange(at, at + n))
                        row.append(np.full(n, i))
                    else:
                        out.append((r["anchor"], 0, doc, tie, at, n, False, raw[starts[at] : ends[at + n + width - 2]].decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["anchor", "body", "doc", "tie", "start", "windows", "done", "words"])
            if row:
                row, start = np.concatenate(row), np.concatenate(start)
                words, bounds = word_hashes(b["text"], fold=None)
                at = bounds[row] + start
                body = RangeHasher(words)(at, at + width)
                alone = {"anchor": _alone(body), "body": body.view(np.int64), "row": row, "start": start, "windows": np.ones(len(row), np.int64)}
                yield _combined(b, alone, width).assign(words=None)

    packed = rows.groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "start", "windows", "wide")).alias("rows"))
    return texts.select("doc", "tie", "text").join(packed, ["doc", "tie"]).mapInPandas(run, f"{SEGMENT}, words string")


def _searched(b: pd.DataFrame, width: int) -> pd.DataFrame:
    """One shard: an index over its segments, and the spans of their windows that it has earlier."""
    b = b.sort_values(["doc", "tie", "start"], kind="stable").reset_index(drop=True)
    ids: dict[bytes, int] = {}
    parts = [np.array([ids.setdefault(w, len(ids) + 1) for w in t.encode("utf-8", "surrogatepass").split()], np.int64) for t in b["words"]]
    index = FMIndex(parts, width)
    where, found = [], []
    for i, (lengths, places) in enumerate(index.matching_statistics(parts)):
        hits = np.flatnonzero((lengths >= width) & (places < index.starts[i] + np.arange(len(places))))
        where.append(np.full(len(hits), i))
        found.append(hits)
    row, start, end = merged(np.concatenate(where), np.concatenate(found), np.concatenate(found) + width)
    at = b["start"].to_numpy()[row]
    return pd.DataFrame({"doc": b["doc"].to_numpy()[row], "tie": b["tie"].to_numpy()[row], "start": at + start, "end": at + end})


def repeated_spans(texts: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, most: int = MOST_SEGMENTS) -> DataFrame:
    """doc, tie, start, end: spans of words (they may overlap) covered by windows that also start earlier. texts: from keyed()."""
    if not 0 < anchor <= width:
        raise ValueError("an anchor has one word at least, and no more than a window")
    spark = texts.sparkSession
    bounded_batches(spark)
    found = repeated_segments(texts, width, anchor, most)
    spans, wide = _known(found, width), F.col("different") > most
    first = found.where("first")
    words, n_wide = first.agg(F.sum(F.when(~wide, F.col("windows") + (width - 1))), F.count_if(wide)).first()
    made = _with_words(texts, first.withColumn("wide", wide), width)
    if n_wide:
        made = materialise(made, "spans-words")  # read twice
        spans = spans.unionByName(_known(materialise(_told(made.where("words IS NULL").drop("words")), "spans-windows"), width))
    shard = F.pmod(F.xxhash64("anchor"), F.lit((words or 0) // SHARD_WORDS + 1))
    parts = made.where("words IS NOT NULL").select(shard.alias("shard"), "doc", "tie", "start", "words")
    return spans.unionByName(parts.groupBy("shard").applyInPandas(lambda b: _searched(b, width), SPAN))


def _known(found: DataFrame, width: int) -> DataFrame:
    """Spans of the segments that have an equal one before them."""
    return found.where("NOT first").select("doc", "tie", "start", (F.col("start") + F.col("windows") + (width - 1)).alias("end"))


def without_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, times, n_words, n_removed, spans (merged), text (kept words, one space between): a row per text."""
    packed = spans.groupBy("doc", "tie").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            out = []
            for doc_id, times, text, spans in zip(b["doc_id"], b["times"], b["text"], b["spans"]):
                words = text.encode("utf-8", "surrogatepass").split()
                kept, cut, at = [], [], 0
                for s in [] if spans is None else spans:
                    if cut and s["start"] <= at:
                        cut[-1]["end"] = at = max(at, s["end"])
                        continue
                    kept += words[at : s["start"]]
                    at = s["end"]
                    cut.append({"start": s["start"], "end": at})
                kept += words[at:]
                out.append((doc_id, times, len(words), len(words) - len(kept), cut, b" ".join(kept).decode("utf-8", "surrogatepass")))
            x = pd.DataFrame(out, columns=["doc_id", "times", "n_words", "n_removed", "spans", "text"])
            x["doc_id"] = x["doc_id"].astype(b["doc_id"].dtype if isinstance(b["doc_id"].dtype, pd.api.extensions.ExtensionDtype) else object)
            yield x

    kind = dict(texts.dtypes)["doc_id"]
    joined = texts.join(packed, ["doc", "tie"], "left").select("doc_id", "times", "text", "spans")
    return joined.mapInPandas(run, f"doc_id {kind}, times long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, text string")


def remove_repeats(documents: DataFrame, key: str = "doc_id", width: int = WIDTH, anchor: int = ANCHOR, most: int = MOST_SEGMENTS) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word numbers, end exclusive), text (what is kept): a row per row of documents.

    A word goes if a window that covers it also starts earlier: in a text with a
    smaller integer id, or before in the same text; windows are those of the input.
    Null ids come last; texts that share an id are ordered by a hash. Of rows equal
    in id and text one counts as the first, the others lose every window. Null and
    empty texts, and those with fewer words than a window, lose nothing. Texts are
    read whole. An empty table gives no rows; other columns are ignored.
    """
    texts = keyed(documents, key)
    out = without_spans(texts, repeated_spans(texts, width, anchor, most))
    out = out.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(CHUNK).cast("long"))))
    out = out.withColumn("_i", F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK, F.col("times")) - 1)))
    again = (F.col("_i") > 0) & (F.col("n_words") >= width)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return out.select(
        F.col("doc_id").alias(key), "n_words", F.when(again, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(again, whole).otherwise(F.col("spans")).alias("spans"), F.when(again, "").otherwise(F.col("text")).alias("text"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 19 <= len(w) THEN array_to_string(w[i:i + 19], ' ') END AS win
      FROM d, unnest(range(1, len(w) + 1)) u(i)),
r AS (SELECT doc_id, i, word, win IS NOT NULL AND row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS again FROM t),
c AS (SELECT doc_id, i, word, coalesce(max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id ORDER BY i) >= i - 19, false) AS gone FROM r),
k AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
