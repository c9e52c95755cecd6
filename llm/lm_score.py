"""Language-model scores by deleted interpolation of word n-grams.

Documents are read in parts, runs of rows of one file. Each part counts its
distinct words, pairs and triples; counts meet by key range, and a part is told the
counts of its keys, in their order. Then the documents meet what their part was
told. So no n-gram table is broadcast or joined row by row: what crosses the network
are blocks of distinct keys, and the texts once. A block is a part's share of a range.
From MOST_RANGES ranges on it would get small, and there is a level between: groups of
parts sum the keys of a slice (several ranges) first, ranges meet groups, and answers
go back by the same two steps. Then there are parts times slices blocks and groups
times ranges, either of which grows as the corpus to the power 1.5 and not 2.

P(w | u, v) = a c(u,v,w)/c(u,v) + b c(v,w)/c(v) + d c(w)/N + e /(V+1), with weights
(a, b, d, e) by the bucket of c(u,v), or of c(v) where (u,v) is unseen, learnt by
expectation-maximisation on the triples of one training document in DELETED, all of
whose counts are left out while weights are learnt. The result does not depend on
how rows are split into parts.

Words are known by 64-bit hashes. Pairs and triples keep as many bits of theirs as
the corpus needs (SPARE more than its bytes count), so that two share a key with a
chance below 2^-SPARE at every size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm._common import bounded_batches, in_fold, materialise
from llm._text import mix64, slices, word_hashes

FOLDS, HELD_OUT = 10, 0
#: Bytes of text in a part, about.
PART_BYTES = 3 << 20
#: Ranges that all parts meet without a level between: their blocks hold some fifty keys then.
MOST_RANGES = 1 << 15
#: One training document in so many is kept out of the counts while weights are learnt.
DELETED = 10
ALPHA = 0.1
#: Context-frequency buckets: by the power of two of c(v), up to this one.
BUCKETS = 24
#: Logarithmic bins per octave, and bins, in which the weights' learning counts probabilities: each is off by 9 percent at most (half a quarter of an octave).
PER_OCTAVE, BINS = 4, 192
#: Spare bits in the keys of pairs and triples.
SPARE = 20
_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)


def tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, then its one end token; bounds by text."""
    words, bounds = word_hashes(texts)
    n = len(bounds) - 1
    out = np.full(len(words) + n, _END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[bounds[1:] + np.arange(n)] = False
    out[keep] = words
    return out, bounds + np.arange(n + 1)


def with_context(toks: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word before each token (a start mark for the first), the hash of the pair, and that of the triple for all tokens but the first of a text."""
    before = np.empty_like(toks)
    before[1:] = toks[:-1]
    before[bounds[:-1]] = _START
    pairs = mix64(mix64(before) * np.uint64(3) + toks)
    later = np.ones(len(toks), bool)
    later[bounds[:-1]] = False
    later = np.flatnonzero(later)
    return before, pairs, mix64(pairs[later - 1] * np.uint64(5) + toks[later])


def shift_of(size: int) -> int:
    """How many low bits the keys of pairs and triples go without, for a corpus of so many bytes."""
    return 64 - min(63, max(40, (size + 1).bit_length() + SPARE))


def _unigram_key(words: np.ndarray) -> np.ndarray:
    return mix64(words) & ~np.uint64(1)  # pairs and triples have the lowest bit set


def _longer_key(hashes: np.ndarray, shift: int) -> np.ndarray:
    return (hashes >> np.uint64(shift)) << np.uint64(shift) | np.uint64(1)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes, high bytes first: Spark's own compression then takes out the empty planes."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(">u8").reshape(-1).astype(np.uint64)


def pack_keys(keys: np.ndarray, shift: int) -> bytes:
    """Sorted keys: the words' first, then the longer ones' without their empty bits, each as differences."""
    longer = (keys & np.uint64(1)) == 1
    words = keys[~longer]
    return pack(np.concatenate(([np.uint64(len(words))], np.diff(words, prepend=np.uint64(0)), np.diff(keys[longer] >> np.uint64(shift), prepend=np.uint64(0)))))


def unpack_keys(packed: bytes, shift: int) -> np.ndarray:
    x = unpack(packed)
    n = int(x[0])
    words, longer = np.cumsum(x[1 : n + 1], dtype=np.uint64), np.cumsum(x[n + 1 :], dtype=np.uint64)
    return np.sort(np.concatenate((words, longer << np.uint64(shift) | np.uint64(1))))


def dealt(documents: DataFrame, part_rows: int, part_bytes: int) -> DataFrame:
    """doc_id, text, train, part: runs of part_rows rows of a file; odd parts hold the documents left out for the weights.

    A text of more than half a part is a part of its own.
    """
    train = in_fold("doc_id", FOLDS) != HELD_OUT
    row = F.col("_metadata.row_index")
    alone = F.coalesce(F.octet_length("text"), F.lit(0)) * 2 > part_bytes
    run = F.xxhash64(F.regexp_extract("_metadata.file_path", "[^/]*$", 0), alone, F.when(alone, row).otherwise(F.floor(row / part_rows)))
    left_out = train & (F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(DELETED)) == 0)
    part = F.pmod(run, F.lit(1 << 30)) * 2 + left_out.cast("int")
    return documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), train.alias("train"), part.cast("long").alias("part"))


def _counted(texts, train: np.ndarray, shift: int):
    """keys (sorted, distinct), n (how often training texts have them), index (of the keys of words, pairs, triples and first contexts), bounds by text.

    The start mark before each text counts as a word that is no token.
    """
    toks, bounds = tokens(texts)
    before, pairs, triples = with_context(toks, bounds)
    first = bounds[:-1]
    keys, index = np.unique(np.concatenate((_unigram_key(toks), _longer_key(pairs, shift), _longer_key(triples, shift), _unigram_key(before[first]))), return_inverse=True)
    of = np.repeat(train, np.diff(bounds))
    n = np.bincount(index, np.concatenate((of, of, np.delete(of, first), train)), len(keys)).astype(np.int64)
    return keys, n, index, bounds


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _cut(keys: np.ndarray, ranges: int) -> Iterator[tuple[int, slice]]:
    """The ranges that sorted keys have, and where theirs are."""
    of = _range_of(keys, ranges).astype(np.int64)
    edges = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1], [True]))) if len(of) else []
    for a, e in zip(edges[:-1], edges[1:]):
        yield int(of[a]), slice(a, e)


def _counter(ranges: int, shift: int):
    """Blocks of each part: of left-out parts (odd ones) all counts are to be left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches, 12 << 20):
            for part, own in b.groupby("part", sort=False):
                rows = []
                keys, n, _, _ = _counted(own["text"], own["train"].to_numpy(bool), shift)
                for r, at in _cut(keys, ranges):
                    counts = pack(n[at])
                    rows.append((r, int(part), pack_keys(keys[at], shift), counts, counts if part % 2 else b""))
                yield pd.DataFrame(rows, columns=["range", "part", "keys", "n", "left_out"])

    return run


def _summed(pdf: pd.DataFrame, shift: int):
    """keys (sorted, distinct), total and left_out of each; part and of (the number of the key) of the blocks' own keys, in the order of parts and keys."""
    blocks = [unpack_keys(k, shift) for k in pdf["keys"]]
    sizes = [len(k) for k in blocks]
    n = np.concatenate([unpack(x) for x in pdf["n"]]).astype(np.int64)
    left_out = np.concatenate([unpack(x) if x else np.zeros(k, np.uint64) for x, k in zip(pdf["left_out"], sizes)]).astype(np.int64)
    part = np.repeat(pdf["part"].to_numpy(np.int64), sizes)
    keys, of = np.unique(np.concatenate(blocks), return_inverse=True)
    del blocks
    total, out = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    np.add.at(total, of, n)
    np.add.at(out, of, left_out)
    order = np.lexsort((of, part))
    part, of = part[order], of[order]
    new = np.concatenate(([True], (part[1:] != part[:-1]) | (of[1:] != of[:-1])))  # a part's rows may come in several batches
    return keys, total, out, part[new], of[new]


def _answers(part: np.ndarray, of: np.ndarray, r: int, total: np.ndarray, kept: np.ndarray, all_kept: bool) -> list[tuple]:
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    out = []
    for a, e in zip(edges[:-1], edges[1:]):
        p, at = int(part[a]), of[a:e]
        out.append((p, r, pack(total[at]), pack(kept[at]) if all_kept or p % 2 else b""))
    return out


_ANSWER = ["part", "range", "total", "kept"]


def _meet(pdf: pd.DataFrame, shift: int, all_kept: bool = False) -> pd.DataFrame:
    """Adds up one key range. Each part is told the counts of its keys, in their order, left-out ones (or all_kept) also without what is left out; part -1 gets the totals."""
    keys, total, out, part, of = _summed(pdf, shift)
    word = (keys & np.uint64(1)) == 0
    word &= keys != _unigram_key(np.array([_START], np.uint64))[0]
    kept, r = total - out, int(pdf["range"].iloc[0])
    sums = np.array([np.count_nonzero(word & (total > 0)), total[word].sum(), np.count_nonzero(word & (kept > 0)), kept[word].sum()], np.int64)
    return pd.DataFrame([(-1, r, pack(sums), b""), *_answers(part, of, r, total, kept, all_kept)], columns=_ANSWER)


def _grouped(pdf: pd.DataFrame, ranges: int, groups: int, shift: int) -> pd.DataFrame:
    """One slice of a group of parts as blocks of its ranges; its number stands in the place of a part's."""
    keys, total, out, _, _ = _summed(pdf, shift)
    node = int(pdf["range"].iloc[0]) * groups + int(pdf["group"].iloc[0])
    rows = [(r, node, pack_keys(keys[at], shift), pack(total[at]), pack(out[at])) for r, at in _cut(keys, ranges)]
    return pd.DataFrame(rows, columns=["range", "part", "keys", "n", "left_out"])


def _passed_on(pdf: pd.DataFrame, told: pd.DataFrame, shift: int) -> pd.DataFrame:
    """What a group was told about its slice, to each of its parts."""
    if pdf.empty:
        return pd.DataFrame(columns=_ANSWER)
    _, _, _, part, of = _summed(pdf, shift)
    told = told.sort_values("range")
    total, kept = (np.concatenate([unpack(x) for x in told[c]]).astype(np.int64) for c in ("total", "kept"))
    return pd.DataFrame(_answers(part, of, int(pdf["range"].iloc[0]), total, kept, False), columns=_ANSWER)


def _told(docs: DataFrame, ranges: int, shift: int) -> DataFrame:
    """part, range, total, kept: what each part is told of its keys by range (or slice), and the totals under part -1."""
    block, answer = "range int, part long, keys binary, n binary, left_out binary", "part long, range int, total binary, kept binary"
    if ranges <= MOST_RANGES:
        blocks = docs.mapInPandas(_counter(ranges, shift), block)
        return materialise(blocks.groupBy("range").applyInPandas(lambda pdf: _meet(pdf, shift), answer), "lm-told")
    groups = slices_ = math.isqrt(ranges) + 1
    group = F.pmod(F.xxhash64("part"), F.lit(groups)).cast("long")
    blocks = materialise(docs.mapInPandas(_counter(slices_, shift), block).withColumn("group", group), "lm-blocks")
    nodes = blocks.groupBy("range", "group").applyInPandas(lambda pdf: _grouped(pdf, slices_ * (-(-ranges // slices_)), groups, shift), block)
    told = materialise(nodes.groupBy("range").applyInPandas(lambda pdf: _meet(pdf, shift, True), answer), "lm-told-groups")
    node = told.where("part >= 0").select(F.floor(F.col("part") / groups).cast("int").alias("slice"), (F.col("part") % groups).alias("group"), "range", "total", "kept")
    passed = blocks.groupBy("range", "group").cogroup(node.groupBy("slice", "group")).applyInPandas(lambda a, b: _passed_on(a, b, shift), answer)
    return materialise(passed.unionByName(told.where("part = -1")), "lm-told")


def _totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame([unpack(x).astype(np.int64) for x in b["total"]], columns=["v", "n", "v_kept", "n_kept"])


def _looked_up(docs: pd.DataFrame, told: pd.DataFrame, column: str, shift: int):
    """c(w), c(v,w), c(u,v,w), c(v), c(u,v) per token, and the bounds by text. Before a text stand two start marks."""
    keys, _, index, bounds = _counted(docs["text"], docs["train"].to_numpy(bool), shift)
    n = np.concatenate([unpack(x) for x in told.sort_values("range")[column]]).astype(np.int64)
    assert len(n) == len(keys), "a part's rows changed between the passes"
    size, first = bounds[-1], bounds[:-1]
    c1, c2 = n[index[:size]], n[index[size : 2 * size]]
    start = n[index[3 * size - len(first) :]]
    c3, cv, cuv = c2.copy(), np.empty_like(c1), np.empty_like(c1)
    c3[np.delete(np.arange(size), first)] = n[index[2 * size : 3 * size - len(first)]]
    cv[1:], cuv[1:] = c1[:-1], c2[:-1]
    cv[first], cuv[first] = start, start
    return c1, c2, c3, cv, cuv, bounds


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the whole part of log2 of the count."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(int) + 1, BUCKETS - 1), 0)


def context(cuv: np.ndarray, cv: np.ndarray) -> np.ndarray:
    """The weights' row: by the pair before where it is known, else by the word before."""
    return np.where(cuv > 0, BUCKETS + bucket(cuv), bucket(cv))


def _bins(p: np.ndarray) -> np.ndarray:
    octaves = -np.log2(np.where(p > 0, p, 1.0))
    return np.where(p > 0, np.minimum((octaves * PER_OCTAVE).astype(int), BINS - 2) + 1, 0)


def _tally(n_kept: int, shift: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame({"bucket": [], "p3": [], "p2": [], "p1": [], "n": []}).astype("int64")
        c1, c2, c3, cv, cuv, _ = _looked_up(docs, told, "kept", shift)
        p3, p2, p1 = _bins(c3 / np.maximum(cuv, 1)), _bins(c2 / np.maximum(cv, 1)), _bins(c1 / max(n_kept, 1))
        code, n = np.unique(((context(cuv, cv) * BINS + p3) * BINS + p2) * BINS + p1, return_counts=True)
        return pd.DataFrame({"bucket": code // BINS**3, "p3": code // BINS**2 % BINS, "p2": code // BINS % BINS, "p1": code % BINS, "n": n})

    return run


def learn_bucket(own: pd.DataFrame, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights of triple, pair, word and uniform probability of one context, by expectation-maximisation."""
    value = np.concatenate(([0.0], 2.0 ** (-(np.arange(BINS - 1) + 0.5) / PER_OCTAVE)))
    p = np.stack([value[own["p3"]], value[own["p2"]], value[own["p1"]], np.full(len(own), uniform)], 1)
    n = own["n"].to_numpy(float)[:, None]
    w = np.full(4, 1 / 4)
    for _ in range(rounds):
        mixed = p * w
        w = (n * mixed / mixed.sum(1, keepdims=True)).sum(0) / n.sum()
    w = np.maximum(w, [0, 0, 0, 1e-6])
    return w / w.sum()


def learn_weights(tally: DataFrame, uniform: float) -> np.ndarray:
    """Weights by context; contexts without counts back off to words. tally: bucket, p3, p2, p1 (bins), n.

    Each context is learnt in a task of its own, from BINS^3 rows at most; the driver
    gets a row per context.
    """
    def run(own: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [int(own["bucket"].iloc[0])], "w": [learn_bucket(own, uniform).tolist()]})

    weights = np.tile([0.0, 0.0, 0.8, 0.2], (2 * BUCKETS, 1))
    for r in tally.groupBy("bucket").applyInPandas(run, "bucket long, w array<double>").collect():
        weights[r.bucket] = r.w
    return weights


def _scorer(v: int, n_all: int, weights: np.ndarray, shift: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame()
        c1, c2, c3, cv, cuv, bounds = _looked_up(docs, told, "total", shift)
        w = weights[context(cuv, cv)]
        p = w[:, 0] * c3 / np.maximum(cuv, 1) + w[:, 1] * c2 / np.maximum(cv, 1) + w[:, 2] * c1 / max(n_all, 1) + w[:, 3] / (v + 1)
        base = np.log10((c1 + ALPHA) / (n_all + ALPHA * (v + 1)))
        at = bounds[:-1]
        return pd.DataFrame({
            "doc_id": docs["doc_id"].to_numpy(), "held_out": ~docs["train"].to_numpy(bool), "n_tokens": np.diff(bounds),
            "n_known": np.add.reduceat((c1 > 0).astype(np.int64), at), "train_tokens": np.full(len(docs), n_all, np.int64),
            "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(np.log10(p), at),
        })

    return run


def score(documents: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of documents.

    Null texts are empty and have their end token only. Repeated rows count and
    are scored each by itself; an empty table gives no rows; other columns are
    ignored. Sums over tokens are in text order.
    """
    bounded_batches(documents.sparkSession)
    try:
        documents.select("_metadata.row_index").schema
    except AnalysisException:  # not read from files: written once, so that rows have a place
        documents = materialise(documents.select("doc_id", "text"), "lm-documents")
    rows, size = documents.select(F.count("*"), F.sum(F.octet_length("text"))).first()
    ranges, shift = max(1, -(-(size or 0) // part_bytes)), shift_of(size or 0)
    docs = dealt(documents, max(1, rows // ranges), part_bytes)
    told = _told(docs, ranges, shift)
    sums = told.where("part = -1").mapInPandas(_totals, "v long, n long, v_kept long, n_kept long")
    v, n_all, v_kept, n_kept = (int(x or 0) for x in sums.agg(*[F.sum(c) for c in sums.columns]).first())
    told = told.where("part >= 0")
    chosen = F.col("part") % 2 == 1
    tally = docs.where(chosen).groupBy("part").cogroup(told.where(chosen).groupBy("part")).applyInPandas(_tally(n_kept, shift), "bucket long, p3 long, p2 long, p1 long, n long")
    weights = learn_weights(tally.groupBy("bucket", "p3", "p2", "p1").agg(F.sum("n").alias("n")), 1 / (v_kept + 1))
    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = docs.groupBy("part").cogroup(told.groupBy("part")).applyInPandas(_scorer(v, n_all, weights, shift), schema)
    return scored.withColumn("doc_id", F.col("doc_id").cast(dict(documents.dtypes)["doc_id"]))
