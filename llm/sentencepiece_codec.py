"""SentencePiece encoding and decoding by a Viterbi search in numpy batches.

A text is cut into units before each run of spaces; no piece of a model crosses
such a cut. The distinct units of a batch are segmented together: substrings of
each length are hashed in one pass and probe the sorted keys of the pieces and
their beginnings, longer ones only where a piece may still begin; units advance
together, one character a step, and a vectorised maximum over the lengths of the
last piece stores the backpointers.

What a step is worth depends on the kind of model:

- unigram: the piece's score, added up.
- BPE (the public file is one): scores are merge ranks there, and their best sum is
  not the model's encoding. A step is worth nothing if the piece may follow the
  piece before it, and minus infinity if not: two pieces may be neighbours if no
  merge across their border comes before the merges that made them. Every prefix
  has exactly one last piece of that kind, so the search gives the ids that the
  model's own library gives. Verdicts on pairs are kept in a table of fixed size.

Characters that no piece covers become their UTF-8 byte pieces.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm._common import bounded_batches
from llm._text import RangeHasher, slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: A space run and what follows it.
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Distinct units whose ids are kept for later texts.
MOST_KNOWN = 100_000
#: Bytes of text encoded together, about.
SLICE_BYTES = 512 << 10
#: Slots (a power of two) that keep which pairs of pieces may be neighbours.
PAIR_SLOTS = 20
#: First bits of a hash that tell most substrings which are no piece.
PRESENT = 20
#: Below the worst piece by so much is a character that is no piece.
UNKNOWN_PENALTY = 10.0
_FREE = "\udc81"  # stands for a literal SPACE mark in a text while it is cut; spelt in bytes


def model_path() -> str:
    """The public model file: in $TOKENIZERS_DIR, else where the public_tokenizers package has it, else /opt/tokenizers."""
    if os.environ.get("TOKENIZERS_DIR"):
        return os.path.join(os.environ["TOKENIZERS_DIR"], MODEL)
    try:
        import public_tokenizers

        return public_tokenizers.path(MODEL)
    except ImportError:
        return os.path.join("/opt/tokenizers", MODEL)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """Pieces, scores and sorted piece keys of a model; kind is "bpe" or "unigram"."""

    def __init__(self, pieces: list[str], scores: list[float], normal: list[int], kind: str):
        n = len(pieces)
        self.pieces, self.kind = pieces, kind
        self.bytes_at = np.full(256, -1, np.int32)
        ordinary = set(normal)
        is_byte = [i not in ordinary and len(pieces[i]) == 6 and pieces[i].startswith("<0x") for i in range(n)]
        for i in np.flatnonzero(is_byte):
            self.bytes_at[int(pieces[i][3:5], 16)] = i
        self.score = np.full(n, -np.inf)
        self.score[normal] = [scores[i] for i in normal]
        lengths = np.array([len(pieces[i]) for i in normal])
        self.longest = int(lengths.max())
        self.unknown = float(self.score[normal].min()) - UNKNOWN_PENALTY
        # sorted keys of all beginnings of pieces, with the piece's id where the beginning is one
        hasher, first = RangeHasher(_code_points("".join(pieces[i] for i in normal))), np.cumsum(lengths) - lengths
        begins = [hasher(at, at + k) for k in range(1, self.longest + 1) for at in [first[lengths >= k]]]
        whole = hasher(first, first + lengths)
        self.hashes = np.unique(np.concatenate(begins))
        self.ids = np.full(len(self.hashes), -1, np.int32)
        self.ids[np.searchsorted(self.hashes, whole)] = normal
        assert len(np.unique(whole)) == len(normal), "two pieces share a hash"
        self.present = np.zeros(1 << PRESENT, bool)
        self.present[self.hashes >> np.uint64(64 - PRESENT)] = True
        self.raw = [bytes([int(pieces[i][3:5], 16)]) if is_byte[i] else pieces[i].replace(SPACE, " ").encode("utf-8", "surrogatepass") if i in ordinary else b"" for i in range(n)]
        self.known, self.flat, self.start = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        if kind == "bpe":
            self._index_merges({pieces[i]: (i, scores[i]) for i in normal})

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2

        m = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        normal = [i for i, p in enumerate(m.pieces) if p.type in (m.SentencePiece.NORMAL, m.SentencePiece.USER_DEFINED)]
        kind = "bpe" if m.trainer_spec.model_type == m.trainer_spec.BPE else "unigram"
        return cls([p.piece for p in m.pieces], [p.score for p in m.pieces], normal, kind)

    def _index_merges(self, known: dict[str, tuple[int, float]]) -> None:
        """Pairs of pieces that make a piece, by hash slot; of each piece its rank (best first) and the pair that BPE makes it of."""
        n = len(self.pieces)
        rank = {p: r for r, p in enumerate(sorted(known, key=lambda p: -known[p][1]))}
        pairs = [(known[p[:k]][0], known[p[k:]][0], known[p][0]) for p in known for k in range(1, len(p)) if p[:k] in known and p[k:] in known]
        left, right, made = np.array(pairs or np.zeros((0, 3)), np.int64).T
        self.wide, self.never = n, len(known)
        self.rank = np.full(n, self.never, np.int64)
        self.rank[[known[p][0] for p in known]] = [rank[p] for p in known]
        keys = left * n + right
        self.bits = max(1, len(keys)).bit_length() + 3
        slot = self._slot(keys, self.bits)
        by = np.argsort(slot, kind="stable")
        self.merge_keys, self.rank_of, slot = np.append(keys[by], -1), np.append(self.rank[made[by]], self.never), slot[by]
        self.slot_at = np.searchsorted(slot, np.arange((1 << self.bits) + 1)).astype(np.int32)
        self.chain = int(np.diff(self.slot_at).max(initial=0))
        self.part = np.full((2, n), -1, np.int64)  # the left and right part of each piece of more characters than one
        self.made = np.zeros(n, bool)  # whether merges ever make it
        self.made[[known[p][0] for p in known if len(p) == 1]] = True
        size = np.array([len(p) for p in self.pieces])
        for length in range(2, self.longest + 1):
            at = np.flatnonzero((size[made] == length) & self.made[left] & self.made[right])
            at = at[~self._clash(left[at], right[at], self.rank[made[at]])]
            self.part[:, made[at]], self.made[made[at]] = (left[at], right[at]), True
        self.pair_key = np.full(1 << PAIR_SLOTS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_SLOTS, bool)

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def _merge_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two pieces make, or `never`."""
        keys = left * self.wide + right
        slot = self._slot(keys, self.bits)
        at, end = self.slot_at[slot], self.slot_at[slot + 1]
        out = np.full(len(keys), self.never, np.int64)
        for step in range(self.chain):
            here = np.minimum(at + step, len(self.merge_keys) - 1)
            hit = (at + step < end) & (self.merge_keys[here] == keys)
            out[hit] = self.rank_of[here[hit]]
        return out

    def _clash(self, left: np.ndarray, right: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Whether a merge across the border of two pieces comes before rank `until` and before the merges that made them.

        On the way to the left piece, the symbols at the border are its right part, the
        right part of that and so on; each is there until the merge that takes it in.
        Of equal merges the one further left comes first.
        """
        out = np.zeros(len(left), bool)
        rows, x, x_until = np.arange(len(left)), left, until
        while len(rows):
            inner, y, y_until, xi, xi_until = rows, right[rows], until[rows], x, x_until
            while len(inner):
                rank = self._merge_rank(xi, y)
                out[inner] |= (rank < xi_until) & (rank <= y_until) & (rank < until[inner])
                below = self.part[0, y]
                go = (below >= 0) & ~out[inner]
                inner, y_until, y, xi, xi_until = inner[go], self.rank[y[go]], below[go], xi[go], xi_until[go]
            below = self.part[1, x]
            go = (below >= 0) & ~out[rows]
            rows, x_until, x = rows[go], self.rank[x[go]], below[go]
        return out

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the right piece may follow the left one; a character without a piece (below 0) may stand anywhere."""
        keys = left.astype(np.int64) * self.wide + right
        slot = self._slot(keys, PAIR_SLOTS)
        new = np.flatnonzero((self.pair_key[slot] != keys) & (left >= 0) & (right >= 0))
        out = self.pair_fits[slot]
        if len(new):
            one, at = np.unique(keys[new], return_inverse=True)
            fits = ~self._clash(one // self.wide, one % self.wide, np.full(len(one), self.never, np.int64))
            out[new] = fits[at]
            self.pair_key[slot[new]], self.pair_fits[slot[new]] = -1, False
            kept = self._slot(one, PAIR_SLOTS)
            self.pair_key[kept], self.pair_fits[kept] = one, fits
        return out | (left < 0) | (right < 0)

    def _pieces(self, codes: np.ndarray, unit_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """begin, last (positions) and id of every piece within a unit, and of every single character (-1 where it is no piece)."""
        hasher, at, found = RangeHasher(codes), np.arange(len(codes)), []
        for k in range(self.longest):
            h = hasher(at, at + k + 1)
            near = np.flatnonzero(self.present[h >> np.uint64(64 - PRESENT)])
            where = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
            hit = self.hashes[where] == h[near]
            begins, ids = at[near[hit]], self.ids[where[hit]]
            if k == 0:
                one = np.full(len(codes), -1, np.int32)
                one[begins] = ids
                found.append((at, at, one))
            else:
                whole = ids >= 0 if self.kind == "unigram" else (ids >= 0) & self.made[ids]
                found.append((begins[whole], begins[whole] + k, ids[whole]))
            at = begins[begins + k + 1 < unit_end[begins]]
            if not len(at):
                break
        return tuple(np.concatenate(x) for x in zip(*found))

    def segment(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All units' piece ids in a row, and how many each has; units are distinct and not empty."""
        whole = np.array([len(u) for u in units])
        codes = _code_points("".join(units))
        ends = np.cumsum(whole)
        begin, end, own = self._pieces(codes, np.repeat(ends, whole))
        # no piece crosses the border between two parts of a unit, so each is searched by itself
        inside = np.flatnonzero(end > begin)
        crossed = np.cumsum(np.bincount(begin[inside] + 1, minlength=len(codes) + 1) - np.bincount(end[inside] + 1, minlength=len(codes) + 1))[: len(codes)] > 0
        starts = np.flatnonzero(~crossed)
        back, last = self._search(starts, begin, end, own, len(codes))
        # walk all parts back together
        taken, at, floor = np.zeros(len(codes), bool), np.append(starts[1:], len(codes)) - 1, starts
        while len(at):
            taken[at] = True
            at = at - back[at]
            go = at >= floor
            at, floor = at[go], floor[go]
        at = np.flatnonzero(taken)
        ids = last[at]
        size, lost = np.ones(len(ids), np.int64), ids < 0
        if lost.any():
            spelt = [self._bytes_of(c) for c in codes[at[lost]].tolist()]
            size[lost] = [len(x) for x in spelt]
            ids = np.repeat(ids, size)
            ids[ids < 0] = np.concatenate(spelt)
        return ids, np.bincount(np.repeat(np.arange(len(units)), whole)[at], size, len(units)).astype(np.int64)

    def _search(self, starts: np.ndarray, begin: np.ndarray, end: np.ndarray, own: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Length and id of the last piece of the best segmentation up to each position; all parts advance by one character a step."""
        first = np.zeros(total, np.int64)
        first[starts] = starts
        first = np.maximum.accumulate(first)
        step = end - first[end]
        deepest = int(step.max())
        by = np.argsort(step.astype(np.uint16) if deepest < 1 << 16 else step, kind="stable")
        begin, end, own = begin[by], end[by], own[by]
        cuts = np.concatenate(([0], np.cumsum(np.bincount(step, minlength=deepest + 1))))
        best, last, back = np.full(total, -np.inf), np.zeros(total, np.int32), np.zeros(total, np.int32)
        inner = begin > first[end]
        worth = np.where(own >= 0, self.score[own], self.unknown) if self.kind == "unigram" else np.zeros(len(own))
        for i, j in zip(cuts[:-1], cuts[1:]):
            value, e, behind = worth[i:j].copy(), end[i:j], np.flatnonzero(inner[i:j])
            before = begin[i:j][behind] - 1
            if self.kind == "unigram":
                value[behind] += best[before]
            else:
                value[behind[~self._fits(last[before], own[i:j][behind])]] = -np.inf
            np.maximum.at(best, e, value)
            won = np.flatnonzero((value == best[e]) & (value > -np.inf))[::-1]  # of equal ones the shortest piece
            back[e[won]], last[e[won]] = e[won] - begin[i:j][won] + 1, own[i:j][won]
        return back, last

    def _bytes_of(self, code: int) -> np.ndarray:
        return self.bytes_at[list((SPACE if chr(code) == _FREE else chr(code)).encode("utf-8", "surrogatepass"))]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Piece ids of each whole text; none for null and empty texts. Units seen before are looked up."""
        lines = [_UNIT.findall(SPACE + t.replace(SPACE, _FREE).replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > MOST_KNOWN:
            self.known, self.flat, self.start = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        known, found = self.known.get, []
        for line in lines:
            found.append(np.fromiter(map(known, line, repeat(-1)), np.int64, len(line)))
        open_ = [(i, np.flatnonzero(x < 0)) for i, x in enumerate(found)]
        if new := list({lines[i][k] for i, at in open_ for k in at.tolist()}):
            flat, size = self.segment(new)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.flat = np.concatenate((self.flat, flat))
            self.start = np.concatenate((self.start, self.start[-1] + np.cumsum(size)))
            for i, at in open_:
                found[i][at] = [self.known[lines[i][k]] for k in at.tolist()]
        out = []
        for unit in found:
            begin = self.start[unit]
            size = self.start[unit + 1] - begin
            total = np.cumsum(size)
            out.append(self.flat[np.repeat(begin - total + size, size) + np.arange(total[-1])] if len(unit) else np.zeros(0, np.int32))
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """The texts of id sequences: encode() undone."""
        raw = self.raw
        out = []
        for x in ids:
            text = b"".join([raw[i] for i in x.tolist()]).decode("utf-8", "surrogatepass")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def _encoded(documents: DataFrame, path: str, check: bool) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path)
        for b in slices(batches, SLICE_BYTES):
            texts = ["" if t is None else t for t in b["text"]]
            ids = v.encode(texts)
            out = {"doc_id": b["doc_id"], "n_tokens": [len(x) for x in ids], "token_ids": ids}
            yield pd.DataFrame(out | ({"restored": [x == t for x, t in zip(v.decode(ids), texts)]} if check else {}))

    bounded_batches(documents.sparkSession)
    schema = "doc_id string, n_tokens long, token_ids array<int>" + ", restored boolean" * check
    x = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, schema)
    return x.withColumn("doc_id", F.col("doc_id").cast(dict(documents.dtypes)["doc_id"]))


def decode_column(path: str):
    """A column expression factory: arrays of piece ids to texts; a null array is an empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(path)
        for s in batches:
            yield pd.Series(v.decode([np.zeros(0, np.int32) if x is None else np.asarray(x) for x in s]), dtype=object)

    return run


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, token_ids for every row of documents.

    Null and empty texts have no tokens. Repeated rows are encoded each by
    itself; an empty table gives no rows; other columns are ignored. The file
    must be at `path` on every executor.
    """
    return _encoded(documents, path or model_path(), False)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of encoded documents; a null array is an empty text."""
    return encoded.select("doc_id", decode_column(path or model_path())("token_ids").alias("text"))


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """encode(), with `restored`: whether decoding the ids gives the whole text again."""
    return _encoded(documents, path or model_path(), True)
