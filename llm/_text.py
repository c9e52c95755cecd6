"""Vectorised word hashing shared by the word-based operators.

A batch of texts is handled as one UTF-8 buffer: a prefix polynomial hash over
the bytes gives the 64-bit hash of every word with a few numpy passes, so no
per-word Python object is made.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Words are the runs of characters outside this class (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text hashed in one numpy pass; larger texts form a pass of their own.
CHUNK_BYTES = 1 << 20

_UPPER = bytes(range(65, 91))
LOWER_ASCII = bytes.maketrans(_UPPER, _UPPER.lower())
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_R = np.uint64(0x9E3779B97F4A7C15 | 1)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64, so that distinct inputs stay distinct."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i modulo 2^64 for i below at least n."""
    size = max(CHUNK_BYTES, 1 << (n - 1).bit_length()) if n else CHUNK_BYTES
    if size not in _powers:
        up, down = np.full(size, _R, np.uint64), np.full(size, _R_INV, np.uint64)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            table = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size > CHUNK_BYTES:  # a rare long text: not kept
            return table
        _powers[size] = table
    return _powers[size]


class RangeHasher:
    """64-bit hashes of slices of an array; equal slices hash alike."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[ends] - self.prefix[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[start:end] for each pair of bounds; equal slices hash alike."""
    return RangeHasher(values)(starts, ends)


def _hash_chunk(texts: list[bytes], fold: bytes | None = LOWER_ASCII) -> tuple[np.ndarray, np.ndarray]:
    joined = b" ".join(texts)
    data = np.frombuffer(joined.translate(fold), np.uint8)
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~_SPACE[data]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(starts, begin))
    return range_hashes(data, starts, ends), counts


def word_hashes(texts: Iterable[str | None], fold: bytes | None = LOWER_ASCII) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts (A-Z lower-cased; as they are if fold is None), in order, and the bounds of each text's words.

    Null and empty texts have no words. bounds has one entry more than texts.
    """
    hashes, counts, batch, size = [], [], [], 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        if batch and size + len(raw) > CHUNK_BYTES:
            for out, x in zip((hashes, counts), _hash_chunk(batch, fold)):
                out.append(x)
            batch, size = [], 0
        batch.append(raw)
        size += len(raw) + 1
    if batch:
        for out, x in zip((hashes, counts), _hash_chunk(batch, fold)):
            out.append(x)
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(hashes), np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int64)


def shingle_sets(texts: Iterable[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's runs of `width` words, and their bounds by text.

    A text with fewer words has its whole sequence as its one shingle; one without words has none.
    """
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    if not len(words):
        return words, np.zeros(len(counts) + 1, np.int64)
    starts_at = np.arange(len(words))
    owner = np.repeat(np.arange(len(counts)), counts)
    left = bounds[1:][owner] - starts_at
    first = (left >= width) | ((starts_at == bounds[:-1][owner]))
    at, who = starts_at[first], owner[first]
    length = np.minimum(left[first], width)
    rolled = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = length > k
        rolled[inside] = mix64(rolled[inside] * np.uint64(0xD6E8FEB86659FD93) + words[at[inside] + k] + np.uint64(k + 1))
    order = np.lexsort((rolled, who))
    who, rolled = who[order], rolled[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (who[1:] != who[:-1])
    return rolled[new], np.concatenate(([0], np.cumsum(np.bincount(who[new], minlength=len(counts))))).astype(np.int64)


def slices(batches: Iterator, most_bytes: int = 8 << 20) -> Iterator:
    """Cuts pandas or Arrow batches with a `text` column into pieces of bounded text size."""
    for b in batches:
        size = b["text"].str.len().fillna(0).to_numpy()
        cut = np.concatenate(([0], np.cumsum(size))) // most_bytes
        edges = np.flatnonzero(np.diff(cut)) + 1
        at = 0
        for e in [*edges.tolist(), len(b)]:
            if e > at:
                yield b.iloc[at:e].reset_index(drop=True)
            at = e
