"""Fill-in-the-middle, vector codes and substring dedup by brute force, with odd input."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm import fill_middle, substring_dedup, vector_codes
from llm._fm_index import FMIndex
from test_odd_input import CLASHING, odd_docs
from test_operators import corpus

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def plain_fim(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n, hexes = len(tokens), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(hexes[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return doc_id, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


def test_fill_in_middle_by_brute_force(spark):
    texts = corpus(60) + ["<", "<S", "a <", "<P", "x <P> y", "<M>", " \t x y   é𝄞 z  \n", "\x0b\x0c\r", "<<< <P<S<M " * 20, " " * 30_000, "x " * 40_000, "y" * 200_000]
    rows = [(None if k % 9 == 4 else k, t, "s") for k, t in enumerate(texts)] * 2
    got = fill_middle.digests(fill_middle.fill_in_middle(odd_docs(spark, rows)))
    assert Counter(map(tuple, got.collect())) == Counter(plain_fim(i, t) for i, t, _ in rows)
    assert {r.form for r in got.collect()} == {"plain", "spm", "psm"}
    assert fill_middle.digests(fill_middle.fill_in_middle(odd_docs(spark, []))).count() == 0


def test_fill_in_middle_parameters_and_round_trip(spark):
    rows = [(k, t, "s") for k, t in enumerate(corpus(40))]
    d = odd_docs(spark, rows)
    for rate, first in ((0, 80), (100, 0), (100, 100)):
        made = fill_middle.fill_in_middle(d, seed=7, rate=rate, suffix_first=first).collect()
        forms = {r.form for r in made if r.output and not any(s in r.output[3:] for s in ("<X>",)) and r.n}
        assert forms == ({"plain"} if rate == 0 else {"psm"} if first == 0 else {"spm"})
        assert {(r.doc_id, fill_middle.restore_text(r.output, r.form)) for r in made} == {(i, t or "") for i, t, _ in rows}


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label), in the order of ids. Every entry is looked at."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[list(cut(v, p)) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((far(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for _, v, _ in kept:
                of[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for e, xs in of.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, by_label = [], Counter()
    for i, v, lab in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    digest = sha(",".join(str(c) for b in books for entry in b for c in entry))
    return Counter((i, code, error, by_label[lab], digest) for i, code, error, lab in out)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, lab, "c", "s", 1) for i, v, lab in rows], f"vec_id long, embedding array<{kind}>, label int, code string, key string, v int")


def random_rows(n, dims, seed, scale=0.3, ties=False):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.integers(-2, 3, dims) / 256 if ties else rng.normal(0, scale, dims).astype(np.float32)
        rows.append((i * 3, [float(x) for x in v], None if i % 5 == 0 else int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("n,dims,scale,ties", [(150, 32, 0.3, False), (130, 16, 0.3, True), (30, 32, 0.3, False), (90, 16, 3e5, False)])
def test_vector_codes_by_brute_force(spark, n, dims, scale, ties):
    rows = random_rows(n, dims, n, scale, ties)
    rows[4] = (rows[4][0], None, 1)
    rows[5] = (rows[5][0], [None] + rows[5][1][1:], 1)
    rows[6] = (rows[6][0], rows[6][1][:-1] + [float("nan")], 1)
    rows[7] = (rows[7][0], [float("-inf")] + rows[7][1][1:], 2)
    rows[8] = (rows[8][0], [], 2)
    rows += [(None, rows[20][1], None)] + [(10**6, rows[21][1], 2)] * 3
    want = plain_codes([r for r in rows if r[0] is not None] + [r for r in rows if r[0] is None])
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    got = vector_codes.compress(vectors(spark, shuffled).repartition(3)).collect()
    assert Counter(map(tuple, got)) == want


def test_vector_codes_odd_tables(spark):
    assert vector_codes.compress(vectors(spark, [])).count() == 0
    assert vector_codes.compress(vectors(spark, [(1, None, 1), (2, [], 1)])).count() == 0
    rows = [(2, [1.0] * 16, 1), (1, [0.5] * 32, 1), (3, [0.25] * 15, 1), (4, [2.0] * 32, None), (5, [1e30] * 32, 1)]
    assert {r.vec_id for r in vector_codes.compress(vectors(spark, rows)).collect()} == {1, 4}
    huge = [(i, [(-1.0) ** i * 1e15] * 16, 1) for i in range(40)] + [(99, [3e15] * 16, 1)]
    got = vector_codes.compress(vectors(spark, huge, "double"), entries=1).collect()
    assert len(got) == 41 and all(r.error is None and r.label_error is None for r in got)


def test_exponion_search_is_exact():
    rng = np.random.default_rng(5)
    for size in (1, 2, 7, 64):
        points, entries = rng.integers(-9, 9, (400, 3)), rng.integers(-9, 9, (size, 3))
        far = ((points[:, None] - entries[None]) ** 2).sum(2)
        for start in (np.zeros(400, np.int64), rng.integers(0, size, 400)):
            found, best = vector_codes.nearest(points, entries, start)
            assert (found == far.argmin(1)).all() and (best == far.min(1)).all()


def test_codes_decode(spark):
    rows = random_rows(80, 32, 1)
    state, books = vector_codes.learn(vectors(spark, rows))
    codes = state.selectExpr("key", "lower(hex(code)) AS code")
    near = {r.key: r.vector for r in vector_codes.decode(codes, books).collect()}
    assert len(near) == 80 and np.mean([np.square(np.subtract(near[i], v)).mean() for i, v, _ in rows]) < 0.02


def plain_removed(rows, width):
    """rows: (order, doc_id, text), in order."""
    seen, out = set(), []
    for _, doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return Counter(out)


def passages(n, seed, width, vocabulary):
    """Random texts that share passages, copies, lines in changing surroundings, one word many times."""
    rng = np.random.default_rng(seed)
    pick = lambda k: [f"W{rng.integers(vocabulary)}" for _ in range(k)]
    shared, line = [pick(int(rng.integers(width - 1, 3 * width))) for _ in range(6)], pick(max(3, width // 2))
    texts = []
    for i in range(n):
        words = pick(int(rng.integers(0, 4 * width)))
        if i % 3 == 0:
            words += shared[int(rng.integers(6))] + pick(2)
        if i % 2 == 0:
            words += line + pick(width)
        texts.append(rng.choice([" ", "\n", "\t  "]).join(words))
    texts += [texts[3], texts[3].lower(), texts[6], None, "", " \n", "w " * 300, "w " * 90 + "v", " ".join(shared[0] * 3), "a b " * 60]
    return texts


@pytest.mark.parametrize("width,anchor,most,hot", [(20, 5, 2000, 1000), (6, 3, 3, 1000), (6, 3, 3, 20), (6, 2, 2000, 20), (5, 5, 2, 20), (7, 1, 2000, 1000)])
def test_substring_dedup_by_brute_force(spark, monkeypatch, width, anchor, most, hot):
    monkeypatch.setattr(substring_dedup, "HOT_KEYS", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 500)
    texts = passages(60, width + anchor, width, 400 if width > 10 else 30)
    got = substring_dedup.remove_repeats(odd_docs(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(5), width=width, anchor=anchor, most=most)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()) == plain_removed([(i, i, t) for i, t in enumerate(texts)], width)
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in got.collect())


def test_substring_dedup_odd_ids(spark):
    texts = passages(20, 3, 6, 40)
    rows = [(None if k % 4 == 1 else k // 2, t, "s") for k, t in enumerate(texts)]
    rows += [rows[0]] * 4 + [(None, texts[0], "s")] * 25 + [(-5, texts[2], "s")]
    d = odd_docs(spark, rows)
    tie = {r.text: r.h for r in d.selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()}
    order = sorted((i is None, i or 0, tie[t or ""], k) for k, (i, t, _) in enumerate(rows))
    want = plain_removed([(o, rows[o[3]][0], rows[o[3]][1]) for o in order], 6)
    for most in (2000, 1):
        got = substring_dedup.remove_repeats(d, width=6, anchor=2, most=most).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in got) == want
    assert substring_dedup.remove_repeats(odd_docs(spark, [])).count() == 0
    assert set(CLASHING) <= set(d.columns)


def test_fm_index_by_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(60):
        top, width = int(rng.integers(1, 6)), int(rng.integers(1, 6))
        texts = [rng.integers(1, top + 1, int(rng.integers(1, 30))) for _ in range(int(rng.integers(1, 6)))]
        patterns = [rng.integers(0, top + 3, int(rng.integers(0, 30))) for _ in range(4)] + [texts[0]]
        index = FMIndex(texts, width)
        for p, (lengths, places) in zip(patterns, index.matching_statistics(patterns)):
            for i in range(len(p)):
                best, place = 0, -1
                for text, start in zip(texts, index.starts):
                    for j in range(len(text)):
                        k = 0
                        while k < width and i + k < len(p) and j + k < len(text) and p[i + k] == text[j + k]:
                            k += 1
                        best = max(best, k)
                        if k == width and place < 0:
                            place = start + j
                assert (lengths[i], places[i]) == (best, place)
