"""Odd input: null and repeated ids, repeated rows, ties, names that clash with the operators' own, hot keys."""

import re
from collections import Counter, defaultdict

import pytest

from llm import _common, exact_dedup, mixing, near_dedup
from test_operators import brute_components, corpus, words

#: Extra columns with names that the operators use inside.
CLASHING = ["_row", "_doc_id", "_p", "_s", "_gone", "node", "root", "s", "s_null", "own", "cut", "epochs", "text_key", "rows", "stays", "score", "p", "features", "_part", "times"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING) + ", m map<string,string>"


def odd_docs(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *CLASHING, {"k": "v"}) for i, t, s in rows], SCHEMA)


def odd_rows():
    texts = corpus(40)
    rows = [(None if k % 7 == 3 else k, t, None if k % 5 == 0 else f"s{k % 3}") for k, t in enumerate(texts)]
    return rows + rows[:9] + [(None, texts[0], "s1"), (None, None, None), (5, "another text of five", "s1"), (5, "and one more text here", "s2")]


@pytest.fixture(params=[200_000, 0], ids=["few", "shuffled"])
def broadcast_rows(request, monkeypatch):
    """With 0 no table counts as small: hot keys, dealt parts and shuffles do the joins."""
    monkeypatch.setattr(_common, "BROADCAST_ROWS", request.param)
    if not request.param:
        monkeypatch.setattr(_common, "HOT_KEYS", 20)


def plain(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_exact_dedup(spark, broadcast_rows):
    rows = odd_rows()
    d = odd_docs(spark, rows)
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i or 0))
    want = Counter((i, min(groups[n])[2] if not min(groups[n])[1] else None, len(groups[n])) for i, n in ((i, re.sub("[\x20\x09-\x0d]", "", t or "")) for i, t, _ in rows))
    for digest in (exact_dedup._sha256, lambda b: exact_dedup.F.length(b)):  # the second gives many blocks one digest
        got = exact_dedup.dedup(d, block=512, digest=digest).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    kept = exact_dedup.keep_one(d)
    assert kept.columns == d.columns and kept.schema == d.schema
    assert Counter(re.sub("[\x20\x09-\x0d]", "", t or "") for (_, t, _), n in plain(kept).items() for _ in range(n)) == Counter(groups.keys())
    assert exact_dedup.keep_one(d.limit(0)).count() == 0


def test_near_dedup(spark, broadcast_rows):
    rows = odd_rows()
    d = odd_docs(spark, rows)
    sets, root = brute_components([t for _, t, _ in rows], 2)
    first = {}
    for r, (i, _, _) in zip(root, rows):
        first[r] = min((x for x in (first.get(r), i) if x is not None), default=None)
    want = Counter((i, len(s), first[r] if s else i, i == first[r] if s else True) for (i, _, _), s, r in zip(rows, sets, root))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.link(d, width=2).collect()) == want
    kept = near_dedup.keep_one(d, width=2)
    assert kept.columns == d.columns
    of_text = {t: r for (_, t, _), r in zip(rows, root)}
    got = plain(kept)
    assert Counter(of_text[t] for (_, t, _), n in got.items() for _ in range(n) if words(t)) == Counter({r for r, s in zip(root, sets) if s})
    assert sum(n for (_, t, _), n in got.items() if not words(t)) == sum(not s for s in sets)
    assert near_dedup.keep_one(d.limit(0)).count() == 0


def test_mixing(spark, broadcast_rows, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 2)
    rows = odd_rows() + [(None, "one two three", "s0")] * 300
    d = odd_docs(spark, rows)
    got = mixing.mix(d).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, len(words(t))) for i, t, s in rows)
    taken, target = Counter(), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 1 for s in target)
    out = mixing.repeat(d)
    assert out.columns == d.columns and not plain(out) - Counter({k: 2 * n for k, n in plain(d).items()})
    assert mixing.repeat(d.limit(0)).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_join_is_bounded_in_bytes(spark, monkeypatch, tmp_path, how):
    """Few rows with long strings are not broadcast whole; a hot row that is too wide is shuffled like the others."""
    monkeypatch.setattr(_common, "BROADCAST_BYTES", 2000)
    monkeypatch.setattr(_common, "HOT_KEYS", 4)
    rows = spark.createDataFrame([(k, i) for k, n in ((1, 40), (2, 40), (3, 3), (4, 1)) for i in range(n)], "k long, i long")
    spark.createDataFrame([(1, 40, "short"), (2, 40, "w" * 1500), (3, 3, "x" * 900)], "k long, size long, s string").write.parquet(str(tmp_path / "g"))
    groups = spark.read.parquet(str(tmp_path / "g"))
    joined = _common.hot_join(rows, groups, ["k"], "size", how)
    assert Counter(joined.collect()) == Counter(rows.join(groups, "k", how).collect())
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2
    assert _common.hot_join(rows, groups, ["k"], "size", how, total=84)._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 1
