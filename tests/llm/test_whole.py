"""The queries' SQL on the given tables, the pipeline by brute force, the language model's score, secrets with planted labels, odd input of the other operators."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from llm import chat_format, lm_score, media, queries, secret_scan, sentencepiece_codec, toxicity, url_filter
from test_odd_input import CLASHING, odd_docs, odd_rows
from test_operators import brute_components, corpus, docs, words

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@needs_data
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in found.description]
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert Counter(tuple(plain(r[n]) for n in names) for r in df.collect()) == Counter(tuple(map(plain, r)) for r in found.fetchall())


@needs_data
def test_pipeline_by_brute_force(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "sentencepiece"]
    x = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = x.columns, []
    for name, stage in corpus_pipeline.STAGES:
        y = stage(spark, x, DATA)
        assert name == "sentencepiece" or y.columns == columns
        seen.append([r.asDict() for r in y.collect()])
        x = y if name == "sentencepiece" else spark.createDataFrame([tuple(r[c] for c in columns) for r in seen[-1]], x.schema)
    toxic, exact, near, mixed, encoded = seen
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in toxic}
    assert sum(labels[i] == 0 and i not in kept for i in labels) <= 0.05 * len(labels)
    bare = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    assert Counter(bare(r["text"]) for r in exact) == Counter({bare(r["text"]) for r in toxic})
    _, root = brute_components([r["text"] for r in exact], 5)
    ids = [r["doc_id"] for r in exact]
    first = {}
    for i, r in zip(ids, root):
        first[r] = min(first.get(r, i), i)
    assert sorted(r["doc_id"] for r in near) == sorted(first.values())
    size = {r["doc_id"]: len(words(r["text"])) for r in near}
    times = Counter(r["doc_id"] for r in mixed)
    assert all(n <= 2 for n in times.values()) and set(times) <= set(size)
    assert abs(sum(size[i] * n for i, n in times.items()) - 1.5 * sum(size.values())) < 0.1 * sum(size.values())
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_codec.model_path())
    text = {r["doc_id"]: r["text"] for r in near}
    assert len(encoded) == len(mixed) and all(r["restored"] for r in encoded)
    assert all(r["token_ids"] == lib.encode(text[r["doc_id"]]) for r in encoded if "▁" not in text[r["doc_id"]])


def test_lm_score_by_brute_force(spark, monkeypatch):
    """The interpolated score of every text, with weights that differ by context."""
    rng = np.random.default_rng(3)
    weights = rng.dirichlet(np.ones(4), 2 * lm_score.BUCKETS)
    monkeypatch.setattr(lm_score, "learn_weights", lambda tally, uniform: weights)
    texts = corpus(120)
    c1, c2, c3, ctx = Counter(), Counter(), Counter(), Counter()
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    for t, h in zip(texts, held):
        if not h:
            w = ["<s>", "<s>", *words(t), "</s>"]
            c1.update(w[2:])
            ctx.update(w[1:])
            c2.update(zip(w, w[1:]))
            c3.update(zip(w, w[1:], w[2:]))
    n, v = sum(c1.values()), len(c1)
    got = {r.doc_id: r.score for r in lm_score.score(docs(spark, texts), part_bytes=2000).collect()}
    row = lambda c: min(int(math.log2(c)) + 1, lm_score.BUCKETS - 1) if c else 0
    for i, t in enumerate(texts):
        w, want = ["<s>", "<s>", *words(t), "</s>"], 0.0
        for u, a, b in zip(w, w[1:], w[2:]):
            k = lm_score.BUCKETS + row(c2[u, a]) if c2[u, a] else row(ctx[a])
            want += math.log10(weights[k] @ [c3[u, a, b] / max(c2[u, a], 1), c2[a, b] / max(ctx[a], 1), c1[b] / n, 1 / (v + 1)])
        assert got[i] == pytest.approx(want, rel=1e-9), i


def test_weights_by_plain_expectation_maximisation(spark):
    rng = np.random.default_rng(4)
    p3, p2 = rng.choice([0, 1, 0.5, 0.01], 4000), rng.choice([0, 1, 0.5, 0.25, 1 / 3, 0.01], 4000)
    p1, uniform = rng.uniform(1e-6, 0.05, 4000), 1e-5
    w = np.full(4, 1 / 4)
    for _ in range(60):
        m = np.stack([p3, p2, p1, np.full(4000, uniform)], 1) * w
        w = (m / m.sum(1, keepdims=True)).mean(0)
    code, n = np.unique(np.stack([lm_score._bins(p) for p in (p3, p2, p1)]), axis=1, return_counts=True)
    tally = pd.DataFrame({"bucket": 30, "p3": code[0], "p2": code[1], "p1": code[2], "n": n})
    assert np.abs(lm_score.learn_bucket(tally, uniform) - w).max() < 0.03
    got = lm_score.learn_weights(spark.createDataFrame(tally), uniform)
    assert np.abs(got[30] - w).max() < 0.03 and np.allclose(got.sum(1), 1) and (got[29] == [0, 0, 0.8, 0.2]).all()


def test_lm_score_with_a_level_between(spark, tmp_path, monkeypatch):
    """The same scores, and fewer blocks: parts times slices and groups times ranges."""
    docs(spark, corpus(200)).write.parquet(str(tmp_path / "d"))
    d, blocks = spark.read.parquet(str(tmp_path / "d")), []
    counter = lm_score._counter
    monkeypatch.setattr(lm_score, "_counter", lambda ranges, shift: blocks.append(ranges) or counter(ranges, shift))
    one = {r.doc_id: tuple(r) for r in lm_score.score(d, part_bytes=400).collect()}
    monkeypatch.setattr(lm_score, "MOST_RANGES", 4)
    two = {r.doc_id: tuple(r) for r in lm_score.score(d, part_bytes=400).collect()}
    assert one == two and blocks[1] ** 2 < 2 * blocks[0] + 30 and blocks[0] > 60


def test_packed_keys():
    rng = np.random.default_rng(5)
    for shift in (1, 7, 24):
        keys = np.unique(np.concatenate((lm_score._unigram_key(rng.integers(0, 2**63, 50).astype(np.uint64)), lm_score._longer_key(rng.integers(0, 2**63, 80).astype(np.uint64) * np.uint64(2), shift))))
        assert (lm_score.unpack_keys(lm_score.pack_keys(keys, shift), shift) == keys).all()
    assert [lm_score.shift_of(n) for n in (0, 1 << 30, 1 << 60)] == [24, 13, 1]


def plain_prefixed(text):
    """Known prefixes and long runs by hand: where each begins, by its own borders."""
    out, i = [], 0
    alnum = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    while i < len(text):
        if i == 0 or text[i - 1] not in alnum:
            for head, body, least, most in (("AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 16, 16), ("ghp_", alnum, 36, 36)):
                j = i + len(head)
                while text.startswith(head, i) and j < len(text) and text[j] in body and j - i - len(head) < most:
                    j += 1
                if text.startswith(head, i) and j - i - len(head) >= least and (j == len(text) or text[j] not in alnum):
                    out.append(text[i:j])
                    i = j - 1
                    break
        i += 1
    return out


def test_secret_candidates_by_brute_force(spark):
    rng = np.random.default_rng(7)
    keys = ["AKIA" + "".join(rng.choice(list("ABCDEFGHIJ234567"), 16)) for _ in range(40)] + ["ghp_" + "".join(rng.choice(list("abcXYZ0189"), 36)) for _ in range(40)]
    borders = ["", ",", ";", "{", ">", "(", " ", "\n", "\"", ":", "|", "é", ". "]
    texts = [f"{a}{k}{b}" for k in keys for a, b in [(rng.choice(borders), rng.choice(borders))]] + [k[:-1] for k in keys[:5]] + ["x" + keys[0], keys[0] + "9"]
    texts += ["; ".join(keys[i : i + 5]) for i in range(0, 75, 5)] + [f"token=>{k}" for k in keys[:6]]
    got = {}
    for r in secret_scan.candidates(docs(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.i, r.secret))
    for i, t in enumerate(texts):
        want = plain_prefixed(t)
        found = [s for _, s in sorted(got.get(i, []))]
        assert [s for s in found if s in want] == want, (t, found)


def test_secret_forest_removes_false_findings(spark):
    """Planted values, labelled as they are made and not by the patterns that know formats: half of them train, the other half is judged."""
    rng = np.random.default_rng(11)
    pick = lambda a, n: "".join(rng.choice(list(a), n))
    good = [lambda: f'sign_with("{pick("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOP0123456789", 32)}")', lambda: f"auth {pick('ABCDEFGHabcdefgh0123456789+/', 40)}=", lambda: f"dsn {pick('abcdef0123456789', 20)}-{pick('abcdef0123456789', 12)}"]
    bad = [lambda: f"see /docs/page-{rng.integers(10**6)}/index-of-examples", lambda: f"order 2024-{rng.integers(10**12):012d}-00", lambda: f"image_file_name_{rng.integers(10**4)}_version", lambda: f"IMG_2024{rng.integers(10**10):010d}"]
    rows = [(str(rng.choice(good)() if y else rng.choice(bad)()), int(y)) for y in rng.integers(0, 2, 800)]
    found = secret_scan.candidates(docs(spark, [t for t, _ in rows]))
    label = spark.createDataFrame([(i, float(y)) for i, (_, y) in enumerate(rows)], "doc_id long, label double")
    findings = found.join(label, "doc_id").where("doc_id < 400").select("word", "mark", "secret", "label")
    judged = {}
    for r in secret_scan.scan(docs(spark, [t for t, _ in rows]), findings).collect():
        judged[r.doc_id] = judged.get(r.doc_id, False) or r.is_secret
    hits = [(judged.get(i, False), bool(y)) for i, (_, y) in enumerate(rows) if i >= 400]
    right = sum(a and b for a, b in hits)
    assert right / max(1, sum(a for a, _ in hits)) > 0.95 and right / sum(b for _, b in hits) > 0.95


def test_odd_rows_of_the_other_operators(spark):
    """Null, repeated and missing ids, null and empty texts, clashing names: as many rows as went in, equal ones for equal rows; none for none."""
    rows = odd_rows()
    d = odd_docs(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 1)) for i in range(40)] + [(None, 1, 1), (3, None, None), (1, 1, 1)], "doc_id long, quality int, toxic int")
    count = Counter(i for i, _, _ in rows)
    for run in (lambda x: toxicity.score_toxicity(x, labels), lm_score.score, sentencepiece_codec.round_trip, media.media_columns):
        got = run(d).collect()
        assert Counter(r.doc_id for r in got) == count
        assert run(d.limit(0)).count() == 0
    kept = toxicity.drop_toxic(d, labels)
    assert kept.columns == d.columns and kept.count() <= len(rows)
    assert toxicity.drop_toxic(d, labels.limit(0)).count() == len(rows)
    long = "token=\"" + "ab12" * 5000 + "\" " + "word " * 50_000
    secrets = secret_scan.per_document(odd_docs(spark, [(None, "password='hunter2pass'", "s"), (None, None, None), (1, "", "s"), (2, long, "s"), (2, long, "s")]))
    assert {(r.doc_id, r.n_secrets) for r in secrets.collect()} == {(None, 1), (2, 2)}
    urls = spark.createDataFrame([(None, None, *CLASHING), (1, "", *CLASHING), (1, "https://q.net/" + "a/" * 3000, *CLASHING), (2, "https://Q.net/x?" + "y" * 100_000, *CLASHING), (2, "https://Q.net/x?" + "y" * 100_000, *CLASHING)], "page_id long, url string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    got = url_filter.judge(urls).collect()
    assert Counter(r.page_id for r in got) == {None: 1, 1: 2, 2: 2} and len({(r.host, r.path, r.verdict) for r in got if r.page_id == 2}) == 1
    assert url_filter.judge(urls.limit(0)).count() == 0


def test_chat_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c"), (1, 0, "assistant", "c"), (1, None, "assistant", "n"), (None, 0, "user", None), (None, 1, None, "x"), (2, 0, "user", "long " * 50_000)]
    table = spark.createDataFrame([(*r, *CLASHING) for r in rows], "conv_id long, turn long, role string, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_chats(chat_format.log_of(table))).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {1: 5, None: 2, 2: 1}
    order = [("assistant", "n"), ("assistant", "c"), ("assistant", "c"), ("user", "a"), ("user", "b")]
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in order).encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (3, hashlib.sha256(b"ncc").hexdigest()) and got[None].loss_chars == 0
