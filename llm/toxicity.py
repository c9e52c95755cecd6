"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learnt too: words and word beginnings that are far more frequent
in toxic documents of the labelled sample. Fitting uses a bounded sample of
labelled rows (SAMPLE_ROWS); every document is scored on its whole text. Labels,
language, source and id are no inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm._common import bounded_batches, in_fold, materialise, packed
from llm._text import slices

#: Labelled rows used for fitting, about: a hash of the id draws them.
SAMPLE_ROWS = 24_000
#: A term of the lexicon is in this share of the distinct toxic texts of the sample at least (and in LEAST_TEXTS), and this much likelier there than elsewhere.
TERM_SHARE, LEAST_TEXTS, TERM_ODDS = 0.01, 4, 12
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 4

SECOND_PERSON = frozenset(
    "you your yours yourself u ur thou du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes tus vosotros".split()
)
_LEET = str.maketrans("013457@$!", "oieastasi")
_WORD = re.compile(r"[^\W\d_]+")
#: What _MIXED cannot do without; it starts with a rare character, so most texts are passed over at once.
_MARKED = re.compile(r"[0-9@$!*]+[^\W\d_]")
_MIXED = re.compile(r"(?<!\S)[\w@$!*.-]*[^\W\d_][0-9@$!*]+[^\W\d_][\w@$!*-]*")
_RUN = re.compile(r"([^\W\d_])\1{3,}")
_SPELT = re.compile(r"(?<!\w)(?:[^\W\d_][.\-_* ]){3,}[^\W\d_](?!\w)")
_SHOUT = re.compile(r"[!?]{2,}")
FEATURES = (
    "log_words", "lexicon_density", "lexicon_hits", "lexicon_kinds", "lexicon_near_you", "you_density", "hidden_lexicon",
    "capitals", "shouted_words", "exclaims", "questions", "other_punctuation", "digits", "repeated_marks", "mixed_words",
    "letter_runs", "spelt_out", "mean_word", "distinct_words",
)


_CAPITAL, _DIGIT, _SEPARATOR = (np.zeros(257, bool) for _ in range(3))
_CAPITAL[[*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] = True
_DIGIT[0x30:0x3A] = True
_SEPARATOR[[ord(c) for c in ".-_* "]] = True
#: Words whose form is kept by one worker.
MOST_KNOWN = 40_000


class Featurizer:
    """The feature vectors of texts under one lexicon. Words are looked at once each; marks are counted over one numpy buffer."""

    def __init__(self, words: frozenset, stems: frozenset):
        self.words, self.stems, self.known = words, stems, {}

    def _hit(self, word: str) -> bool:
        return word in self.words or word[:4] in self.stems or word[:5] in self.stems or word[:6] in self.stems

    def _forms(self, distinct: Iterable[str]) -> None:
        """Keeps each word's lower-case form, whether it is in the lexicon, of the second person, shouted, and its length."""
        if len(self.known) > MOST_KNOWN:
            self.known = {}
        for w in distinct:
            if w not in self.known:
                low = w.lower()
                self.known[w] = (low, self._hit(low), low in SECOND_PERSON, w.isupper(), len(w))

    def __call__(self, text: str | None) -> list[float]:
        """The feature vector of one whole text; a null or empty text gives zeros."""
        if not text:
            return [0.0] * len(FEATURES)
        said = _WORD.findall(text)
        counts = Counter(said)
        self._forms(counts)
        forms = [(*self.known[w], c) for w, c in counts.items()]
        n, size = max(len(said), 1), len(text)
        hits, you = {f[0] for f in forms if f[1]}, {f[0] for f in forms if f[2]}
        n_hits, n_you = (sum(f[5] for f in forms if f[i]) for i in (1, 2))
        near = 0
        if hits and you:
            at, y = (np.array([i for i, w in enumerate(said) if self.known[w][k]]) for k in (1, 2))
            k = np.searchsorted(y, at)
            near = int((np.minimum(np.abs(y[np.minimum(k, len(y) - 1)] - at), np.abs(y[np.maximum(k - 1, 0)] - at)) <= 5).sum())
        points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 256)
        seen = np.bincount(points, minlength=257)
        marks = {c: int(seen[ord(c)]) for c in "!?.,;:*#@$"}
        same, apart = points[1:] == points[:-1], _SEPARATOR[points]
        runs = _RUN.findall(text) if (same[2:] & same[1:-1] & same[:-2]).any() else []
        spelt = _SPELT.findall(text) if (apart[4:] & apart[2:-2] & apart[:-4]).any() else []
        mixed = _MIXED.findall(text) if _MARKED.search(text) else []
        hidden = sum(self._hit(re.sub(r"[^\w]", "", m.lower().translate(_LEET))) for m in mixed)
        hidden += sum(self._hit(re.sub(r"[\W_]", "", m.lower())) for m in spelt)
        if runs:
            hidden += sum(f[5] * self._hit(re.sub(r"(.)\1+", r"\1", f[0])) for f in forms if _RUN.search(f[0]))
        letters = sum(f[4] * f[5] for f in forms)
        return [
            math.log1p(len(said)), n_hits / n, math.log1p(n_hits), float(len(hits)), near / n, n_you / n, float(hidden),
            int(seen[_CAPITAL].sum()) / (letters or 1), sum(f[5] for f in forms if f[3]) / n, marks["!"] / size, marks["?"] / size, sum(marks[c] for c in ".,;:*#@$") / size,
            int(seen[_DIGIT].sum()) / size, float(len(_SHOUT.findall(text)) if marks["!"] + marks["?"] > 1 else 0), len(mixed) / n,
            float(len(runs)), float(len(spelt)), (letters or 1) / n, len({f[0] for f in forms}) / n,
        ]


def _feature_column(words: frozenset, stems: frozenset):
    @F.pandas_udf("array<double>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Featurizer(words, stems)
        for s in texts:
            yield pd.Series([features(t) for t in s])

    return run("text")


def learn_lexicon(sample: DataFrame) -> tuple[frozenset, frozenset]:
    """Words and word beginnings of 4 to 6 letters that mark toxic documents in sample (text, toxic).

    Counted on distinct texts, the totals too. All that pass the tests are taken; the
    sample is bounded, and so is the lexicon.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}
        for b in slices(batches):
            for text, toxic in zip(b["text"], b["toxic"]):
                words = set(_WORD.findall((text or "").lower()))
                terms = {"=" + w for w in words} | {f"^{w[:k]}" for w in words for k in (4, 5, 6) if len(w) > k}
                for t in terms:
                    seen.setdefault(t, [0, 0])[int(toxic)] += 1
            if len(seen) > 500_000:
                yield pd.DataFrame([(t, a, b_) for t, (a, b_) in seen.items()], columns=["term", "clean", "toxic"])
                seen = {}
        yield pd.DataFrame([(t, a, b_) for t, (a, b_) in seen.items()], columns=["term", "clean", "toxic"])

    distinct = sample.groupBy(F.xxhash64("text").alias("_h")).agg(F.min(F.struct("text", "toxic")).alias("r")).select("r.text", "r.toxic")
    n = distinct.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count("*")).first()
    pos, neg = n[0], n[1] - n[0]
    counts = distinct.mapInPandas(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = ((F.col("toxic") + 0.5) / (pos + 1)) / ((F.col("clean") + 0.5) / (neg + 1))
    best = counts.where((F.col("toxic") >= max(LEAST_TEXTS, TERM_SHARE * pos)) & (odds >= TERM_ODDS)).collect()
    return frozenset(r["term"][1:] for r in best if r["term"][0] == "="), frozenset(r["term"][1:] for r in best if r["term"][0] == "^")


def labelled_sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, toxic of about `rows` labelled documents outside the held-out fold, drawn by a hash of the id.

    Several labels of one id count as toxic if any is. The drawn ids are bounded by
    `rows`, so they may be broadcast.
    """
    y = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (in_fold("doc_id", FOLDS) != HELD_OUT))
    total = y.count()
    share = min(1.0, rows / max(total, 1))
    drawn = y.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    drawn = materialise(drawn.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "toxic-labels")
    return materialise(documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id"), "toxic-sample")


class ToxicityModel:
    """A fitted scorer. Where the labels have one class only, every document gets that class's rate."""

    def __init__(self, words=frozenset(), stems=frozenset(), trees=None, isotonic=None, rate=0.0):
        self.words, self.stems, self.trees, self.isotonic, self.rate = words, stems, trees, isotonic, rate

    @classmethod
    def fit(cls, documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
        bounded_batches(documents.sparkSession)
        sample = labelled_sample(documents, labels, rows)
        calibrates = in_fold("doc_id", FOLDS) == CALIBRATION
        seen = {(r["c"], r["toxic"]): r["count"] for r in sample.groupBy(calibrates.alias("c"), "toxic").count().collect()}
        pos, n = sum(v for (_, y), v in seen.items() if y == 1), sum(seen.values())
        if not seen.get((False, 0)) or not seen.get((False, 1)):
            return cls(rate=pos / n if n else 0.0)
        words, stems = learn_lexicon(sample.where(~calibrates))
        x = sample.select(_feature_column(words, stems).alias("f"), F.col("toxic").cast("double").alias("label"), calibrates.alias("c"))
        x = materialise(x, "toxic-features").withColumn("features", array_to_vector("f"))
        trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, seed=7, maxBins=64).fit(x.where("NOT c").coalesce(2))
        model = cls(words, stems, trees)
        if seen.get((True, 0)) and seen.get((True, 1)):
            held = model._raw(x.where("c")).select("label", F.col("p").alias("features"))
            model.isotonic = IsotonicRegression(labelCol="label", featuresCol="features").fit(materialise(held, "toxic-calibration"))
        return model

    def _raw(self, x: DataFrame) -> DataFrame:
        return self.trees.transform(x).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")

    def score(self, documents: DataFrame) -> DataFrame:
        """documents with `score`: 0 to 1, the calibrated chance of the toxic label. Columns of that name are replaced.

        Null and empty texts are scored on zero features, very long ones whole; repeated
        rows get equal scores; an empty table gives no rows; other columns stay as they are.
        """
        docs = documents.drop("score")
        if self.trees is None:
            return docs.withColumn("score", F.lit(float(self.rate)))
        x = packed(docs, text=F.col("text")).select("_row", _feature_column(self.words, self.stems).alias("_f"))
        x = self._raw(x.select("_row", array_to_vector("_f").alias("features")))
        if self.isotonic is None:
            return x.select("_row.*", F.col("p").alias("score"))
        y = self.isotonic.setFeaturesCol("p").setPredictionCol("_iso").transform(x.select("_row", "p"))
        # a thousandth of the trees' own value orders what the steps leave tied
        return y.select("_row.*", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_iso") * 0.999 + F.col("p") * 0.001)).alias("score"))


def score_toxicity(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of documents.

    Null and empty texts are scored on zero features; repeated rows get equal
    scores; an empty table gives no rows; extra columns are ignored.
    """
    scored = ToxicityModel.fit(documents, labels, rows).score(documents.select("doc_id", "text"))
    return scored.select("doc_id", (in_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """documents without the rows scored as toxic, all columns as they are.

    Null and empty texts are scored like any other, on zero features; repeated rows
    stay or go together; without labels of both classes the share of toxic labels is
    every row's score. An empty table gives no rows; names of other columns cannot clash.
    """
    model = ToxicityModel.fit(documents, labels, rows)
    return model.score(packed(documents, text=F.col("text"))).where("score < 0.5").select("_row.*")
