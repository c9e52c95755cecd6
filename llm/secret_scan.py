"""Secret scanning with a random forest that removes false findings.

Candidates are passwords in urls, values of any form assigned to a keyword (up to
the closing quote or the space), known prefixes, and runs of at least 16 key
characters with a digit or mixed case, with the word and the mark before them.
The forest sees their length, character transitions, dictionary coverage, path
marks and neighbouring words.

Labelled findings: there is no table of them, so a bounded sample of candidates
is labelled by strict validators of known formats; every other candidate of the
sample counts as a false finding. Such formats are secrets whatever the forest
says, as the sample may hold too few of a rare one. A caller with reviewed
findings passes them instead, and then the forest alone decides. Everything runs
on DataFrame and Spark ML operators.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm._common import materialise

_PREFIXED = r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+"
#: Key characters with a digit or mixed case; parts after dots belong to it, but for known prefixes.
_RUN = (
    r"(?:(?=[A-Za-z+/_-]*+[0-9])|(?=[A-Z+/_-]*+[a-z][a-z+/_-]*+[A-Z]))[A-Za-z0-9+/_-]{16,}+(?:\.(?!" + _PREFIXED + r")[A-Za-z0-9+/_-]++)*+={0,2}"
)
#: A word that holds a keyword, and the mark after it up to the value. Quantifiers are possessive and the keyword is looked for ahead, so a failure costs one pass however long the word.
_ASSIGN = (
    r"((?=[A-Za-z0-9_-]*?(?i:token|pass|pwd|secret|key|auth|cred))[A-Za-z0-9_-]++)"
    r"([\\\x22\x27\]]*+\s*+(?:=>|:=|[=:])\s*+(?:(?i:bearer|basic)\s++)?"
)
#: Forms of a candidate: each has three groups, the word and the mark before it and the candidate. The first that fits at a place holds.
FORMS = (
    r"(?<![A-Za-z0-9+.-])([A-Za-z][A-Za-z0-9+.-]*+)(://[^\s/:@\x22\x27<>]*+:)([^\s/\x22\x27<>]+)@",
    _ASSIGN + r"\\\x22)([^\x22\\\n]*+(?:\\[^\x22\n][^\x22\\\n]*+)*+)\\\x22",
    _ASSIGN + r"\x22)([^\x22\\\n]*+(?:\\.[^\x22\\\n]*+)*+)\x22",
    _ASSIGN + r"\x27)([^\x27\\\n]*+(?:\\.[^\x27\\\n]*+)*+)\x27",
    _ASSIGN + r"\\?[\x22\x27]?)([^\s\x22\x27&;,]++(?:[&;,]++(?![A-Za-z0-9_.-]*+=)[^\s\x22\x27&;,]++)*+)",
    r"(?<![A-Za-z0-9])()()(" + _PREFIXED + ")",
    r"(?<![A-Za-z_])([A-Za-z_]*+)(\s?[=:]\s?[\x22\x27]?|[\s\x22\x27(\[<]|)(?<![A-Za-z0-9+/_-])(" + _RUN + ")",
    r"(?<![A-Za-z0-9+/_-])()()(" + _RUN + ")",
)
#: The four assigned forms share the test that a mark follows the word: prose fails it at once.
CANDIDATE = "|".join([FORMS[0], r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]++[\\\x22\x27\]]*+\s*+[=:])(?:" + "|".join(FORMS[1:5]) + ")", *FORMS[5:]])
#: Word, candidate and mark of a hit on lines of their own: groups of other forms are empty, and only marks may hold line ends.
_LINES = "\n".join("".join(f"${3 * f + k}" for f in range(len(FORMS))) for k in (1, 3, 2))
#: Strict formats, by the word before them where there is one.
VALID = (
    r"^AKIA[0-9A-Z]{16}$",
    r"^gh[pousr]_[A-Za-z0-9]{36}$",
    r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^sk_live_[A-Za-z0-9]{16,}$",
)
ASSIGNED = r"(?i)(?:token|password|passwd|passphrase|pwd|secret|api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key)[0-9]*$"
ASSIGNED_VALUE = r"^(?=.*[a-zA-Z])(?=.*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}$"
#: Other values assigned to such a word: in quotes any word, or any words of a passphrase; without quotes letters with digits or marks.
QUOTED_VALUE = r"^\S{4,}$"
PASSPHRASE, PHRASE = r"(?i)pass_?phrase[0-9]*$", r"^\S.{6,}\S$"
PLAIN_VALUE = r"^(?=.*[A-Za-z])(?=.*[0-9!@#$%^&*~])\S{6,}$"
#: Values that stand for a secret, or code that gets one.
STANDS_FOR = (
    r"(?i)^(?:(.)\1*|none|null|true|false|undefined|changeme|example|placeholder|redacted|required|(?:your|my)[_-].*|<.*>?|\$\{?[A-Z_]+\}?|\{.*\}?|%.*%|pass|password|passwd|secret|token|key)$"
    r"|\w\(|process\.env|os\.environ|://(?![^\s/:@]*:[^\s/]+@)"
)
#: Candidates used for fitting, about, drawn by a hash.
SAMPLE_ROWS = 20_000
KEYWORDS = r"(?i)(?:token|pass|pwd|secret|key|auth|cred|bearer)"
DICTIONARY = (
    "http https www com org net html index page image img file path user name data test example sample docs blog news "
    "version release commit hash uuid order number phone account invoice"
).split()
FEATURES = (
    "length", "lower_to_digit", "digit_to_lower", "upper_to_digit", "digit_to_upper", "case_changes", "digit_share", "upper_share",
    "hex_share", "only_digits", "dictionary", "path_marks", "dashes", "keyword_before", "assigned", "quoted", "word_before", "longest_letters",
    "symbols", "spaces", "url_login",
)


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id, i (order in the text), word, mark, secret: a row per candidate of every whole text, however long it or its values are.

    Null and empty texts have none, repeated rows have theirs each, an empty table gives no rows; other columns are ignored.
    """
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    x = documents.select("doc_id", "text").where(F.col("text").isNotNull()).select("doc_id", F.posexplode(found).alias("i", "hit"))
    parts = F.split(F.regexp_replace("hit", f"(?s)^(?:{CANDIDATE}).*", _LINES), "\n", 3)
    x = x.select("doc_id", "i", parts.alias("p"))
    return x.select("doc_id", "i", F.get("p", F.lit(0)).alias("word"), F.get("p", F.lit(2)).alias("mark"), F.get("p", F.lit(1)).alias("secret")).where("secret <> ''")


def features() -> Column:
    s, n = F.col("secret"), F.length("secret").cast("double")
    count = lambda p: F.regexp_count(s, F.lit(p)).cast("double")
    left = F.regexp_replace(F.lower(s), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")
    return F.array(
        n, count("(?<=[a-z])[0-9]") / n, count("(?<=[0-9])[a-z]") / n, count("(?<=[A-Z])[0-9]") / n, count("(?<=[0-9])[A-Z]") / n,
        count("(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]") / n, count("[0-9]") / n, count("[A-Z]") / n, count("[0-9a-f]") / n,
        s.rlike("^[0-9]+$").cast("double"), 1.0 - F.length(left) / n, count("/") / n, count("[-_]") / n,
        F.col("word").rlike(KEYWORDS).cast("double"), F.col("mark").rlike("[=:]").cast("double"), F.col("mark").rlike(r"[\x22\x27]").cast("double"),
        F.length("word").cast("double"), F.coalesce(F.array_max(F.transform(F.regexp_extract_all(s, F.lit("[A-Za-z]+"), F.lit(0)), F.length)), F.lit(0)).cast("double"),
        count(r"[^A-Za-z0-9\s]") / n, count(r"\s"), F.col("mark").startswith("://").cast("double"),
    )


def is_valid() -> Column:
    known = F.lit(False)
    for p in VALID:
        known = known | F.col("secret").rlike(p)
    word, mark, secret = F.col("word"), F.col("mark"), F.col("secret")
    real = ~secret.rlike(STANDS_FOR)
    quoted = mark.rlike(r"[\x22\x27]$") & (secret.rlike(QUOTED_VALUE) | (word.rlike(PASSPHRASE) & secret.rlike(PHRASE)))
    value = secret.rlike(ASSIGNED_VALUE) | (real & (quoted | secret.rlike(PLAIN_VALUE)))
    return known | (mark.startswith("://") & real) | (word.rlike(ASSIGNED) & mark.rlike("[=:]") & ~mark.startswith("://") & value)


def labelled(found: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample of candidates, equal ones once, labelled by the validators."""
    total = found.count()
    share = min(1.0, rows / max(total, 1))
    drawn = found.where(F.pmod(F.xxhash64("secret", F.lit("sample")), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    return drawn.groupBy("word", "mark", "secret").agg(F.count("*").alias("_n")).withColumn("label", is_valid().cast("double"))


def scan(documents: DataFrame, findings: DataFrame | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, i, word, secret, score, is_secret: a row per candidate. findings: word, mark, secret, label (0 or 1).

    Null and empty texts have no candidates. Without findings, what the validators
    know is a secret, and the forest decides on the rest. Where the labels have one class only,
    the validators decide. An empty table gives no rows.
    """
    found = materialise(candidates(documents), "secret-candidates")
    known = materialise((findings if findings is not None else labelled(found, rows)).select("label", features().alias("f")), "secret-labels")
    classes = {r[0] for r in known.select("label").distinct().limit(3).collect()}
    x = found.select("*", array_to_vector(features()).alias("features"))
    if len(classes) < 2:
        return x.select("doc_id", "i", "word", "secret", is_valid().cast("double").alias("score"), is_valid().alias("is_secret"))
    forest = RandomForestClassifier(numTrees=24, maxDepth=7, seed=11, labelCol="label", featuresCol="features").fit(known.select("label", array_to_vector("f").alias("features")).coalesce(2))
    y = forest.transform(x).withColumn("score", vector_to_array("probability")[1])
    return y.select("doc_id", "i", "word", "secret", "score", ((F.col("score") >= 0.5) | (F.lit(findings is None) & is_valid())).alias("is_secret"))


def per_document(documents: DataFrame) -> DataFrame:
    """doc_id, n_candidates, n_secrets, secrets (in text order) for every id of documents with a candidate.

    Rows that repeat an id, or have none, count as one document; secrets at the same
    place of two such rows go by their text. Null and empty texts have no candidates, a
    very long text has all of its own. An empty table gives no rows; other columns are ignored.
    """
    kept = F.when(F.col("is_secret"), F.struct("i", "secret"))
    return scan(documents).groupBy("doc_id").agg(F.count("*").alias("n_candidates"), F.sum(F.col("is_secret").cast("long")).alias("n_secrets"), F.sort_array(F.collect_list(kept)).alias("s")).select("doc_id", "n_candidates", "n_secrets", F.col("s.secret").alias("secrets"))
