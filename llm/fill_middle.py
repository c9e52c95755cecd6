"""Fill-in-the-middle: texts cut at two token borders and put together again around sentinels.

An Arrow-batched pandas UDF walks each text once with `finditer` and keeps the end
of every token in a compact array, so that both cuts are looked up by number. The
seed is a SHA-256 of the document's id, so that a text's form and cuts depend on
nothing else. Text outside the sentinels is never changed: restore() gives it back.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm._common import bounded_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of texts that are transformed, and percent of these whose suffix comes first.
RATE, SUFFIX_FIRST = 50, 80
#: A token is a word with the white space before it; the white space at the end is one more.
_TOKEN = regex.compile(r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++")

TRANSFORMED = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"
RESTORED = "text string, text_sha256 string"


def token_ends(text: str) -> array:
    """0 and the code point offset after each token, four bytes each."""
    ends = array("I", [0])
    ends.extend(m.end() for m in _TOKEN.finditer(text))
    return ends


def draws(doc_id: str, seed: int = SEED) -> tuple[int, ...]:
    """Four 32-bit numbers from a document's id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def transform_text(doc_id: str, text: str, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """n, form (plain, psm or spm), prefix_chars, middle_chars, output of one text."""
    ends, (h1, h2, h3, h4) = token_ends(text), draws(doc_id, seed)
    n = len(ends) - 1
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[low], ends[high]
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore_text(output: str, form: str) -> str:
    """The text of an output. A sentinel can't begin inside a part and end in the next, so the first one found is the border."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    return two + middle + one if form == "spm" else one + middle + two


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def transformed(doc_id: Column, text: Column, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> Column:
    """A struct column of TRANSFORMED. Null texts count as empty, a null id as the id ''."""

    @F.pandas_udf(TRANSFORMED)
    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [transform_text(i, t, seed, rate, suffix_first) for i, t in zip(ids, texts)]
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        out[["prefix_chars", "middle_chars"]] = out[["prefix_chars", "middle_chars"]].astype("Int64")
        out["output_sha256"] = [_digest(t) for t in out["output"]]
        return out

    return run(F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))


def restored(output: Column, form: Column) -> Column:
    """A struct column of RESTORED, from output and form alone."""

    @F.pandas_udf(RESTORED)
    def run(outputs: pd.Series, forms: pd.Series) -> pd.DataFrame:
        texts = [restore_text(o, f) for o, f in zip(outputs, forms)]
        return pd.DataFrame({"text": texts, "text_sha256": [_digest(t) for t in texts]})

    return run(output, form)


def fill_in_middle(documents: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars, output, output_sha256: a row per row of documents.

    form is plain (output is the text) for empty texts, for those that hold a
    sentinel and for those that the rate leaves out; psm and spm say which part
    comes first. Null texts count as empty; rows with a null id share one draw.
    Repeated rows have equal results; long texts are cut like others, whole. An
    empty table gives no rows; other columns are ignored. Rows stay where they are.
    """
    bounded_batches(documents.sparkSession)
    return documents.select("doc_id", transformed(F.col("doc_id"), F.col("text"), seed, rate, suffix_first).alias("x")).select("doc_id", "x.*")


def digests(made: DataFrame) -> DataFrame:
    """Of fill_in_middle's rows: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", restored(F.col("output"), F.col("form")).alias("r")).select("*", F.col("r.text_sha256").alias("restored_sha256")).drop("r")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents),
r AS (
  SELECT doc_id, t, tokens, len(tokens)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                 WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high
  FROM r),
p AS (
  SELECT *, array_to_string(tokens[1:low], '') AS prefix, array_to_string(tokens[low + 1:high], '') AS middle, array_to_string(tokens[high + 1:], '') AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
