"""A corpus pipeline of five stages: each takes (spark, docs, sf_dir) and gives the next one's docs.

toxicity -> exact_dedup -> near_dedup -> mixing -> sentencepiece. All but the
last return the columns of documents; the last returns token ids per document, decoded and compared.

Every stage takes documents with null or repeated ids, null, empty and very long
texts, repeated rows and further columns of any name; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import exact_dedup, mixing, near_dedup, sentencepiece_codec, toxicity
from llm._common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. Null and empty texts are scored on zero features; repeated rows stay or go together."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space stays: the longest, then the smallest id, null last. Null and empty texts are one group."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8 or more; the smallest id, null last. Texts without words stay."""
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their target weights, a null source being one of its own; documents stay whole. Equal keys go by id and size."""
    return mixing.repeat(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids of every row, and restored: whether decoding them gives its text again. Null and empty texts have no tokens."""
    return sentencepiece_codec.round_trip(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("mixing", mix), ("sentencepiece", encode)]

#: The trained classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
