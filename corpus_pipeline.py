"""From raw documents to packed training sequences: each stage takes what its predecessor kept.

Toxic documents go, then all but one of exact copies, then all but one of near copies (words in fives, similarity
of 0.8 or more); personal data is masked in what is left, and the texts are packed into sequences.

Every row is judged for itself: ids may be null or stand on several rows. Each stage but the last returns the columns
of its documents, whatever others there are, and an empty table goes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelmill.llm import exact_dedup, ngram_join, packing, pii, toxicity
from reelmill.llm.shared import discard, stash
from reelmill.session import attach


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that aren't predicted toxic. Null and blank texts have no features and stay; without labels nothing goes."""
    return toxicity.reject_toxic(docs, attach(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text that differs after A-Z is lower-cased: the one with the largest id. Null texts count as empty, so one of all empty ones stays; of rows that repeat id and text one does."""
    attach(spark)
    return exact_dedup.keep_one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id. Null and blank texts are nobody's copies and stay."""
    attach(spark)
    return ngram_join.keep_one_of_each(docs, n=5, num=80, den=100)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind, and ``n_chars`` set anew. Null texts stay null."""
    attach(spark)
    return pii.mask_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its sequence. A null or empty text is the end token alone."""
    attach(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: A trained classifier, a random field and a tokenizer are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written before the next reads them, and deleted after it has.

    Without documents there are no rows; without labels the first stage keeps all.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = stash(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
