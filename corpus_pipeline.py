"""Documents to token ids: the stages of a training-data pipeline, each written before the next.

Every stage takes the rows that its predecessor kept, with the columns of `documents`, and its
decisions take effect; the last returns the ids. NULLs, empty and very long texts, repeated rows,
empty tables and further columns are treated as the operator of each stage says.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, language, line_dedup, sentencepiece_bpe, simhash
from millrace.llm.queries import tokenizer_path
from millrace.session import stage_alone
from millrace.sources.landed import read_table

# No text is rejected for its score: the cosine falls with a text's length, and that of one or two words
# of a known language can be as low as chance.
MIN_LANGUAGE_SCORE = 0.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language is told stay: those without a letter go."""
    return language.keep_known(docs, language.learn(docs), MIN_LANGUAGE_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share go from all texts."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a passage of the benchmark occurs go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, as counts and digests, with the digest of the text they decode to."""
    model = sentencepiece_bpe.read_model(tokenizer_path())
    return sentencepiece_bpe.digests(sentencepiece_bpe.encode_and_decode(docs.select("doc_id", "text"), model))


STAGES = [
    ("language ID", language_id),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", tokens),
]

# Languages, fingerprints and pieces are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = stage_alone(spark, partial(step, spark, docs, sf_dir))
    return docs
