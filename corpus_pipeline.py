"""A corpus from documents to token files: each stage is one operator of ``watchmill.llm`` over all that the last one kept."""

from pyspark.sql import DataFrame, SparkSession

from watchmill.llm import decontamination, language, mixing, near_copies, token_files
from watchmill.llm.common import table
from watchmill.llm.queries import word_tokenizer
from watchmill.session import written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents without text or without a letter have no language and go."""
    return language.in_known_language(docs, language.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: near copies by SimHash, each link verified on five-word shingles, and those that lie further apart by bands
    of least hashes; of each group the document with the smallest doc_id stays."""
    return near_copies.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that give a benchmark item away go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: every document as often as the mixture takes it."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: token files, and what they hold of each document."""
    return token_files.token_files(docs, word_tokenizer())


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("tokens", tokens),
]
# a trained network and a tokenizer cannot be said in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
