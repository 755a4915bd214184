"""A corpus pipeline: each stage applies one operator to all that the stage before it kept.

``STAGES`` lists name and function; a function takes (spark, docs, sf_dir). ``run``
applies them to the documents, writing each stage's result to the shared folder and
reading it back. The last stage returns doc_id, n_tokens and digests; the others
return the columns of the documents.
"""

from pyspark.sql import DataFrame, SparkSession

from custodia.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality_filter
from custodia.llm.common import read_table
from custodia.llm.queries import RANKS
from custodia.storage import stage

#: Words of a shingle.
SHINGLE_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_filter.keep_good(docs, quality_filter.train(docs, read_table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return near_dedup.drop_near_copies(docs, SHINGLE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return byte_bpe.encode_documents(docs, RANKS)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The stages' models, minima and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
