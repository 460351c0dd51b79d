"""From raw documents to token ids: five stages, each over all that the one before it kept.

A stage takes (session, documents, folder of the tables) and returns a DataFrame. All but the last
return the columns of the documents they got. ``run`` writes each stage's result to the shared
folder and reads it back for the next, so a lost executor costs part of one stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, fertility, ngram_join, surrogates
from tidemark.llm.cluster import written
from tidemark.llm.queries import BYTE_BPE, PII_KEY, RULES, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    return fertility.keep(docs, RULES)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, that of the smallest id."""
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data, and their new lengths."""
    out = surrogates.replaced(docs, PII_KEY, bare_given=True)
    length = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
    return out.withColumn("n_chars", length)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and of what they decode to."""
    return bpe.digests(docs, BYTE_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("private_data", private_data),
    ("tokens", tokens),
]

# MinHash, keyed surrogates and pair merging are not expressible in SQL; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, on all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
