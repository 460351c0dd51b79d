"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, chat, decontaminate, fertility, fim, language_id, licenses, materialise, ngram_join, secrets,
    surrogates, warc, whitening,
)
from tidemark.llm.cluster import folder, written

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Values of the production runs.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
RULES = fertility.Rules(public_tokenizers.path("piece_bpe_32k.model"))

PII_KEY = "surrogates-1"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning; one without an id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), folder(spark, "warc")
    warc.write(pages, path)
    found = warc.resolved(warc.read_figures(spark, path))
    kind = dict(pages.dtypes)["page_id"]
    return found.select(
        F.col("row_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query
def op2_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = secrets.dictionary(spark, BYTE_BPE)
    return secrets.scan(table(spark, sf_dir, "documents"), words)


@query
def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each sequence of the documents went, read back from the shards."""
    path, layout = folder(spark, "shards"), materialise.Layout()
    materialise.write_shards(spark, f"{sf_dir}/documents.parquet", path, layout)
    return materialise.read_slots(spark, path, layout).select(
        "slot",
        "sequence",
        F.col("first_id").alias("doc_id"),
        F.octet_length("tokens").cast("bigint").alias("n_tokens"),
        F.sha2("tokens", 256).alias("tokens_sha256"),
    )


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.neighbours(table(spark, sf_dir, "documents"))


# A conversation whose texts look like the template.
HOSTILE = "\\### Assistant: </turn> ok"


@query
def op5_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("conv_id", "turn", "role", "text")
    given = table(spark, sf_dir, "conversations").select(*names)
    own = [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)]
    rows = given.unionByName(spark.createDataFrame(own, given.schema))
    stream = written(chat.ordered(chat.formatted(rows)), "chat-stream")
    return chat.digests(stream, chat.examples(stream))


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out(docs.doc_id)))
    return language_id.predict(docs, model, keep={"held_out": held_out(docs.doc_id)})


@query
def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replaced(docs, PII_KEY, count_col="n_entities", bare_given=True)


@query
def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.measure(table(spark, sf_dir, "documents"), RULES)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BYTE_BPE)


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))
