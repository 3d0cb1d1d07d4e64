"""The training-data pipeline over ``documents``: five operators in a row.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps; each
stage's rows are written as Parquet in the shared work folder and read again
as the next stage's input. All stages but the last return the columns of
``documents``.

1. toxicity: documents that the classifier chain rejects go.
2. n-gram Jaccard join: of each group of near copies (five words, similarity
   of at least 0.8) the document with the least id stays.
3. suffix-array dedup: passages of more than 50 words that repeat are cut out
   of the texts; a document of which nothing is left goes.
4. mixing: copies of documents are taken until the sources' targets are met.
5. BPE: the ids of each text, and how many there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockload.llm import bpe, mixing, ngram_join, suffix_dedup, toxicity
from blockload.llm.queries import table, tokenizer_path
from blockload.llm.runtime import sheltered
from blockload.session import new_path

NEAR_WORDS = 5
NEAR_PERCENT = 80
PASSAGE_WORDS = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plain, restored = sheltered(docs, "doc_id", "text")
    scored = toxicity.toxicity(plain, table(spark, sf_dir, "labels"))
    return scored.where(~F.col("rejected")).select(*restored)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.without_near_copies(docs, NEAR_WORDS, NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs, over_words=PASSAGE_WORDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(docs, tokenizer_path("byte_bpe_50k.json"))
    n_tokens = F.expr("cast(octet_length(ids) div 4 as bigint)")
    return encoded.select("doc_id", "lang", "source", n_tokens.alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# Training a classifier and encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each one's rows are a table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
