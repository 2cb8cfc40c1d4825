"""A training corpus from raw documents: quality, near copies, repeats, mix, tokens.

Each stage takes the session, the documents its predecessor kept and the folder of the tables,
and returns documents, the last one their tokens. Rows that share an id, or have none, are documents
of their own from near_copies on; the labels of an id hold for all its rows. Null texts are empty:
quality scores them, near_copies keeps them, and mix drops what has no words. Empty tables stay
empty, and other columns than those of documents are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import bpe_decode, bpe_encode, share_vocabulary, token_count
from millrace.llm.jaccard import Similarity, one_of_each
from millrace.llm.mixing import mixed_documents
from millrace.llm.quality import document_statistics, fit_quality, quality_score
from millrace.llm.queries import WEIGHTS, fold, table, vocabulary_path
from millrace.llm.substrings import remove_repeats
from millrace.session import run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
GOOD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rates at least GOOD; labels of fold 0 are not learnt from."""
    labels = table(spark, sf_dir, "labels")
    taught = labels.where(fold(F.col("doc_id")) != 0).select(
        "doc_id", F.col("quality").alias("label")
    )
    model = fit_quality(docs, taught)
    scored = docs.withColumn("__stats", document_statistics(F.col("text")))
    kept = scored.where(quality_score(docs, F.col("__stats"), model) >= GOOD)
    return kept.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group linked by five-word shingles with a similarity of 0.8 or more."""
    return one_of_each(docs, Similarity(n=5, num=4, den=5))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 20 words and more that occur earlier."""
    cut = remove_repeats(docs, window=20)
    return with_length(cut).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the words that the mix takes of them."""
    return with_length(mixed_documents(docs, WEIGHTS, share=1.5, most=2.0))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and whether they decode to its text."""
    path = vocabulary_path()
    shared = share_vocabulary(spark, path)
    encoded = docs.withColumn("ids", bpe_encode(spark, F.col("text"), path, shared))
    decoded = encoded.withColumn("__back", bpe_decode(spark, F.col("ids"), path, shared))
    same = F.col("__back") == F.coalesce("text", F.lit(""))
    return decoded.select(
        "doc_id", "source", token_count(F.col("ids")).alias("n_tokens"), "ids", same.alias("exact")
    )


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("mix", mix),
    ("tokens", tokens),
]
ORACLE_SQL = None  # the classifier, the draw of the mix and the tokens are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), run_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
