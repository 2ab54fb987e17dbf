"""From raw documents to packed training windows: language, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet into a folder
that driver and executors share and reads them again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.llm import jaccard, language, packing, secret_scan
from bankmetrics.llm.common import forget, kept, work_folder


#: Different words that a worker remembers while packing: fewer than by itself, as executors still hold what the stages
#: before have left.
WORDS = 200_000


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the languages from the labelled documents and drops those in none of them.

    Dropped: null texts, texts without a letter, texts that no language explains by the limits of language.accepted(). All
    else stays as it is, repeated rows included; an empty table stays empty, and without labels only the former two go.
    """
    return language.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each component of near duplicates (5 words, likeness 0.75).

    Texts without words and rows without doc_id are near nothing and stay; of rows that repeat a doc_id with a near or
    equal text one stays, by a hash of its columns, other texts of that doc_id stay too. An empty table stays empty.
    """
    return jaccard.first_of_groups(docs, words=5, percent=75)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts marks in place of secrets; every document stays. n_chars follows the text where there is one.

    Null texts and null n_chars stay null. Rows are judged one by one, so ties and repeated rows don't matter; an empty
    table stays empty.
    """
    clean = secret_scan.redacted(docs, secret_scan.limits(docs))
    if "n_chars" not in docs.columns:
        return clean
    size = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(size))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 ids with their ids: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    A null or empty text is one piece with the end id, a longer one is cut every 2048 ids. Repeated rows are packed each.
    Pieces of equal length may change places. An empty table gives an empty result.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, window=2048, words=WORDS)


STAGES = [
    ("language", by_language),
    ("near_duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Languages are learned, and scores depend on the corpus: SQL can't express the stages. Tests hold run() against a
#: plain version of each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of ``sf_dir``."""
    folder = work_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return found
        docs = kept(found, folder, name)
        if i:
            forget(spark, folder, STAGES[i - 1][0])
    return docs
