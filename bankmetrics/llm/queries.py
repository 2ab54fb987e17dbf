"""The registered queries of the operators: each applies one to its whole table and derives what is compared."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.llm import (
    fill_middle,
    jaccard,
    language,
    metric_search,
    packing,
    pieces,
    pii,
    prefix_hash,
    role_repair,
    secret_scan,
    sharding,
    spans,
    token_files,
    variants,
)
from bankmetrics.llm.common import kept, work_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Writes the ids of all documents to PFOR files and describes each document as read back."""
    work = work_folder(spark, "op1")
    files = f"{work}/ids"
    token_files.write(table(spark, folder, "documents"), files, BYTE_BPE, end_id=2)
    # Digests are small beside the files, so they are kept and added up in place of a second read.
    digests = token_files.read_local(spark, files).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    digests = kept(digests, work, "digests")
    found = token_files.with_start(digests, digests.groupBy("shard").agg(F.sum("n_tokens").alias("n")))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_metric_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 largest inner products of every twentieth embedding with all others."""
    return metric_search.top_products(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Packs all documents into windows of 2048 ids; the ids of a piece are told by their checksum."""
    pieces = packing.token_pieces(table(spark, folder, "documents"), BYTE_BPE, end_id=1, window=2048)
    return packing.assign(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), window=2048, ranked=True)


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents: base patterns, and terms that the corpus shows to give a value away."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.with_personal_data(docs, work_folder(spark, "op4"))
    return found.select(
        "doc_id",
        *(spans.counted(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(spans.listed(F.col("base")), 256).alias("base_sha256"),
        spans.listed(F.col("personal")).alias("spans"),
    )


def op5_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All turns with repaired roles, and the rendered text of each."""
    return role_repair.repaired(table(spark, folder, "conversations")).drop("part", "place")


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike they are."""
    found = prefix_hash.fingerprints(table(spark, folder, "documents"))
    in_hex = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(in_hex).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"
    )


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents under links of 5-word shingle sets of likeness 0.75 or more."""
    return jaccard.linked_components(table(spark, folder, "documents"), words=5, percent=75)


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents: base patterns, and random tokens by the limits that the corpus gives."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.with_secrets(docs, secret_scan.limits(docs))
    return found.select(
        "doc_id",
        *(spans.counted(F.col("base"), k).alias(f"n_{k}") for k in secret_scan.KINDS),
        F.sha2(spans.listed(F.col("base")), 256).alias("base_sha256"),
        spans.listed(F.col("secrets")).alias("spans"),
    )


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from three quarters of the labelled documents and predicts the language of all."""
    docs = table(spark, folder, "documents")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    samples = language.sample(docs.where(~held).select("text", "lang"))
    judged = language.with_language(docs.select("doc_id", "text", held.alias("held_out")), samples)
    return judged.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Encodes and decodes all documents with a SentencePiece model, and compares with the sentencepiece library."""
    found = pieces.encoded(table(spark, folder, "documents").select("doc_id", "text"), PIECE_BPE)
    return found.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        "parity",
    )


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Fill-in-middle texts of all documents, told by their hash, and the hash of the text rebuilt from each."""
    found = fill_middle.with_fill_middle(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("fim", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("fim"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents, some damaged by a rule, with the spelling each is a variant of."""
    counts = variants.word_counts(table(spark, folder, "documents"), min_chars=6, damage=199)
    return variants.grouped(counts, min_count=5, ratio=5)


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of all documents; a text goes in as its size and checksum, so texts are read once and don't move."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    found = sharding.assigned(docs, shards=24, seed=42)
    unset = F.lit(None).cast("int")
    return found.select(*docs.columns, F.lit("rows").alias("law"), "shard", "slot", unset.alias("grown_shard"), "row_number")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: q for name, q in sorted(globals().items()) if name.startswith("op") and name[2].isdigit()
    }
