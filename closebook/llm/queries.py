"""The contract queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, pii, quality, token_store
from .conversations import damaged_and_repaired
from .decontamination import contamination
from .line_dedup import duplicate_lines
from .merkle import document_manifest
from .mixing import mixture
from .ngram_join import jaccard_components
from .sharding import assign_shards
from .suffix_family import remove_repeated_strings
from .topk import exact_topk, integer_vector


#: Documents end with this id; the tokenizer's file is a parameter of the operator.
END_ID = 2


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", integer_vector(F.col("embedding")).alias("vec"))
    return exact_topk(vectors.filter("vec_id % 100 = 0"), vectors, k=10)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(_table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key_a", "key_b")


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read_back(_table(spark, sf_dir, "documents"), tokenizer_path(), END_ID).drop("nth")


def op7_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_lines(_table(spark, sf_dir, "documents"))


def op8_pii_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(_table(spark, sf_dir, "documents"), shards=40).drop("row_number")


def op10_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op11_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_strings(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_lightest_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(_table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_exact_topk, op2_ngram_jaccard_join, op3_source_mixture, op4_quality_gam, op5_winnowing_decontamination,
    op6_token_store, op7_line_edit_join, op8_pii_semi_crf, op9_feistel_shards, op10_compression_language,
    op11_suffix_family, op12_lightest_derivation, op13_merkle_manifest)}
