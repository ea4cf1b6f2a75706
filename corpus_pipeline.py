"""The corpus pipeline: five of the training-data operators, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes each result as Parquet into the shared folder and hands the
table read back to the next stage. All stages but the last return the columns
of ``documents``. Rows with nulls, repeated rows and empty tables pass through
as each operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closebook.llm.common import materialize
from closebook.llm.decontamination import remove_contaminated
from closebook.llm.mixing import mix_documents
from closebook.llm.ngram_join import keep_one_per_component
from closebook.llm.quality import remove_low_quality
from closebook.llm.queries import END_ID, tokenizer_path
from closebook.llm.token_store import encode_and_read_back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return remove_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of the n-gram Jaccard join connect (5 words, 0.8)."""
    return keep_one_per_component(docs, k=5, threshold=(80, 100))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (up to three copies)."""
    return mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store's digest of every document: doc_id, start, n_tokens, ids_crc32, nth."""
    return encode_and_read_back(docs, tokenizer_path(), END_ID)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminate), ("mixing sources", mix), ("token-ID output", token_ids)]

#: A classifier's scores and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
