"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, all
columns of its input; the last returns the packed pieces. Between stages the rows
are written as Parquet to the shared folder and read again.

1. quality rules: documents that fail the base rule or a certified cutoff go;
2. n-gram Jaccard join: of documents linked by similarity, the one of least doc_id stays;
3. benchmark decontamination: contaminated documents go;
4. PII: personal data and secrets get surrogates; n_chars follows the text;
5. best-fit packing: the pieces and their places in sequences of 2048 ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.llm import decontam, ngram_join, packing, pii, quality
from starmill.llm.common import spill, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.filter_documents(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.filter_documents(docs, table(spark, sf_dir, "benchmark"))


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.clean_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("PII", hide_persons),
    ("best-fit packing", pack),
]

#: surrogates, tokens and the packing have no SQL; tests compare each stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = spill(docs, "stage")
    return docs
