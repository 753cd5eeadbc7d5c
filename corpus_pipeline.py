"""Five stages over documents: quality rules, line dedup, near-dedup, surrogates for personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as Parquet in the shared
folder and reads it again as the next one's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lociframe.llm import line_dedup, near_dup, packing, pii, quality_rules, shared
from lociframe.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the base rules or the line field reject go."""
    ship(spark)
    return quality_rules.keep(docs, quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each class of lines one occurrence stays; documents without a line left go."""
    ship(spark)
    return line_dedup.clean(docs, line_dedup.judge(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each class of near-duplicates the document with the least doc_id stays."""
    ship(spark)
    return near_dup.keep_one(docs, shared.cut(near_dup.classes(docs), "classes"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: personal data is replaced by surrogates."""
    ship(spark)
    return pii.pseudonymize(docs, pii.query_key(spark)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the pieces of training sequences."""
    ship(spark)
    return packing.pack(packing.tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json")), partitions=packing.partitions_for(docs))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("pii_surrogates", private), ("packing", pack)]

#: SQL has no conditional random field, no keyed permutation and no tokenizer: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
