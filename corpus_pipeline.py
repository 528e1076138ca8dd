"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's documents.  All but the last return the
columns of ``documents``.

Defined cases: every stage takes null and empty texts (the quality classifier
decides about them like about others), repeated rows (one stays) and an empty
table (every stage returns no rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from towerlens.llm import content_sort, hyperminhash, large_item_packing, phrase_index, quality_rules
from towerlens.llm.frames import shared_folder
from towerlens.llm.tokens import default_tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule ensemble rejects; it learns from labels outside the held-out third."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trains = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    return quality_rules.drop_rejected(docs, quality_rules.fit(docs, labels, trains))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the smallest id) of each group of equal texts."""
    return content_sort.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document (the smallest id) of each component of near duplicates: five-word shingles, similarity 0.8."""
    return hyperminhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold any ten-word passage (or any whole shorter item) of the benchmark."""
    return phrase_index.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens; one row per piece."""
    return large_item_packing.pack_documents(docs, default_tokenizer())


STAGES = [("quality classifier", quality), ("exact dedup", exact_duplicates), ("MinHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: SQL cannot express the classifier, the sketches and the packing
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
