"""Corpus pipeline over the table of documents: low quality goes, one document of each group of near duplicates stays, documents that
hold benchmark items go, secrets are replaced, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Defined cases, of all stages: an empty table gives an empty table of the same columns; columns that the stage does not know go along
unchanged, whatever their names; texts of any length are taken whole; rows that share a doc_id, or have none, are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchcast.llm import decontam, pair_bpe, quality_nbsvm, secret_scan, sigtree_join
from matchcast.llm.queries import remainder, table, tokenizer_path
from matchcast.shared import fresh_dir, remove

#: Documents that score less are rejected.
LEAST_QUALITY = 0.3
#: No SQL expresses the trained classifier, the verified windows or the merges.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects. Null and empty texts have the model's score for no indicators; repeated
    rows have one fate; a score of just 0.3 stays."""
    model = quality_nbsvm.fit(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    return quality_nbsvm.select(docs, model, LEAST_QUALITY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each component of five-word shingles with a similarity of 0.8 or more. Texts without
    words are alike to nothing and stay; of repeated rows one stays; rows without doc_id stay."""
    return sigtree_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, all rows of them that do; null and empty texts hold none."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets; n_chars follows the text. Null texts stay null, and so does their n_chars; repeated rows are replaced alike."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes what is left: a row per row, null texts as empty ones."""
    return pair_bpe.round_trip(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("secrets", secrets), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next. A stage's rows go once the next
    stage's are written; what the last one reads stays until the block of ``scratch`` or the program ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        folder = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return STAGES[-1][1](spark, docs, sf_dir)
