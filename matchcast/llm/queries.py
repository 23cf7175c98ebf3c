"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n."""
    return F.crc32(F.col(key).cast("string")) % n


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import quality_nbsvm

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_nbsvm.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    scored = quality_nbsvm.score(docs.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text"), model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import pair_bpe

    return pair_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import secret_scan

    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("found")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import url_filter

    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import unit_dedup

    return unit_dedup.by_document(unit_dedup.everything(table(spark, sf_dir, "documents")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import decontam

    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import gif_media

    return gif_media.store(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import ecoc_langid

    docs = table(spark, sf_dir, "documents")
    model = ecoc_langid.fit(docs.where(remainder("doc_id", 4) != 2))
    return ecoc_langid.predict(docs.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "text"), model, keep=("doc_id", "held_out"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import dac_tokens
    from matchcast.shared import fresh_dir

    folder = fresh_dir(spark, "tokens")
    dac_tokens.write(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), folder)
    return dac_tokens.read_documents(spark.read.schema(dac_tokens.SHARDS).parquet(folder))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchcast.llm import sigtree_join

    return sigtree_join.join(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_classifier, op2_bpe_round_trip, op3_secret_scan, op4_url_filter, op5_substring_dedup, op6_decontaminate, op7_gif_media, op8_language_id, op9_token_output, op10_ngram_join)}


def oracle_sql() -> dict[str, str]:
    from matchcast.llm import secret_scan, sigtree_join, url_filter

    return {"op3_secret_scan": secret_scan.SQL, "op4_url_filter": url_filter.SQL, "op10_ngram_join": sigtree_join.SQL}
