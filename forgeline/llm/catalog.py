"""The registered queries of the training-data operators: each reads its whole table and derives the digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.llm import oracle

#: Rows of an Arrow batch: texts can be long, and a batch is held by one Python worker.
BATCH_ROWS = "500"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.substring_dedup import remove_repeats

    return (remove_repeats(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scored by how much more they look like those labelled good than like all."""
    from forgeline.llm.lm_scoring import cross_entropy_difference

    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    bits = [F.round(c, 6).alias(c) for c in ("target_bits", "background_bits", "score")]
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good).select("doc_id", "n_words", *bits)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm import toxicity
    from forgeline.llm.labelled import crc, fit_sample

    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(crc(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = toxicity.fit(*fit_sample(docs, table(spark, sf_dir, "labels"), "toxic", crc(F.col("doc_id")) % 4 != 2))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm import latent_knn
    from forgeline.llm.labelled import crc, fit_sample

    docs, held_out = table(spark, sf_dir, "documents"), F.coalesce(crc(F.col("doc_id")) % 5 == 0, F.lit(False))
    sample, _ = fit_sample(docs, table(spark, sf_dir, "labels"), "quality", crc(F.col("doc_id")) % 5 != 0, rows=2000)
    return latent_knn.score(docs, latent_knn.fit(sample)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.line_templates import drop_lines

    return (drop_lines(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.vafile import top_k

    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.quality_rules import judge

    return (judge(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.bpe import encode_decode

    return (encode_decode(table(spark, sf_dir, "documents"))
            .select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.ngram_join import join_components

    return join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def ngram_join_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of links of each document's set, as op9_ngram_join returns it beside the components."""
    from forgeline.llm.ngram_join import join_components

    return join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "n_links")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.bag_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.secret_scan import KINDS, find_secrets, written

    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")
    return (find_secrets(table(spark, sf_dir, "documents"))
            .select("doc_id", count(0), count(1), count(2), F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from forgeline.llm.prefix_trie import trie

    return trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_lm_scoring, op3_toxicity, op4_quality_classifier, op5_line_dedup, op6_exact_topk, op7_quality_rules, op8_bpe, op9_ngram_join, op10_packing, op11_bag_search, op12_secret_scan, op13_prefix_trie, ngram_join_links)}
ORACLE = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
