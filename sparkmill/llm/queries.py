"""The queries of this subpackage's operators, over whole tables, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, byte_bpe, centroids, packing, pii, quality, simhash, spelling, substring, token_prefix, toxicity, url_filter, vector_copies

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_token_counts(spark, sf_dir):
    counted = token_prefix.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "cut_chars")


@query
def op9_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), packing.by_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


@query
def op3_simhash(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, false)")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


@query
def op7_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op8_substring_dedup(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents"), text=False)


@query
def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.mine(pages, table(spark, sf_dir, "labels")))


@query
def op5_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).select("doc_id", *quality.STATS, "base_failed", "kept", "outlyingness")


@query
def op10_nearest(spark, sf_dir):
    index = ann.Index(table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.where("vid % 20 = 0"))


@query
def op11_centroid_clustering(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_vector_copies(spark, sf_dir):
    return vector_copies.near_groups(table(spark, sf_dir, "embeddings"))


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.counted(table(spark, sf_dir, "documents")))


ORACLE["op11_centroid_clustering"] = centroids.oracle()
ORACLE["op12_vector_copies"] = vector_copies.ORACLE
