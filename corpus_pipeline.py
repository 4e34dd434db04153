"""The corpus pipeline: documents through five stages of the operators in sparkmill.llm.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents (n_chars follows the text). Stages that change texts keep every
row; a document whose words all repeat earlier ones stays with an empty text.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkmill.llm import near_copies, packing, pii, substring, toxicity
from sparkmill.llm.common import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.5 or more."""
    return toxicity.reject(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity 0.8), that of the smallest id: pairs
    within operator 3's radius of SimHash fingerprints, and beyond it pairs from MinHash blocks, all verified."""
    return near_copies.keep_one(docs, by_fingerprint=True)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words of passages that an earlier document, or the same one before, has."""
    return substring.cut_repeats(docs)


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With a placeholder for each span of personal data."""
    return pii.redact_documents(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins, measured in tokens of a public vocabulary. A null or empty text is an end marker
    alone; rows that repeat are packed each."""
    return packing.pack(docs, packing.by_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


#: Rows that Spark sends to Python at a time (10,000 by default, some 30 MB of whole texts in each of several buffers).
BATCH_ROWS = 1000


def in_small_batches(stage):
    """The stage with Arrow batches of at most BATCH_ROWS rows. The setting stays in the session, as tables are lazy."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        if not 0 < own <= BATCH_ROWS:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", in_small_batches(drop_toxic)),
    ("simhash_near_dedup", in_small_batches(drop_near_copies)),
    ("substring_dedup", in_small_batches(cut_repeats)),
    ("pii", in_small_batches(redact_private)),
    ("best_fit_packing", in_small_batches(pack)),
]

#: Learned models, fingerprints of overlapping words and packing can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
