"""Sinks: partitioned Parquet with a published inventory, exclusion manifests, JSON lines, token tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows


def write_clean(df: DataFrame, root: str, per_file: int = 1_000_000) -> None:
    """zstd Parquet by source and split, files of bounded rows; an existing folder is an error."""
    df.write.partitionBy("source", "split").option("compression", "zstd").option("maxRecordsPerFile", per_file).mode("errorifexists").parquet(root)


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, rows, bytes, sha256) of the files of a folder, their contents hashed by Spark."""
    rows = spark.read.parquet(root).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    files = files.select(F.regexp_replace("path", "^file:/+", "/").alias("p"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return rows.join(files, F.regexp_replace("path", "^file:/+", "/") == F.col("p")).select("p", "rows", "bytes", "sha256").withColumnRenamed("p", "path")


def exclusion_rows(df: DataFrame) -> DataFrame:
    """Sorted distinct (sha256, reason), one reason a digest: the first by name."""
    return df.groupBy("sha256").agg(F.min("reason").alias("reason")).orderBy("sha256")


def write_exclusion_manifest(df: DataFrame, path: str) -> None:
    """Tab-separated lines; sorted over all part files by range."""
    exclusion_rows(df).write.option("sep", "\t").option("quote", "").csv(path)


def read_exclusion_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("sha256 string, reason string").option("sep", "\t").csv(path)


def manifest_violations(df: DataFrame, expected: int | None = None) -> DataFrame:
    """(name, passed): form of digests and reasons, unique digests, few reasons, the expected count."""
    one = df.agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("sha256").rlike("^[0-9a-f]{64}$") | F.col("sha256").isNull()).alias("bad_sha"),
        F.count_if(~F.col("reason").rlike("^[a-z][a-z0-9_]{0,63}$") | F.col("reason").isNull()).alias("bad_reason"),
        F.countDistinct("sha256").alias("unique"),
        F.countDistinct("reason").alias("reasons"),
    )
    checks = [("sha256_form", F.col("bad_sha") == 0), ("reason_form", F.col("bad_reason") == 0), ("unique", F.col("unique") == F.col("n")), ("few_reasons", F.col("reasons") <= 256)]
    if expected is not None:
        checks.append(("count", F.col("n") == expected))
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("passed")) for n, c in checks])))


def token_shards(df: DataFrame, split: str, order: list[str], tokens: str, size: int) -> DataFrame:
    """(split, shard, at, tokens) of documents' tokens laid end to end and cut at shards of `size` tokens."""
    n = F.size(tokens)
    at = windows.with_prefix(df, split, order, n, "at").withColumn("n", n).where("n > 0")
    parts = at.select(split, "at", "n", tokens, F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size))).alias("shard"))
    lo = F.greatest(F.col("at"), F.col("shard") * size)
    hi = F.least(F.col("at") + F.col("n"), (F.col("shard") + 1) * size)
    return parts.select(split, "shard", lo.alias("at"), F.slice(tokens, (lo - F.col("at") + 1).cast("int"), (hi - lo).cast("int")).alias("tokens"))


def shard_manifest(shards: DataFrame, split: str) -> DataFrame:
    return shards.groupBy(split, "shard").agg(F.sum(F.size("tokens")).alias("tokens"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """UTF-8 JSON lines with sorted keys."""
    df.select(*sorted(df.columns)).write.json(path)


def split_of(doc_id: str = "doc_id"):
    return F.when(F.col(doc_id) % 50 == 0, "val").otherwise("train")


