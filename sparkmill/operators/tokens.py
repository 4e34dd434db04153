"""Tokenised tables: encode, split long documents, cut at quotas, lay end to end in shards; statistics of an encoder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encoders
from . import windows


def encoded(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """With `ids`, and `n_tokens`, which counts an end mark."""
    return df.withColumn("ids", encoders.token_ids(path)(text)).withColumn("n_tokens", (F.size("ids") + 1).cast("long"))


def encode_pack(df: DataFrame, path: str, key: str, eos: int, size: int, most: int = 4096, least: int = 64, quotas: DataFrame | None = None, text: str = "text", order: str = "doc_id") -> DataFrame:
    """(key, shard, at, tokens): ids of the documents of each key in order, long ones split, each chunk with an end mark, up
    to the key's quota of tokens (quotas: key, quota) if there are any, laid end to end and cut at shards of `size`."""
    from ..sources import writers

    rows = encoded(df, path, text).select(key, order, F.posexplode(windows.split_long(F.col("ids"), most, least)).alias("part", "ids"))
    rows = rows.where(F.size("ids") > 0).withColumn("n", F.size("ids").cast("long"))
    if quotas is not None:
        rows = windows.under_quota(rows.join(F.broadcast(quotas), key), key, [order, "part"], "n", "quota")
        rows = rows.withColumn("marked", F.slice(F.array_append("ids", F.lit(eos)), F.lit(1), F.col("accepted").cast("int")))
    else:
        rows = rows.withColumn("marked", F.array_append("ids", F.lit(eos)))
    return writers.token_shards(rows.select(key, order, "part", F.col("marked").alias("ids")), key, [order, "part"], "ids", size)


def fertility(df: DataFrame, path: str, domain: str, text: str = "text") -> DataFrame:
    """Per domain: samples, characters, bytes, tokens and their ratios, unknown and byte-fallback tokens and their rates, texts
    that don't come back from decoding."""
    own = df.select(domain, F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("a", encoders.audited(path)("t"))
    sums = {"chars": F.length("t"), "utf8_bytes": F.octet_length("t"), "tokens": F.col("a.tokens"), "unk_tokens": F.col("a.unknown"), "byte_fallback_tokens": F.col("a.fallback")}
    g = own.groupBy(domain).agg(F.count("*").alias("samples"), *[F.sum(c.cast("long")).alias(n) for n, c in sums.items()], F.count_if(~F.col("a.returns")).alias("roundtrip_failures"))
    share = lambda a, b: F.round(F.col(a) / F.greatest(b, F.lit(1)), 6)
    ratios = {"tokens_per_char": ("tokens", "chars"), "chars_per_token": ("chars", "tokens"), "bytes_per_token": ("utf8_bytes", "tokens"), "unk_token_rate": ("unk_tokens", "tokens"), "byte_fallback_rate": ("byte_fallback_tokens", "tokens")}
    return g.withColumns({n: share(a, F.col(b)) for n, (a, b) in ratios.items()})
