"""Joins of a corpus job: overlap with earlier corpora, containment of benchmark texts, reconciliation, rule lookups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrow
from . import dedup

#: Rows, and bytes as JSON, of the smaller side up to which it is broadcast; beyond, the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """The table, marked for broadcast if it has so few rows and bytes; else as it is, for Spark to shuffle."""
    one = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if one.n <= rows and one.bytes <= size else df


def exact_overlap(docs: DataFrame, index: DataFrame, key: str, action: str = "report") -> DataFrame:
    """Documents whose key an earlier corpus has: left out (exclude) or marked (report)."""
    seen = index.select(F.col(key).alias("__seen")).distinct()
    if action == "exclude":
        return docs.join(seen, F.col(key) == F.col("__seen"), "left_anti")
    return docs.join(seen, F.col(key) == F.col("__seen"), "left").withColumn("exact_overlap", F.col("__seen").isNotNull()).drop("__seen")


def near_overlap(docs: DataFrame, index: DataFrame, order: str, threshold: float = 0.75) -> DataFrame:
    """Ids of documents (with sig) that have a near copy among the signatures of an index. Only distinct signatures of
    either side meet, under keys of their rarest coordinates."""
    if threshold < 0.75:
        raise ValueError("the bands find every pair from a similarity of 0.75 on only")
    full = F.size("sig") == dedup.COORDINATES
    sides = docs.where(full).select("sig", F.lit(False).alias("old")).union(index.where(full).select("sig", F.lit(True)))
    every = dedup.written(sides.groupBy("sig").agg(F.max("old").alias("old"), F.max(~F.col("old")).alias("new")), "signatures")
    keyed = dedup.written(dedup.prefix_keys(every, "sig", dedup.COORDINATES * 3 // 4, dedup.COORDINATES).join(every, "sig"), "keys")
    have = keyed.where("old").select(F.col("sig").alias("si"), "key")
    met = keyed.where("new").join(have, "key").where(dedup.similarity("sig", "si") >= threshold).select("sig")
    hits = met.union(every.where("old and new").select("sig")).distinct()
    return docs.join(hits, "sig", "left_semi").select(order).distinct()


#: Distinct anchors up to which they are sent to the tasks, eight bytes each, to leave other runs out at once.
ANCHORS = 1_000_000


def contained(docs: DataFrame, signatures: DataFrame, order: str = "doc_id", key: str = "key", size: int = 24) -> DataFrame:
    """(doc columns, sid, at) of documents whose key has a signature as a part; `at`: where its anchor first stands.

    The anchor, a signature's middle `size` characters, meets the document's runs of that length by their hash, and each
    meeting is verified on the whole texts. Up to ANCHORS anchors, documents are searched in place and only those that
    meet one go on; with more, runs and anchors meet by shuffled (id, hash) rows without texts, and only the documents
    that met one are joined with their texts again, by `order`, which must name a row."""
    middle = F.floor((F.length("skey") - size) / 2).cast("int") + 1
    anchors = signatures.where(F.length("skey") >= size).select("sid", "skey", arrow.run_hash(F.substring("skey", middle, F.lit(size))).alias("h"))
    anchors = dedup.written(anchors, "anchors")
    distinct = anchors.select("h").distinct()
    long = docs.where(F.length(key) >= size)
    if distinct.limit(ANCHORS + 1).count() <= ANCHORS:
        wanted = np.sort(np.array([r.h for r in distinct.collect()], dtype=np.int64))
        met = long.withColumn("__m", arrow.runs_met(size, wanted)(key)).where(F.size("__m") > 0).withColumn("__m", F.explode("__m"))
        met = met.select(*docs.columns, F.col("__m.h").alias("h"), F.col("__m.at").alias("at")).join(small(anchors), "h")
    else:
        runs = long.select(order, F.explode(arrow.runs_met(size, None)(key)).alias("m")).select(order, "m.h", "m.at")
        met = runs.join(distinct, "h", "left_semi").join(anchors, "h").join(docs, order)
    return met.where(F.col(key).contains(F.col("skey"))).select(*docs.columns, "sid", "at").distinct()


def decontaminate(docs: DataFrame, signatures: DataFrame, order: str = "doc_id", key: str = "key") -> DataFrame:
    """(order, sid) of contaminated documents: of the first file (`rank`) that has a part of it, the signature whose anchor
    stands first, of several there the smallest."""
    ranks = small(signatures.select("sid", "rank"))
    met = contained(docs, signatures, order, key).join(ranks, "sid")
    return met.groupBy(order).agg(F.min(F.struct("rank", "at", "sid"))["sid"].alias("sid"))


def asset_pins(pins: DataFrame, files: DataFrame) -> DataFrame:
    """(asset, status): missing, duplicate (pinned or supplied twice), sha256_drift, rows_drift or matched, from pins and
    files of (asset, sha256, rows)."""
    want = pins.groupBy("asset").agg(F.count("*").alias("pinned"), F.first("sha256").alias("want_sha"), F.first("rows").alias("want_rows"))
    have = files.groupBy("asset").agg(F.count("*").alias("supplied"), F.first("sha256").alias("sha"), F.first("rows").alias("rows"))
    j = want.join(have, "asset", "left")
    status = F.coalesce(
        F.when(F.col("supplied").isNull(), "missing"),
        F.when((F.col("pinned") > 1) | (F.col("supplied") > 1), "duplicate"),
        F.when(F.col("sha") != F.lower("want_sha"), "sha256_drift"),
        F.when(F.col("rows") != F.col("want_rows"), "rows_drift"),
        F.lit("matched"),
    )
    return j.select("asset", status.alias("status"))


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per key: matched, missing, unexpected, or the first value that drifted."""
    a = expected.select(*keys, *[F.col(v).alias(f"e_{v}") for v in values], F.lit(1).alias("e"))
    b = actual.select(*keys, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(1).alias("a"))
    drift = [F.when(~F.col(f"e_{v}").eqNullSafe(F.col(f"a_{v}")), F.lit(f"{v}_drift")) for v in values]
    status = F.coalesce(F.when(F.col("a").isNull(), "missing"), F.when(F.col("e").isNull(), "unexpected"), *drift, F.lit("matched"))
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def lookup(df: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """A left join with a table of rules, one row a key."""
    return df.join(small(rules), key, "left")


def merge_verdicts(samples: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Samples with a second verdict: scores averaged, flags united, the reward shifted by a hundredth of the change."""
    second = verdicts.withColumnsRenamed({"score": "score2", "flags": "flags2"})
    j = samples.join(second, ["prompt_id", "index"], "left")
    score = F.when(F.col("score2").isNull(), F.col("score")).otherwise((F.col("score") + F.col("score2")) / 2)
    flags = F.array_sort(F.array_union("flags", F.coalesce("flags2", F.array().cast("array<string>"))))
    return j.select("prompt_id", "index", score.alias("judge_score"), flags.alias("flags"), (F.col("reward") + (score - F.col("score")) / 100).alias("reward"))
