"""SimHash near-dedup (3) by covering locality-sensitive hashing.

Every bit of a fingerprint gets a nonzero vector of three bits; for each of the seven nonzero v the mask of v has the
bits whose vector has an odd product with v. Two differing bits are two linear conditions on v, so some v's mask holds
neither: fingerprints within the radius of 2 agree under that mask and meet in its table. No pair is missed.

Copies share a fingerprint, and only distinct fingerprints enter the tables. A bucket of more than `BUCKET` of them is
dealt out again by the same construction over its free bits, after which at most 12 bits are free and a bucket holds at
most 4,096; nothing is capped. A bucket gives each of its linked groups as a star, not as pairs.

Rows: a null or empty text, or one of white space only, has fingerprint zero and is linked like any other. Rows that
repeat a doc_id are linked by their own texts. Ids lie below 2**62. A row with a null id comes last; its component is
null only if no other id is in it. Other columns are dropped (or kept, see keep_one), whatever their names. An empty
table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, join_hot, map_arrow, materialize, real_id, row_id, texts
from .components import components

BITS, RADIUS, SEED = 64, 2, 42
#: Distinct fingerprints beyond which a bucket is dealt out again.
BUCKET = 1024


def covering(bits: list[int]) -> list[int]:
    """The seven masks over the given bit positions."""
    vector = {b: 1 + k % 7 for k, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, 8)]


MASKS = covering(list(range(BITS)))
FINER = [[m | s for s in covering([b for b in range(BITS) if not m >> b & 1])] for m in MASKS]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str, size: int = 3) -> int:
    """64-bit SimHash of the text's shingles of `size` words, A-Z lower-cased, repeats included."""
    w = text.encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < size else map(b" ".join, zip(*(w[k:] for k in range(size)), strict=False))
    n = max(1, len(w) - size + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 1 << 15):
        ones += np.unpackbits(h[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(rid, h, fp): ids, hashes of the texts, fingerprints as signed 64-bit numbers."""
    own = docs.select(row_id(id_col).alias("rid"), F.xxhash64("text").alias("h"), "text")
    return map_arrow(own, "rid long, h long, fp long", lambda b: {"rid": b.column("rid"), "h": b.column("h"), "fp": np.array([signed(fingerprint(t)) for t in texts(b)], dtype=np.int64)})


def linked(fp: np.ndarray, radius: int = RADIUS) -> list[np.ndarray]:
    """Groups of two and more among distinct fingerprints that chains of links within the radius join."""
    left, out = np.arange(len(fp)), []
    while len(left):
        group, edge = [left[0]], [left[0]]
        left = left[1:]
        while edge and len(left):
            near = np.bitwise_count(fp[left] ^ fp[edge.pop()]) <= radius
            if near.any():
                group += (new := left[near].tolist())
                edge += new
                left = left[~near]
        if len(group) > 1:
            out.append(np.array(group))
    return out


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each bucket; rows come sorted by bucket. A bucket is bounded, see above."""
    held = np.zeros((4, 0), dtype=np.int64)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def stars(rows: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero((np.diff(rows[:3]) != 0).any(axis=0)) + 1
        a, b = [], []
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, rows.shape[1]], strict=True):
            if hi - lo > 1:
                node = rows[3, lo:hi]
                for g in linked(node.view(np.uint64)):
                    least = node[g].min()
                    a += [least] * (len(g) - 1)
                    b += [x for x in node[g].tolist() if x != least]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    for batch in batches:
        rows = np.hstack([held, np.vstack([c.to_numpy(zero_copy_only=False) for c in batch.columns])])
        new = np.flatnonzero((np.diff(rows[:3]) != 0).any(axis=0))
        cut = int(new[-1]) + 1 if len(new) else 0
        held = np.ascontiguousarray(rows[:, cut:])
        if cut:
            yield stars(np.ascontiguousarray(rows[:, :cut]))
    if held.shape[1]:
        yield stars(held)


def tables(unique: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(t, mask, key, fp): the buckets of distinct fingerprints (fp); any two within the radius share one. t // 8 is the
    place in MASKS of the mask that a bucket, and those it is dealt into, come from."""
    each = F.explode(F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(MASKS)]))
    rows = unique.select("fp", each.alias("x")).select("fp", "x.t", "x.key")
    many = materialize(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket), "buckets")
    finer = F.array(*[F.array(*[F.lit(signed(m)) for m in own]) for own in FINER])
    masks = F.when(F.col("n").isNull(), F.array(F.element_at(F.array(*[F.lit(signed(m)) for m in MASKS]), F.col("t").cast("int") + 1))).otherwise(F.element_at(finer, F.col("t").cast("int") + 1))
    dealt = rows.join(many, ["t", "key"], "left").select("fp", "t", F.posexplode(masks).alias("u", "mask"))
    return dealt.select((F.col("t") * 8 + F.col("u")).alias("t"), F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def links(unique: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp) whose components are those of all links."""
    n = int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tables(unique, bucket).repartition(n, "t", "mask", "key").sortWithinPartitions("t", "mask", "key").mapInArrow(_stars, "a long, b long")


def _groups(docs: DataFrame, id_col: str, bucket: int) -> DataFrame:
    """(rid, h, fp, first): with each row the first (rid, h) of its group."""
    each = materialize(fingerprints(docs, id_col), "fingerprints")
    unique = materialize(each.groupBy("fp").agg(F.min(F.struct("rid", "h")).alias("least"), F.count("*").alias("n")), "unique")
    root = components(links(unique.select("fp"), bucket)).withColumnRenamed("node", "fp")
    named = materialize(unique.join(root, "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "named")
    first = named.groupBy("root").agg(F.min("least").alias("first"))
    return join_hot(each, materialize(named.join(first, "root").select("fp", "n", "first"), "firsts"), "fp")


def near_groups(docs: DataFrame, id_col: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """Per row: the id, `fingerprint` (16 hex digits) and `component_id`, the smallest id that links lead to."""
    out = _groups(docs, id_col, bucket).select("rid", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.rid").alias("root"))
    return out.select(real_id().alias(id_col), "fingerprint", real_id("root").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of each group, that of the smallest id (of texts under one id, of the smallest hash); columns as they are."""
    return keep_first(docs, _groups(docs, id_col, BUCKET).select("first"), id_col)


def keep_first(docs: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """The rows of docs that a group names as its `first` (rid, h), once each; columns as they are."""
    rid, h = fresh(docs, "rid", "h")
    stays = groups.distinct().select(F.col("first.rid").alias(rid), F.col("first.h").alias(h))
    own = docs.withColumns({rid: row_id(id_col), h: F.xxhash64("text")})
    return own.join(stays, [rid, h], "left_semi").dropDuplicates([rid, h]).select(*docs.columns)
