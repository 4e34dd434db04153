"""Exact and near deduplication with the first document in a stated order kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrow

COORDINATES, BANDS = 8, 4


def shared(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir). Only in local mode, as in tests, one is made where it is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="sparkmill-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read again."""
    path = f"{shared(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A key is hot if it has more than one in so many of all rows; fewer keys than this number are.
HOT = 1000


def join_counted(rows: DataFrame, named: DataFrame, key: str, n: str) -> DataFrame:
    """rows joined with named (one row a key, with its number of rows): hot keys, fewer than HOT, are broadcast, so that
    no task gets all rows of one key; the others are shuffled."""
    total = named.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * HOT > total
    few = rows.join(F.broadcast(named.where(hot).drop(n)), key)
    rest = rows.join(F.broadcast(named.where(hot).select(key)), key, "left_anti")
    return few.unionByName(rest.join(named.where(~hot).drop(n), key))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Rows of one key are reduced before the shuffle where the order is a single id."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """The rows whose order is the least of their key: an aggregation, so a frequent key is combined map-side."""
    least = df.groupBy(key).agg(F.min(order).alias("__first")).withColumnRenamed(key, "__key")
    return df.join(least, F.col(key).eqNullSafe(F.col("__key")) & (F.col(order) == F.col("__first")), "left_semi")


def signed(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds key (comparison form), chunks and sig, an array of eight hashes or empty. See wide_signed for 64."""
    keyed = df.withColumn("key", arrow.nfkc_fold(text))
    cut = keyed.withColumn("chunks", arrow.content_chunks("key"))
    sig = F.array(*[F.array_min(F.transform("chunks", lambda c, k=k: F.xxhash64(F.lit(k), c))) for k in range(COORDINATES)])
    return cut.withColumn("sig", F.when(F.length("key") < 5, F.array().cast("array<bigint>")).otherwise(sig))


def bands(df: DataFrame, sig: str = "sig") -> DataFrame:
    """One row per band of a full signature: band number and its two coordinates."""
    each = F.array(*[F.struct(F.lit(b).alias("band"), F.element_at(sig, 2 * b + 1).alias("x"), F.element_at(sig, 2 * b + 2).alias("y")) for b in range(BANDS)])
    return df.where(F.size(sig) == COORDINATES).select("*", F.explode(each).alias("__b")).select("*", "__b.band", "__b.x", "__b.y").drop("__b")


def prefix_keys(df: DataFrame, sig: str, least: int, size: int, name: str | None = None) -> DataFrame:
    """A row for each key under which a signature can meet another that shares `least` of its `size` coordinates, with the
    signature, or with its name, if the table has one that stands for it.

    Coordinates are ordered by how many signatures hold them, rarest first. Two signatures that share `least` share two of
    their size - least + 2 first ones (one of size - least + 1), so the keys are the pairs of these (of wide signatures, the
    coordinates themselves): they miss no pair, and a passage that many documents share, whose coordinates are frequent, is
    a key only for those that hold nearly nothing else. Coordinates that one signature holds make no key."""
    two = size <= 16
    first = size - least + (2 if two else 1)
    name = name or sig
    rows = df.select(name, F.posexplode(sig).alias("__c", "__x")).select(name, F.struct("__c", "__x").alias("__t"))
    often = written(rows.groupBy("__t").agg(F.count("*").alias("__n")).where("__n > 1"), "coordinates")
    held = join_counted(rows, often.withColumn("__often", F.col("__n")), "__t", "__n")
    own = held.groupBy(name).agg(F.sort_array(F.collect_list(F.struct("__often", "__t"))).alias("__h"))
    # Coordinates of one signature alone come first in its order: so many places of the prefix are taken by them.
    room = F.lit(first) - (F.lit(size) - F.size("__h"))
    kept = F.when(room > 0, F.transform(F.slice("__h", 1, F.greatest(room, F.lit(0))), lambda h: h["__t"])).otherwise(F.array().cast("array<struct<__c: int, __x: bigint>>"))
    keyed = own.select(name, kept.alias("__k"))
    if not two:
        return keyed.select(name, F.explode(F.transform("__k", lambda t: F.xxhash64(t["__c"], t["__x"]))).alias("key"))
    later = lambda t, i: F.transform(F.slice("__k", i + 2, first), lambda u: F.xxhash64(t["__c"], t["__x"], u["__c"], u["__x"]))
    return keyed.select(name, F.explode(F.flatten(F.transform("__k", later))).alias("key"))


def band_pairs(sig: str = "sig") -> Column:
    """Names of the six pairs of bands of a full signature: at a similarity of 0.75 two coordinates differ at most, so two
    whole bands agree. Unlike prefix keys they depend on the signature alone, as a stream needs it."""
    pick = lambda b: [F.element_at(sig, 2 * b + 1), F.element_at(sig, 2 * b + 2)]
    each = [F.concat(F.lit(f"{a}{b}:"), F.hex(F.xxhash64(*pick(a), *pick(b)))) for a in range(BANDS) for b in range(a + 1, BANDS)]
    return F.when(F.size(sig) == COORDINATES, F.array(*each)).otherwise(F.array().cast("array<string>"))


def similarity(a: str, b: str) -> Column:
    """Share of equal coordinates."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v) / COORDINATES


def overlap(a: str, b: str) -> Column:
    """Common values of two signatures as sets, by the smaller one."""
    smaller = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.size(F.array_intersect(a, b)) / F.greatest(smaller, F.lit(1))


def near_pairs(df: DataFrame, order: str, threshold: float = 0.75, measure=similarity) -> DataFrame:
    """Pairs (a, b, similarity), a before b, of distinct signatures; the earliest document stands for its signature."""
    if threshold < 0.75:
        raise ValueError("the bands find every pair from a similarity of 0.75 on only")
    unique = written(df.where(F.size("sig") == COORDINATES).groupBy("sig").agg(F.min(order).alias("ord")), "unique")
    keyed = written(prefix_keys(unique, "sig", COORDINATES * 3 // 4, COORDINATES).join(unique, "sig"), "keys")
    left = keyed.select(F.col("ord").alias("a"), F.col("sig").alias("sa"), "key")
    right = keyed.select(F.col("ord").alias("b"), F.col("sig").alias("sb"), "key")
    pairs = left.join(right, "key").where("a < b").select("a", "b", measure("sa", "sb").alias("similarity"))
    return pairs.where(F.col("similarity") >= threshold).distinct()


WIDE = 64


def wide_signed(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds sig, 64 least hashes of the text's content-defined chunks, or empty for fewer than five characters."""
    cut = df.withColumn("key", arrow.nfkc_fold(text))
    sig = arrow.least_hashes(WIDE)(arrow.content_chunks("key"))
    return cut.withColumn("sig", F.when(F.length("key") < 5, F.array().cast("array<bigint>")).otherwise(sig)).drop("key")


def wide_pairs(df: DataFrame, order: str, threshold: float = 0.75) -> DataFrame:
    """Pairs (a, b, shared), a before b, of distinct 64-coordinate signatures that share int(64 * threshold) and more.

    Signatures, half a kilobyte each, stand under a name in all that is dealt by coordinates and keys; they meet again for
    the distinct pairs of names, first one side, then the other."""
    least = max(int(WIDE * threshold), 1)
    unique = df.where(F.size("sig") == WIDE).groupBy("sig").agg(F.min(order).alias("ord"))
    # The least id is a name unless ids repeat; the hash of the signature tells those apart.
    unique = written(unique.withColumn("name", F.struct("ord", F.xxhash64("sig").alias("h"))), "unique")
    keyed = written(prefix_keys(unique, "sig", least, WIDE, "name"), "keys")
    met = keyed.select(F.col("name").alias("a"), "key").join(keyed.select(F.col("name").alias("b"), "key"), "key")
    pairs = written(met.where("a.ord < b.ord").select("a", "b").distinct(), "pairs")
    one = pairs.join(unique.select(F.col("name").alias("a"), F.col("sig").alias("sa")), "a")
    both = one.join(unique.select(F.col("name").alias("b"), F.col("sig").alias("sb")), "b")
    shared_ = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return both.select("a.ord", F.col("b.ord").alias("b"), shared_.alias("shared")).withColumnRenamed("ord", "a").where(F.col("shared") >= least).distinct()


#: Rounds that look at neighbours only, before chains of what is left are followed whole; pairs of a chain, and nodes of
#: a part of a longer one, that a task works off at once.
ROUNDS, CHAIN, PART = 2, 500_000, 50_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): the least node that can be reached.

    Each partition joins its own edges first and passes on a star for each component it sees; nodes that several stars
    hold join their roots in the next round. A range of nodes per partition makes few stars of what lies together."""
    left, maps = written(edges.where("a <> b").select("a", "b"), "edges"), []

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([b.column(k).to_numpy() for k in (0, 1)]) for b in batches]  # a partition's own edges
        if not held:
            return
        ends = np.hstack(held)
        node, at = np.unique(ends, return_inverse=True)
        at, root = at.reshape(ends.shape), np.arange(len(node))
        while True:
            x, y = root[at[0]], root[at[1]]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (root != root[root]).any():
                root = root[root]
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[root])], names=["node", "root"])

    while not left.isEmpty():
        seen = written(left.repartitionByRange("a").mapInArrow(stars, "node long, root long"), "stars")
        up = written(seen.groupBy("node").agg(F.min("root").alias("up")), "up")
        maps.append(up)
        further = seen.join(up, "node").where("root <> up").select(F.col("root").alias("a"), F.col("up").alias("b")).distinct()
        left = written(further, "edges")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    root = maps[-1].withColumnRenamed("up", "root")
    for up in reversed(maps[:-1]):
        root = up.join(root.select(F.col("node").alias("up"), F.col("root").alias("top")), "up", "left").select("node", F.coalesce("top", "up").alias("root"))
    return root


def _in_order(t: pa.Table) -> pa.Table:
    """Decides the nodes of some pairs (a, b), a before b, in order; rows without a (null) say that b is rejected already."""
    a, b = t["a"].to_pylist(), t["b"].to_pylist()
    earlier: dict[int, list[int]] = {}
    rejected = {y for x, y in zip(a, b, strict=True) if x is None}
    for x, y in zip(a, b, strict=True):
        if x is not None:
            earlier.setdefault(y, []).append(x)
            earlier.setdefault(x, [])
    accepted: set[int] = set()
    for n in sorted(earlier.keys() | rejected):
        if n not in rejected and not any(x in accepted for x in earlier.get(n, ())):
            accepted.add(n)
    nodes = sorted(earlier.keys() | rejected)
    return pa.table({"n": pa.array(nodes, pa.int64()), "s": pa.array([1 if n in accepted else 2 for n in nodes], pa.int32())})


def first_independent(pairs: DataFrame) -> DataFrame:
    """(n, s) of the nodes of pairs (a, b), a before b: 1 if accepted, 2 if rejected, as if nodes came in order and each
    was accepted unless an accepted one before is its neighbour.

    Two rounds settle what depends on near neighbours, cliques above all. What stays open are chains of dependence: each
    component is worked off in order at once, in one group if it is small; a large one by parts of its order, so the
    rounds are its length by PART and not its length."""
    pairs = written(pairs.select("a", "b"), "pairs")
    state = written(pairs.select(F.col("a").alias("n")).union(pairs.select("b")).distinct().withColumn("s", F.lit(0)), "state")
    for _ in range(ROUNDS):
        before = pairs.join(state.select(F.col("n").alias("a"), F.col("s").alias("sa")), "a").groupBy(F.col("b").alias("n")).agg(F.max((F.col("sa") == 1).cast("int")).alias("hit"), F.max((F.col("sa") == 0).cast("int")).alias("open"))
        nxt = F.when(F.col("s") != 0, F.col("s")).when(F.coalesce("hit", F.lit(0)) == 1, 2).when(F.coalesce("open", F.lit(0)) == 0, 1).otherwise(0)
        state = written(state.join(before, "n", "left").select("n", nxt.alias("s")), "state")
    hit = pairs.join(state.where("s = 1").select(F.col("n").alias("a")), "a", "left_semi").select(F.col("b").alias("n")).distinct().withColumn("hit", F.lit(1))
    state = written(state.join(hit, "n", "left").select("n", F.when((F.col("s") == 0) & (F.col("hit") == 1), 2).otherwise(F.col("s")).alias("s")), "state")
    open_ = state.where("s = 0").select("n")
    if open_.isEmpty():
        return state
    # An open node has no accepted neighbour before it, and rejected ones don't matter: what is open decides alone.
    left = written(pairs.join(open_.withColumnRenamed("n", "a"), "a", "left_semi").join(open_.withColumnRenamed("n", "b"), "b", "left_semi"), "open")
    root = written(components(left), "roots")
    named = left.join(root.withColumnRenamed("node", "a"), "a")
    size = named.groupBy("root").agg(F.count("*").alias("c"))
    named = written(named.join(size, "root"), "named")
    done = written(named.where(F.col("c") <= CHAIN).groupBy("root").applyInArrow(_in_order, "n long, s int"), "decided")
    long = named.where(F.col("c") > CHAIN).select("root", "a", "b")
    if not long.isEmpty():
        done = done.unionByName(_by_parts(long))
    settled = done.union(open_.join(left.select(F.col("a").alias("n")).union(left.select("b")), "n", "left_anti").select("n", F.lit(1).alias("s")))
    return state.where("s <> 0").unionByName(written(settled, "settled"))


def _by_parts(named: DataFrame) -> DataFrame:
    """Large components (root, a, b) by parts of their order; a part knows the decisions of those before it."""
    from . import windows

    nodes = named.select("root", F.col("a").alias("n")).union(named.select("root", "b")).distinct()
    part = windows.placed(nodes, "root", ["n"], "p").select("n", F.floor((F.col("p") - 1) / PART).cast("int").alias("k"))
    part = written(part, "parts")
    ends = named.join(part.select(F.col("n").alias("a"), F.col("k").alias("ka")), "a").join(part.select(F.col("n").alias("b"), F.col("k").alias("kb")), "b")
    ends = written(ends, "ends")
    done = None
    for k in range(part.agg(F.max("k")).first()[0] + 1):
        inner = ends.where((F.col("ka") == k) & (F.col("kb") == k)).select("root", "a", "b")
        alone = part.where(F.col("k") == k).join(inner.select(F.col("a").alias("n")).union(inner.select("b")), "n", "left_anti").select("n")
        if done is None:
            hit = inner.limit(0).select("root", "b")
        else:
            hit = ends.where((F.col("kb") == k) & (F.col("ka") < k)).join(done.where("s = 1").select(F.col("n").alias("a")), "a", "left_semi").select("root", "b").distinct()
        rows = inner.unionByName(hit.select("root", F.lit(None).cast("long").alias("a"), "b"))
        new = rows.groupBy("root").applyInArrow(_in_order, "n long, s int")
        free = alone.join(hit.select(F.col("b").alias("n")), "n", "left_anti").select("n", F.lit(1).alias("s"))
        new = written(new.unionByName(free), "decided")
        done = new if done is None else written(done.unionByName(new), "decided")
    return done


def near_dedup(df: DataFrame, order: str, threshold: float = 0.75) -> DataFrame:
    """Per row: order, and decision (accepted, exact_duplicate, near_duplicate) as if rows came one by one in the order.
    Copies are one row until the end."""
    return greedy(written(signed(df).select(order, "key", "sig"), "signed"), order, threshold)


def greedy(signs: DataFrame, order: str, threshold: float = 0.75) -> DataFrame:
    """near_dedup of rows (order, key, sig)."""
    first = written(signs.groupBy("key").agg(F.min(order).alias("__first"), F.first("sig").alias("sig"), F.count("*").alias("n")), "firsts")
    rep = first.where(F.size("sig") == COORDINATES).groupBy("sig").agg(F.min("__first").alias("rep"))
    state = first_independent(near_pairs(signs, order, threshold))
    full = first.where(F.size("sig") == COORDINATES).join(rep, "sig").join(state.withColumnRenamed("n", "rep"), "rep", "left")
    kept = (F.coalesce("s", F.lit(1)) == 1) & (F.col("__first") == F.col("rep"))
    short = first.where(F.size("sig") < COORDINATES).select("key", "__first", "n", F.lit(True).alias("kept"))
    decided = written(full.select("key", "__first", "n", kept.alias("kept")).unionByName(short), "decided")
    out = join_counted(signs.select(order, "key"), decided, "key", "n")
    decision = F.when(~F.col("kept"), "near_duplicate").when(F.col(order) == F.col("__first"), "accepted").otherwise("exact_duplicate")
    return out.select(order, decision.alias("decision"))
