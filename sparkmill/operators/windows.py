"""Selection under quotas, sampling, packing and series statistics by windows."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import permute
from ..functions import text as T
from . import dedup


def with_prefix(df: DataFrame, key: str, order: list[str], value: Column, name: str = "before") -> DataFrame:
    """With the exclusive running sum of a value within a key, in an order.

    No task holds a whole key: rows are dealt by ranges of the order, ranges and keys are summed, sums of earlier ranges
    are added to running sums inside the range. The dealt rows are written once, so that ranges stay as they are."""
    dealt = dedup.written(df.withColumn("__v", value).repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranges")
    per = dealt.groupBy(F.col(key).alias("__k"), F.col("__p").alias("__q")).agg(F.sum("__v").alias("__s"))
    earlier = Window.partitionBy("__k").orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)
    offset = per.select("__k", "__q", F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__p", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("__i", F.coalesce(F.sum("__v").over(inside), F.lit(0)))
    joined = local.join(offset, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__p") == F.col("__q")))
    return joined.withColumn(name, F.col("__i") + F.col("__o")).select(*df.columns, name)


def under_quota(df: DataFrame, key: str, order: list[str], tokens: str, quota: str) -> DataFrame:
    """Documents in order until the quota of their bucket, each with an end mark; the one that crosses it is cut."""
    n = F.col(tokens) + 1
    out = with_prefix(df.where(F.col(tokens) > 0), key, order, n)
    return out.where(F.col("before") < F.col(quota)).withColumn("accepted", F.least(n, F.col(quota) - F.col("before")))


def soft_quota(df: DataFrame, key: str, order: list[str], tokens: str, quota: str) -> DataFrame:
    """The same with the crossing document whole."""
    n = F.col(tokens) + 1
    return with_prefix(df, key, order, n).where(F.col("before") < F.col(quota)).withColumn("accepted", n)


def byte_budget(df: DataFrame, key: str, order: list[str], text: str, budget: int) -> DataFrame:
    """Texts in order until each key's budget of UTF-8 bytes; the one that crosses it is cut between characters, and goes
    if nothing is left of it."""
    rows = with_prefix(df, key, order, F.octet_length(text).cast("long")).where(F.col("before") < budget)
    room = (budget - F.col("before")).cast("int")
    kept = F.when(F.octet_length(text) <= room, F.col(text)).otherwise(T.trim_to_bytes(text, room))
    return rows.withColumn(text, kept).where(F.octet_length(text) > 0).drop("before")


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def placed(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """With the place of each row within its key, from 1; by ranges of the order, so that no task holds a whole key."""
    return with_prefix(df, key, order, F.lit(1), name).withColumn(name, (F.col(name) + 1).cast("long"))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str | None = None) -> DataFrame:
    """The first k rows of each key, with their rank if a name is given."""
    out = ranked(df, keys, order, name or "__r").where(F.col(name or "__r") <= k)
    return out if name else out.drop("__r")


def batch_ranges(counts: list[tuple[int, int]], batch_tokens: int, max_rows: int) -> list[tuple[int, int, int, int, int]]:
    """(first place, end, width, rows a batch, first batch) from (length, count) by falling length: a batch has the width
    of its first row, and as many rows as fit; batches that begin in one length are one range."""
    total, out = sum(n for _, n in counts), []
    at = batch = end = 0
    for length, n in counts:
        end += n
        if at < end:
            rows = max(1, min(batch_tokens // max(length, 1), max_rows))
            k = -(-(end - at) // rows)
            out.append((at, min(at + k * rows, total), length, rows, batch))
            at, batch = at + k * rows, batch + k
    return out


def length_batches(df: DataFrame, length: str, order: str, batch_tokens: int, max_rows: int, seed: int = 0) -> DataFrame:
    """(order, length, batch, width, place): rows by falling length in batches of max(1, min(batch_tokens // width,
    max_rows)), and each batch's place in a seeded shuffle. Batches follow from the histogram of lengths alone, so rows
    only need their place among those of their length."""
    counts = sorted(((int(r.n), int(r.c)) for r in df.groupBy(F.col(length).alias("n")).agg(F.count("*").alias("c")).collect()), reverse=True)  # a row a length
    spark = df.sparkSession
    longer, at = [], 0
    for n, c in counts:
        longer.append((n, at))
        at += c
    own = placed(df.select(order, length), length, [order], "r").join(F.broadcast(spark.createDataFrame(longer, f"{length} long, longer long")), length)
    ranges = spark.createDataFrame(batch_ranges(counts, batch_tokens, max_rows), "lo long, hi long, width long, rows long, first long")
    p = F.col("longer") + F.col("r") - 1
    met = own.withColumn("p", p).join(F.broadcast(ranges), (F.col("p") >= F.col("lo")) & (F.col("p") < F.col("hi")))
    batch = F.col("first") + F.floor((F.col("p") - F.col("lo")) / F.col("rows"))
    return met.select(order, length, batch.alias("batch"), "width", F.xxhash64(batch, F.lit(seed)).alias("place"))


#: Rows of a key that one task may work off one by one.
LOOP = 100_000


def _fit_one_by_one(t: pa.Table) -> pa.Table:
    """The rows of one key that fit in order, each that is too large for what is left skipped."""
    order = pc.sort_indices(t["place"])
    room, held = t["room"][0].as_py(), []
    for k, size in zip(order.to_pylist(), t["size"].take(order).to_pylist(), strict=True):
        if size <= room:
            room -= size
            held.append(k)
    return t.select(["key", "place"]).take(pa.array(held, pa.int64()))


def fitting(df: DataFrame, key: str, order: str, size: str, budget: int) -> DataFrame:
    """(key, order) of the rows that a budget takes in order: a row that doesn't fit is skipped, a later smaller one may fit.

    A round takes each key's rows up to the first that doesn't fit, which is a running sum by ranges; after it only rows
    that fit into what is left stay in question. Keys with few of them are worked off one by one, so no task holds more
    than LOOP rows of a key, and rounds are few unless many sizes lie just above what is left."""
    rows = df.select(F.col(key).alias("key"), F.col(order).alias("place"), F.col(size).cast("long").alias("size"))
    left, taken = dedup.written(rows.where(F.col("size") <= budget).withColumn("room", F.lit(budget).cast("long")), "left"), None
    while not left.isEmpty():
        n = left.groupBy("key").agg(F.count("*").alias("n"))
        small = dedup.written(left.join(n.where(F.col("n") <= LOOP).select("key"), "key", "left_semi").groupBy("key").applyInArrow(_fit_one_by_one, left.select("key", "place").schema), "taken")
        large = left.join(n.where(F.col("n") > LOOP).select("key"), "key", "left_semi")
        if not large.isEmpty():
            run = dedup.written(with_prefix(large, "key", ["place"], F.col("size"), "before").withColumn("over", F.col("before") + F.col("size") > F.col("room")), "runs")
            ends = run.groupBy("key").agg(F.min(F.when(F.col("over"), F.col("place"))).alias("miss"), F.sum(F.when(~F.col("over"), F.col("size"))).alias("used"))
            run = run.join(F.broadcast(ends), "key")
            small = small.unionByName(run.where("not over").select("key", "place"))
            rest = run.where(F.col("place") > F.col("miss")).withColumn("room", F.col("room") - F.coalesce("used", F.lit(0)))
            left = dedup.written(rest.where(F.col("size") <= F.col("room")).select("key", "place", "size", "room"), "left")
        else:
            left = left.limit(0)
        taken = small if taken is None else taken.unionByName(small)
    taken = rows.select("key", "place").limit(0) if taken is None else taken
    return taken.select(F.col("key").alias(key), F.col("place").alias(order))


def epoch_windows(spark: SparkSession, n: int, seed: int, epoch: int, workers: int = 1, start: int = 0) -> DataFrame:
    """(place, window, worker) of an epoch from a place on: each window once, dealt to workers in turn. Nothing is sorted, so
    a run that resumes at a place begins there."""
    rows = spark.range(start, n).withColumnRenamed("id", "place")
    return rows.select("place", permute.window_at("place", n, seed, epoch).alias("window"), (F.col("place") % workers).alias("worker"))


def step_continuity(rows: DataFrame, run: str, order: list[str], step: str, start: str | None = None) -> DataFrame:
    """(run, breaks, resumed): how often a run's step falls below the one before in file order, and whether the step that it
    resumed at (the column `start`, null: it began anew) is among its steps."""
    before = F.lag(step).over(Window.partitionBy(run).orderBy(*order))
    resumed = F.bool_or(F.col(start).isNull() | (F.col(step) == F.col(start))) if start else F.lit(True)
    return rows.withColumn("__p", before).groupBy(run).agg(F.count_if(F.col("__p") > F.col(step)).alias("breaks"), resumed.alias("resumed"))


def hash_sample(df: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """Per key the k rows with the least sha256 of key, a zero byte and text."""
    return top_k(df, [key], [F.sha2(F.concat_ws("\0", key, text), 256)], k)


def evenly_spaced(df: DataFrame, order: list[str], n: int, rounding: str = "floor") -> DataFrame:
    """n rows evenly spaced over an ordered catalogue: floor(i (N-1)/(n-1)); rounding='even': round half even, n = 1 the middle.

    Places come by ranges of the order, so no task ranks the whole catalogue."""
    total = df.count()
    if not total:
        return df
    if n == 1:
        wanted = [0 if rounding == "floor" else (total - 1) // 2]
    else:
        wanted = sorted({(i * (total - 1)) // (n - 1) if rounding == "floor" else round(i * (total - 1) / (n - 1)) for i in range(n)})
    rows = df.withColumn("__one", F.lit(1))
    return placed(rows, "__one", order, "__r").where((F.col("__r") - 1).isin(wanted)).drop("__one", "__r")


def largest_remainder(df: DataFrame, total: Column, fraction: str, name: str, by: list[str], tie: str = "fraction") -> DataFrame:
    """Integer quotas that add up to the total: floors, then one each to the largest remainders.

    tie 'fraction': the larger fraction, then the name; 'name': the name; 'descending': names from last to first; 'minimum':
    one of the total for each name first, then remainders with names from last to first; 'half_even': rounded quotas, and
    what they miss goes to the largest fraction (ties: the name)."""
    if tie == "half_even":
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
        part = df.withColumn("__own", F.bround(F.round(F.col(fraction) * total, 9)).cast("long")).withColumn("__drift", total - F.sum("__own").over(w))
        part = part.withColumn("__r", F.row_number().over(w.orderBy(F.col(fraction).desc(), F.col(name))))
        return part.withColumn("quota", (F.col("__own") + F.when(F.col("__r") == 1, F.col("__drift")).otherwise(0)).cast("long")).drop("__own", "__drift", "__r")
    if tie == "minimum":
        w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
        rest = df.withColumn("__n", F.count("*").over(w))
        return largest_remainder(rest, total - F.col("__n"), fraction, name, by, "descending").withColumn("quota", F.col("quota") + 1).drop("__n")
    own = F.round(F.col(fraction) * total, 9)
    part = df.withColumn("__floor", F.floor(own)).withColumn("__rest", F.round(own - F.floor(own), 9))
    ties = {"fraction": [F.col(fraction).desc(), F.col(name)], "name": [F.col(name)], "descending": [F.col(name).desc()]}[tie]
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    part = part.withColumn("__drift", total - F.sum("__floor").over(w)).withColumn("__r", F.row_number().over(w.orderBy(F.col("__rest").desc(), *ties)))
    return part.withColumn("quota", (F.col("__floor") + F.when(F.col("__r") <= F.col("__drift"), 1).otherwise(0)).cast("long")).drop("__floor", "__rest", "__drift", "__r")


def pack_windows(df: DataFrame, shard: str, order: list[str], tokens: str, size: int) -> DataFrame:
    """Complete windows of `size` tokens over a shard's documents in order; the rest of the shard is dropped."""
    n = F.size(tokens)
    at = with_prefix(df, shard, order, n, "at").withColumn("n", n).where("n > 0")
    parts = at.select(shard, "at", "n", tokens, F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size))).alias("window"))
    lo = F.greatest(F.col("at"), F.col("window") * size)
    hi = F.least(F.col("at") + F.col("n"), (F.col("window") + 1) * size)
    cut = parts.select(shard, "window", lo.alias("lo"), F.slice(tokens, (lo - F.col("at") + 1).cast("int"), (hi - lo).cast("int")).alias("part"))
    whole = cut.groupBy(shard, "window").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("lo", "part"))), lambda s: s["part"])).alias("tokens"))
    return whole.where(F.size("tokens") == size)


def split_long(tokens: Column, most: int, least: int) -> Column:
    """Chunks of at most `most` tokens; a shorter last one than `least` joins the one before."""
    n = F.size(tokens)
    whole = F.greatest(F.floor(n / most), F.lit(1)).cast("int")
    tail = n - whole * most
    count = F.when((n > most) & (tail >= least), whole + 1).otherwise(whole)
    end = lambda i: F.when(i == count, n).otherwise(i * most)
    return F.transform(F.sequence(F.lit(1), count), lambda i: F.slice(tokens, (i - 1) * most + 1, F.greatest(end(i) - (i - 1) * most, F.lit(0))))
