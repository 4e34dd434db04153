"""Mixture policies: group targets with fallback, limits, what remains of a plan, extensions that only append.

A policy is a handful of groups and limits, which the driver holds; supplies and shares stay tables, one row a source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import windows


@dataclass(frozen=True)
class Group:
    """A share of the total, the group that takes what this one can't supply, and whether sources are filled one after
    another (by name) instead of in proportion to their supply."""

    name: str
    fraction: float
    fallback: str = ""
    fill: bool = False


@dataclass(frozen=True)
class Limit:
    """A least or an exact share of some sources together."""

    name: str
    sources: tuple[str, ...]
    least: float | None = None
    exactly: float | None = None


def targets(groups: list[Group], have: dict[str, int], total: int) -> dict[str, int]:
    """Tokens of each group: floors of the fractions, the rest to the last one; shortfalls flow until nothing is short."""
    want = {g.name: int(total * g.fraction) for g in groups[:-1]}
    want[groups[-1].name] = total - sum(want.values())
    for _ in range(len(groups) + 1):
        short = [(g, want[g.name] - have.get(g.name, 0)) for g in groups if want[g.name] > have.get(g.name, 0)]
        if not short:
            return want
        for g, lack in short:
            if g.fallback not in want or g.fallback == g.name:
                raise ValueError(f"{g.name} lacks {lack} tokens and has no group to take them")
            want[g.name] -= lack
            want[g.fallback] += lack
    raise ValueError("the groups together can't supply the total")


def materialized(supply: DataFrame, groups: list[Group], total: int) -> DataFrame:
    """(source, group, target) from (source, tokens, group). What rounding leaves goes to a group's last source by name."""
    have = {r.group: int(r.s) for r in supply.groupBy("group").agg(F.sum("tokens").alias("s")).collect()}  # a row a group
    want = targets(groups, have, total)
    rows = supply.sparkSession.createDataFrame([(g.name, want[g.name], g.fill) for g in groups], "group string, want long, fill boolean")
    of, by_name = Window.partitionBy("group"), Window.partitionBy("group").orderBy("source")
    before = F.coalesce(F.sum("tokens").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    filled = F.greatest(F.lit(0), F.least(F.col("tokens"), F.col("want") - before))
    share = F.floor(F.col("tokens") * F.col("want").cast("double") / F.sum("tokens").over(of))
    j = supply.join(F.broadcast(rows), "group").withColumn("own", F.when(F.col("fill"), filled).otherwise(share).cast("long"))
    last = F.row_number().over(Window.partitionBy("group").orderBy(F.desc("source"))) == 1
    drift = F.when(last & ~F.col("fill"), F.col("want") - F.sum("own").over(of)).otherwise(0)
    return j.withColumn("target", (F.col("own") + drift).cast("long")).select("source", "group", "target")


def violations(shares: DataFrame, source: str, fraction: str, most: float, limits: list[Limit]) -> DataFrame:
    """(name, passed): fractions add up to one, none is above the maximum, each limit holds, no source comes twice."""
    f = F.col(fraction)
    held = {limit.name: F.coalesce(F.sum(F.when(F.col(source).isin(*limit.sources), f)), F.lit(0.0)) for limit in limits}
    one = shares.agg(F.sum(f).alias("__sum"), F.max(f).alias("__max"), F.count("*").alias("__n"), F.countDistinct(source).alias("__sources"), *[c.alias(n) for n, c in held.items()])
    checks = [("fractions_sum_to_one", F.abs(F.col("__sum") - 1) < 1e-9), ("source_maximum", F.col("__max") <= most)]
    for limit in limits:
        own = F.col(limit.name)
        checks.append((limit.name, own >= limit.least if limit.exactly is None else F.abs(own - limit.exactly) < 1e-9))
    checks.append(("unique_only", F.col("__n") == F.col("__sources")))
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), c.alias("passed")) for n, c in checks])))


def remaining(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """(key, remaining): quota less what is done, not below zero; what that floor adds up to beyond the plan's rest is
    taken from the largest."""
    j = plan.join(done, key, "left").withColumn("done", F.coalesce("done", F.lit(0))).withColumn("own", F.greatest(F.lit(0), F.col("quota") - F.col("done")))
    every = Window.partitionBy(F.lit(1))  # a row a source
    drift = F.greatest(F.lit(0), F.sum("quota").over(every) - F.sum("done").over(every)) - F.sum("own").over(every)
    first = F.row_number().over(every.orderBy(F.desc("own"), key)) == 1
    return j.select(key, (F.col("own") + F.when(first, drift).otherwise(0)).cast("long").alias("remaining"))


def append_only(old: DataFrame, new: DataFrame, old_list: DataFrame, new_list: DataFrame, place: list[str]) -> DataFrame:
    """(kept, grown, ordered_prefix): no old row is lost, there are more rows, and the old list stands at the new one's
    beginning, place by place."""
    lost = old.exceptAll(new).agg((F.count("*") == 0).alias("kept"))
    count = lambda d, n: d.agg(F.count("*").alias(n))
    moved = old_list.join(new_list, place, "left_anti").agg((F.count("*") == 0).alias("ordered_prefix"))
    one = lost.join(moved, F.lit(True)).join(count(old, "a"), F.lit(True)).join(count(new, "b"), F.lit(True))
    return one.select("kept", (F.col("b") > F.col("a")).alias("grown"), "ordered_prefix")


def bundled(parts: list[DataFrame], name: str) -> DataFrame:
    """All rows of several manifests, a missing column as null, with `unique`: whether a name stands in them once."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumn("unique", F.count("*").over(Window.partitionBy(name)) == 1)


def disjoint(rows: DataFrame, name: str, domain: str) -> DataFrame:
    """(name, n, disjoint): in how many domains each name stands, and whether that is one."""
    per = rows.select(name, domain).distinct().groupBy(name).agg(F.count("*").alias("n"))
    return per.withColumn("disjoint", F.col("n") == 1)


def max_unique_total(shares: DataFrame, name: str, supply: str, fraction: str) -> DataFrame:
    """(total): the largest total from which on one more would ask a source for more than its supply, quotas being the
    largest remainders. Totals near the real bound are tried together: from below the least supply / fraction, where
    rounding up may already ask too much, to where even rounding down does; their number is that of the sources and 1 / the
    fraction of the scarcest."""
    wanted = shares.where(F.col(fraction) > 0)
    most = wanted.agg(F.min(F.floor(F.round(F.col(supply) / F.col(fraction), 6))).alias("lo"), F.min(F.ceil((F.col(supply) + 1) / F.col(fraction))).alias("hi"), F.count("*").alias("n"))
    each = most.select(F.col("lo"), F.explode(F.sequence(F.greatest(F.col("lo") - F.col("n") - 5, F.lit(0)), F.col("hi") + 1)).alias("total"))
    quotas = windows.largest_remainder(wanted.join(F.broadcast(each), F.lit(True)), F.col("total"), fraction, name, ["total"])
    held = quotas.groupBy("total", "lo").agg(F.bool_and(F.col("quota") <= F.col(supply)).alias("ok"))
    base = held.where("ok and total <= lo").agg(F.max("total").alias("base"))
    return held.join(F.broadcast(base), F.lit(True)).where(~F.col("ok") & (F.col("total") > F.col("base"))).agg((F.min("total") - 1).cast("long").alias("total"))
