"""Counters, profiles and check tables of a corpus job, as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import windows


def by_dimension(df: DataFrame, dimensions: list[str], **measures: Column) -> DataFrame:
    """(dimension, value, measures) for each dimension in one scan: GROUPING SETS, then the name of the set's column."""
    own = df.select(*[F.col(d).cast("string").alias(d) for d in dimensions], *[m.alias(f"__{n}") for n, m in measures.items()])
    sets = [[F.col(d)] for d in dimensions]
    rows = own.groupingSets(sets, *dimensions).agg(*[F.sum(f"__{n}").alias(n) for n in measures], *[F.grouping(d).alias(f"__g_{d}") for d in dimensions])
    name = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.lit(d)) for d in dimensions])
    value = F.coalesce(*[F.when(F.col(f"__g_{d}") == 0, F.col(d)) for d in dimensions])
    return rows.select(name.alias("dimension"), value.alias("value"), *measures)


def token_profile(df: DataFrame) -> DataFrame:
    """Documents, tokens and bytes by sixteen dimensions of a corpus with the columns split, source, revision, repo_id,
    license, language, domain, n_chars, mix_bucket, timestamp, user_taxonomy, tokens (with the end mark) and bytes."""
    year = T.document_year("timestamp")
    own = {
        "source_revision": F.concat_ws("@", "source", "revision"),
        "character_length_bucket": T.length_bucket("n_chars"),
        "token_length_bucket": T.token_length_bucket("tokens"),
        "document_time_year": year,
        "source_document_time_year": F.concat_ws("|", "source", year),
        "source_user_taxonomy": F.concat_ws("|", "source", "user_taxonomy"),
        "source_split": F.concat_ws("|", "source", "split"),
        "mix_bucket_split": F.concat_ws("|", "mix_bucket", "split"),
    }
    plain = ["split", "source", "repo_id", "license", "language", "domain", "mix_bucket", "user_taxonomy"]
    return by_dimension(df.withColumns(own), [*plain, *own], docs=F.lit(1), tokens=F.col("tokens").cast("long"), bytes=F.col("bytes").cast("long"))


def memorised(rows: DataFrame, text: str, threshold: int = 50) -> DataFrame:
    """(skeleton, n) of the texts' skeletons that occur so often."""
    return rows.groupBy(T.skeleton(text).alias("skeleton")).agg(F.count("*").alias("n")).where(F.col("n") >= threshold)


def digest_by(rows: DataFrame, key: str, part: Column, order: Column, value: Column) -> DataFrame:
    """(key, digest): sha256 over the digests of a key's parts in order, each over its values in order, so that no row
    holds more than a part or the parts' digests."""
    parts = rows.groupBy(key, part.alias("p")).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.cast("string").alias("v")))).alias("h"))
    each = parts.select(key, "p", F.sha2(F.array_join(F.transform("h", lambda x: x["v"]), ","), 256).alias("d"))
    whole = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("p", "d"))).alias("h"))
    return whole.select(key, F.sha2(F.array_join(F.transform("h", lambda x: x["d"]), ","), 256).alias("digest"))


def manifest_check(quotas: DataFrame, composite: DataFrame, supply: DataFrame, files: DataFrame, key: str, width: int = 4) -> DataFrame:
    """Per key: whether composite quotas add up to its quota, its supply holds it, and its files have `width` bytes a token."""
    parts = composite.groupBy(key).agg(F.sum("quota").alias("parts"))
    size = files.groupBy(key).agg(F.bool_and(F.col("bytes") == width * F.col("tokens")).alias("bytes_agree"))
    j = quotas.join(parts, key, "left").join(supply, key, "left").join(size, key, "left")
    return j.select(key, F.col("parts").eqNullSafe(F.col("quota")).alias("quotas_agree"), F.coalesce(F.col("quota") <= F.col("supply"), F.lit(False)).alias("supply_holds"), F.coalesce("bytes_agree", F.lit(False)).alias("bytes_agree"))


def lineage_check(marks: DataFrame, stages: list[str]) -> DataFrame:
    """Per label of (label, stage, fingerprint): whether every stage has a fingerprint, those there are equal, and both."""
    of = [F.max(F.when(F.col("stage") == s, F.col("fingerprint"))).alias(f"s{k}") for k, s in enumerate(stages)]
    names = [f"s{k}" for k in range(len(stages))]
    wide = marks.groupBy("label").agg(*of, F.countDistinct("fingerprint").alias("n"))
    complete = F.greatest(*[F.col(c).isNull() for c in names]) == F.lit(False)
    return wide.select("label", (F.col("n") == 1).alias("equal"), complete.alias("complete"), ((F.col("n") == 1) & complete).alias("passed"))


def classifier_metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Rates from the four counts; an empty denominator gives 0."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    f1 = lambda t, p, n: ratio(2 * t, 2 * t + p + n)
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "balanced_accuracy": (ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2,
        "macro_f1": (f1(tp, fp, fn) + f1(tn, fn, fp)) / 2,
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": f1(tp, fp, fn),
    }


def confusion(label: Column, hit: Column) -> list[Column]:
    return [F.count_if((label == a) & (hit == bool(b))).alias(n) for n, a, b in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))]


def threshold_table(scores: DataFrame, steps: int = 181, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Counts at every threshold from a histogram of scores by the thresholds they reach, added up from above."""
    from pyspark.sql import Window

    width = (high - low) / (steps - 1)
    cell = F.least(F.greatest(F.floor((F.col("score") - low) / width + 1e-9), F.lit(-1)), F.lit(steps - 1))
    cells = scores.groupBy(cell.alias("k")).agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    grid = scores.sparkSession.range(-1, steps).select(F.col("id").alias("k"))
    full = grid.join(cells, "k", "left").na.fill(0, ["p", "n"])
    above = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(1))
    tp, fp = F.sum("p").over(above), F.sum("n").over(above)
    rows = full.select("k", tp.alias("tp"), fp.alias("fp"), (F.sum("p").over(every) - tp).alias("fn"), (F.sum("n").over(every) - fp).alias("tn")).where("k >= 0")
    return rows.withColumn("threshold", F.round(low + F.col("k") * width, 6))


def checks(df: DataFrame, *named: tuple[str, Column]) -> DataFrame:
    """(name, passed) of a one-row table, with `all` at the end."""
    each = [F.struct(F.lit(n).alias("name"), c.alias("passed")) for n, c in named]
    total = named[0][1]
    for _, c in named[1:]:
        total = total & c
    return df.select(F.inline(F.array(*each, F.struct(F.lit("all").alias("name"), total.alias("passed")))))


def audit_summary(rows: DataFrame, flags: str, metric: str, order: str, k: int) -> DataFrame:
    """(flag, n, longest, mean, examples): per flag its rows, the metric's largest value and mean, and the k rows of the
    largest metric."""
    each = rows.select(order, metric, F.explode(flags).alias("flag"))
    some = windows.top_k(each, ["flag"], [F.desc(metric), F.col(order)], k).groupBy("flag").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col(metric)).alias("m"), F.col(order).alias("o")))), lambda x: x["o"]).alias("examples"))
    return each.groupBy("flag").agg(F.count("*").alias("n"), F.max(metric).alias("longest"), F.avg(metric).alias("mean")).join(some, "flag")


def perplexities(batches: DataFrame, most: float = 50.0) -> DataFrame:
    """(dataset, ppl) from (dataset, loss, tokens), weighted by supervised tokens (plain mean without any), and their mean."""
    weighted = F.when(F.sum("tokens") > 0, F.sum(F.col("loss") * F.col("tokens")) / F.sum("tokens")).otherwise(F.avg("loss"))
    each = batches.groupBy("dataset").agg(F.round(F.exp(F.least(weighted, F.lit(most))), 6).alias("ppl"))
    return each.unionByName(each.agg(F.lit("mean").alias("dataset"), F.round(F.avg("ppl"), 6).alias("ppl")))


def probe_summary(rows: DataFrame) -> DataFrame:
    """(name, value) of probes with loop, distinct4, chars, eos, judge and flags: rates, means, medians, then flags by count."""
    one = rows.agg(
        F.avg(F.col("eos").cast("double")).alias("eos_rate"), F.avg("loop").alias("loop_mean"), F.avg((F.col("loop") > 0.25).cast("double")).alias("loop_gt_25"), F.avg("distinct4").alias("distinct4_mean"),
        F.avg((F.col("chars") == 0).cast("double")).alias("empty_rate"), F.median("chars").cast("double").alias("median_chars"), F.avg("judge").alias("judge_mean"), F.median("judge").alias("judge_median"),
        F.avg((F.col("judge") >= 70).cast("double")).alias("pass_70"), F.avg((F.col("judge") < 50).cast("double")).alias("broken_50"),
    )
    measures = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.round(c, 6).alias("value")) for c in one.columns])))
    flags = rows.select(F.explode("flags").alias("f")).groupBy(F.concat(F.lit("flag:"), "f").alias("name")).agg(F.count("*").cast("double").alias("value"))
    return measures.unionByName(flags)


def rft_select(samples: DataFrame, repetition: float, anchor_floor: float, floor: float, ceiling: float, gain: float) -> DataFrame:
    """(prompt_id, best, reason) from samples (prompt_id, index, judge, repetition, eos, reward, anchor): the clean sample
    of the largest reward, and why its group is left out. Anchors have a floor of their own; others must not be good
    already, and the best must be better than the mean."""
    clean = F.col("eos") & (F.col("repetition") <= repetition)
    best = F.max(F.when(clean, F.struct("reward", "index", "judge")))
    g = samples.groupBy("prompt_id").agg(best.alias("b"), F.avg("judge").alias("mean"), F.bool_or("anchor").alias("anchor"))
    judge, fuel = F.col("b.judge"), ~F.col("anchor")
    why = (
        F.when(F.col("b").isNull(), "no_clean_sample")
        .when(F.col("anchor") & (judge < anchor_floor), "anchor_below_floor")
        .when(fuel & (judge < floor), "best_below_floor")
        .when(fuel & (F.col("mean") > ceiling), "fuel_group_already_good")
        .when(fuel & (judge - F.col("mean") < gain), "no_gain")
        .otherwise("kept")
    )
    return g.select("prompt_id", F.col("b.index").alias("best"), why.alias("reason"))


def rewards(rows: DataFrame) -> DataFrame:
    """With repetition and reward from loop, distinct4, coherence, responsive, empty and finished: one less repetition, and
    coherence, and half of responsiveness, less one for an empty text and half for an unfinished one."""
    loop = F.col("loop")
    few = F.greatest(F.lit(0.0), 1 - F.col("distinct4") / 0.6)
    own = rows.withColumn("repetition", F.greatest(loop, F.when(loop < 0.2, few).otherwise(loop)))
    less = F.when(F.col("empty"), 1.0).otherwise(0.0) + F.when(F.col("finished"), 0.0).otherwise(0.5)
    return own.withColumn("reward", (1 - F.col("repetition")) + F.col("coherence") + 0.5 * F.col("responsive") - less)


def run_summary(rows: DataFrame, run: str, order: str, value: str, end: str, k: int) -> DataFrame:
    """Per run: means of the first and last k rows and what was gained, the largest value, the mean after the first k, bad
    values, and whether its last row is an end mark. Ranks stop at k, so no task sorts a whole run."""
    some = lambda by, name: windows.top_k(rows, [run], [by], k).groupBy(run).agg(F.avg(value).alias(name), F.sum(value).alias(f"__{name}"), F.count(value).alias(f"__n_{name}"))
    bad = F.col(value).isNull() | F.isnan(value)
    every = rows.groupBy(run).agg(F.max(value).alias("highest"), F.sum(value).alias("__sum"), F.count(value).alias("__n"), F.count_if(bad).alias("bad"), F.max_by(end, order).alias("completed"))
    j = every.join(some(F.col(order), "first"), run).join(some(F.desc(order), "last"), run)
    rest = F.col("__n") - F.col("__n_first")
    steady = F.when(rest > 0, (F.col("__sum") - F.col("__first")) / rest)
    gained = F.col("first") - F.col("last")
    return j.select(run, F.round("first", 6).alias("first"), F.round("last", 6).alias("last"), F.round(gained, 6).alias("improvement"), "highest", F.round(steady, 6).alias("steady"), "bad", "completed")


def health(rows: DataFrame, split: str, order: str, k: int) -> DataFrame:
    """(split, samples, poison, repeated, flagged, safe_rate, examples) per split, the first k flagged rows as examples,
    and a row `mean` of the splits' safe rates."""
    flagged = F.col("poison") | F.col("repeated")
    some = windows.top_k(rows.where(flagged), [split], [F.col(order)], k).groupBy(split).agg(F.array_sort(F.collect_list(order)).alias("examples"))
    each = rows.groupBy(split).agg(F.count("*").alias("samples"), F.count_if("poison").alias("poison"), F.count_if("repeated").alias("repeated"), F.count_if(flagged).alias("flagged"))
    each = each.withColumn("safe_rate", F.round(1 - F.col("flagged") / F.col("samples"), 6)).join(some, split, "left")
    total = each.agg(F.lit("mean").alias(split), *[F.sum(c).alias(c) for c in ("samples", "poison", "repeated", "flagged")], F.round(F.avg("safe_rate"), 6).alias("safe_rate"))
    return each.unionByName(total, allowMissingColumns=True)


def trajectory(parts: dict[str, DataFrame]) -> DataFrame:
    """A row a step, a column a report (each a table of step and value), null where a report lacks the step. A report with
    two rows of a step is an error."""
    out = None
    for name, rows in parts.items():
        twice = F.raise_error(F.concat(F.lit(f"{name}: two rows of step "), F.col("step").cast("string"))).cast("double")
        own = rows.groupBy("step").agg(F.count("*").alias("n"), F.first("value").alias("v")).select("step", F.when(F.col("n") > 1, twice).otherwise(F.col("v")).alias(name))
        out = own if out is None else out.join(own, "step", "full_outer")
    return out


def spread_at_least(x: Column, least: int) -> Column:
    """Whether the standard deviation of a group's values is `least` or more. Whole hundredths are compared in exact numbers,
    so a group that lies on the bound is judged alike whatever the order of its rows; other values by stddev_pop."""
    h = F.round(x * 100)
    n, ones, squares = F.count(x), F.sum(h), F.sum(h * h)
    exact = F.bool_and(h / 100 == x) & (n * squares <= 2.0**53)
    return F.when(exact, n * squares - ones * ones >= F.lit(10_000.0 * least * least) * n * n).otherwise(F.stddev_pop(x) >= least)
