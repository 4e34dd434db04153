"""Candidate corpora: cleaned, met with earlier corpora, scored and labelled; their profile, and derivatives by topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dedup, filters, joins, learned


def admitted(rows: DataFrame, old: DataFrame, order: str, language: str, overlap: str = "exclude", text: str = "text") -> DataFrame:
    """Every row with its cleaned text and `reason`: why cleaning drops it, legacy_exact_overlap, legacy_near_overlap, or ''.

    old: an earlier corpus with the same text column, cleaned alike. overlap: report keeps rows that it has and only marks
    them. Added besides: upstream_text_sha256 (of the text as it came), document_sha256 (of the comparison form), sig,
    legacy_exact_overlap and legacy_near_overlap. The order must name a row. A null text is judged as an empty one."""
    raw = F.coalesce(F.col(text), F.lit(""))
    clean, why = filters.clean_document(raw, F.col(language))
    own = rows.withColumns({"upstream_text_sha256": F.sha2(raw, 256), "__clean": clean, "reason": why}).withColumn(text, F.col("__clean"))
    own = dedup.written(_marked(own, text), "candidates")
    cleaned, _ = filters.clean_document(F.coalesce(F.col(text), F.lit("")), F.lit(""))
    have = dedup.written(_marked(old.select(cleaned.alias("__clean")), "__clean").select("document_sha256", "sig"), "earlier")
    passed = own.where("reason = ''")
    exact = have.select("document_sha256").distinct().withColumn("__exact", F.lit(True))
    near = joins.near_overlap(passed.select(order, "sig"), have.select("sig"), order).withColumn("__near", F.lit(True))
    j = own.join(exact, "document_sha256", "left").join(near, order, "left")
    judged = F.col("reason") == ""
    j = j.withColumns({"legacy_exact_overlap": judged & F.col("__exact").isNotNull(), "legacy_near_overlap": judged & F.col("__exact").isNull() & F.col("__near").isNotNull()})
    if overlap == "exclude":
        again = F.when(F.col("legacy_exact_overlap"), "legacy_exact_overlap").when(F.col("legacy_near_overlap"), "legacy_near_overlap")
        j = j.withColumn("reason", F.coalesce(again, F.col("reason")))
    return j.drop("__exact", "__near", "__clean")


def _marked(df: DataFrame, text: str) -> DataFrame:
    return dedup.signed(df, text).withColumn("document_sha256", F.sha2("key", 256)).drop("key", "chunks")


def scored(rows: DataFrame, model: learned.Quality, least: float) -> DataFrame:
    """Admitted rows without a reason, with `score`, `accepted` (a score of `least` or more) and `topic`."""
    own = learned.score_quality(rows.where("reason = ''"), model)
    return own.withColumns({"accepted": F.coalesce(F.col("score") >= least, F.lit(True)), "topic": filters.taxonomy(F.col("text"))})


def duplicates(rows: DataFrame, order: str) -> DataFrame:
    """One row: `exact`, rows whose document_sha256 an earlier row has, and `near`, others with an earlier near copy."""
    first = rows.groupBy("document_sha256").agg(F.min(order).alias(order), F.count("*").alias("n"), F.min_by("sig", order).alias("sig"))
    first = dedup.written(first, "distinct")
    signs = first.where(F.size("sig") == dedup.COORDINATES).groupBy("sig").agg(F.min(order).alias(order), F.count("*").alias("n"))
    late = dedup.near_pairs(first.select(order, "sig"), order, measure=dedup.overlap).select(F.col("b").alias(order)).distinct()
    near = signs.join(late.withColumn("__late", F.lit(1)), order, "left").agg(F.coalesce(F.sum(F.col("n") - 1 + F.coalesce("__late", F.lit(0))), F.lit(0)).alias("near"))
    return first.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("exact")).crossJoin(F.broadcast(near))


#: Shares of the scores at which a profile states them, and the accuracy (one part in so many) at which it does.
QUANTILES, ACCURACY = (0.0, 0.1, 0.5, 0.9, 1.0), 10_000


def profile(every: DataFrame, kept: DataFrame, order: str, tokens: Column) -> DataFrame:
    """(part, name, value) of a candidate corpus: rows by drop reason, documents and tokens (with an end mark) by topic, of
    all and of accepted rows, counts of acceptance and of duplicates within, and quantiles of the scores.

    every: what `admitted` gives; kept: what `scored` gives of it, written, as it is read several times."""
    reasons = every.groupBy(F.col("reason").alias("name")).agg(F.count("*").cast("double").alias("value")).where("name <> ''")
    own = kept.select("topic", "accepted", (tokens + 1).alias("n"))
    g = own.groupBy("topic").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), F.count_if("accepted").alias("accepted_docs"), F.coalesce(F.sum(F.when(F.col("accepted"), F.col("n"))), F.lit(0)).alias("accepted_tokens"))
    named = lambda c: F.struct(F.lit(f"topic_{c}").alias("part"), F.col("topic").alias("name"), F.col(c).cast("double").alias("value"))
    topics = g.select(F.inline(F.array(*[named(c) for c in g.columns if c != "topic"])))
    marks = F.percentile_approx("score", F.array(*map(F.lit, QUANTILES)), ACCURACY)
    one = kept.agg(F.count("*").alias("documents"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("refused"), marks.alias("m"))
    one = one.crossJoin(F.broadcast(duplicates(kept, order)))
    value = lambda part, name, c: F.struct(F.lit(part).alias("part"), F.lit(name).alias("name"), c.cast("double").alias("value"))
    counts = [value("count", c, F.col(c)) for c in ("documents", "accepted", "refused", "exact", "near")]
    scores = [value("score", f"p{round(100 * q)}", F.round(F.get("m", F.lit(k)), 6)) for k, q in enumerate(QUANTILES)]
    return reasons.select(F.lit("dropped").alias("part"), "name", "value").unionByName(topics).unionByName(one.select(F.inline(F.array(*counts, *scores))))


def derivative(kept: DataFrame, topics: list[str], gates: dict[str, Column]) -> DataFrame:
    """Scored rows with `reason`: quality_proxy for refused ones, other_topic outside the topics, low_precision where the
    topic has a gate that the text doesn't pass, else '' for the rows of the derivative. All columns stay, lineage too."""
    passes = F.lit(True)
    for topic, gate in gates.items():
        passes = F.when(F.col("topic") == topic, gate).otherwise(passes)
    rules = [(~F.col("accepted"), "quality_proxy"), (~F.col("topic").isin(*topics), "other_topic"), (~passes, "low_precision")]
    return kept.withColumn("reason", filters.reason(*rules))
