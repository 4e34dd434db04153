"""URL filters (2), native: allow and block rules, and association rules over URL tokens for the rest.

A url's host and path are cut out by SQL functions. Given rules (a host and a path prefix each) apply to the host and
its subdomains; the longest that fits decides. For the other urls Spark's FP-growth mines combinations of URL tokens
(host labels, path words, query keys; numbers are left out) from labelled pages: a page's label is that of the document
that its url names by number. A rule needs `SUPPORT` of the labelled pages and `LEAST` pages at least, and its
confidence counts by the lower end of its 95% interval, so that a few pages prove nothing; a rule is pruned if a part of
it is as sure. Tokens on fewer pages than a rule needs are left out before mining, as no rule can hold them, and of tokens
that stand on the same pages (by the count and two sums of hashes of pages) the first by name stands for all: a rule with
another of them is as sure, and such tokens, as a site's frame has them, would only multiply combinations. A page gives
all its other tokens, however many.

Rules to block are matched by an inverted index: each stands under its rarest token, a set of tokens meets the rules of
its tokens only, and every rule met is verified against the whole set. Distinct sets are matched once, however many urls
share them. No rule met: allow.

Rows: a null url, or one without ://, has empty host and path, no tokens and is allowed. Pages that repeat a page_id
are judged each. Null labels aren't used; without labels nothing is mined. Of several rules met the surest counts. Other
columns are dropped, whatever their names. An empty table gives none.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize

#: The contract's rules: whether they block, and host and path prefix.
RULES = ((False, "org", "/"), (True, "example.org", "/es/"), (True, "example.org", "/en/1"), (False, "com", "/fr/"), (True, "com", "/de/"))
SUPPORT, LEAST, CONFIDENCE, LIFT = 0.002, 20, 0.8, 2.0
#: Normal quantile of the 95% interval; most rules of which the index is broadcast (a few kilobytes each at most).
QUANTILE, SMALL = 1.96, 10_000
BLOCK = "label=block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path) by the contract."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    out = pages.select("page_id", "url", F.coalesce(rest, F.lit("")).alias("rest"))
    out = out.withColumn("host", F.regexp_extract("rest", r"^[^/?#]*", 0))
    out = out.withColumn("path", F.regexp_extract(F.expr("substring(rest, length(host) + 1)"), r"^[^?#]*", 0))
    return out.select("page_id", "url", "rest", F.translate("host", _UPPER, _LOWER).alias("host"), "path")


def fitting_rule(rules=RULES) -> Column:
    """The longest rule that fits host and path, as a struct of its string and whether it blocks; null if none does."""
    out = F.lit(None).cast("struct<rule: string, block: boolean>")
    for block, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(block).alias("block"))).otherwise(out)
    return out


def tokens() -> Column:
    """Distinct tokens of a url: host labels, path words and query keys."""
    words = lambda text, kind: F.transform(F.filter(F.split(F.lower(text), r"[^\p{L}-]+"), lambda w: w != ""), lambda w: F.concat(F.lit(kind), w))
    keys = F.transform(F.regexp_extract_all("rest", F.lit(r"[?&]([^=&#]+)"), F.lit(1)), lambda w: F.concat(F.lit("query="), F.lower(w)))
    return F.array_sort(F.array_distinct(F.concat(words(F.col("host"), "host="), words(F.col("path"), "path="), keys)))


def surely(confidence: Column, n: Column) -> Column:
    """The lower end of the (Wilson) interval of a share of n."""
    z = QUANTILE * QUANTILE
    spread = QUANTILE * F.sqrt(confidence * (1 - confidence) / n + z / (4 * n * n))
    return (confidence + z / (2 * n) - spread) / (1 + z / n)


def mine(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT, least: int = LEAST) -> DataFrame:
    """(rule_tokens, confidence, lift, support, pages) of what speaks for blocking; pages: those that hold the tokens."""
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    bad = known.groupBy("doc_id").agg(F.max(F.expr("coalesce(quality = 0, false) or coalesce(toxic = 1, false)")).alias("bad"))
    named = parts(pages).withColumn("doc_id", F.regexp_extract("path", r"/(\d{1,18})(?:\D|$)", 1).try_cast("long")).where("doc_id is not null")
    rows = materialize(named.join(bad, "doc_id").select(F.xxhash64("page_id", "url").alias("page"), "bad", tokens().alias("tokens")), "labelled")
    n = rows.count()
    need = max(least, -(-int(support * n * 1_000_000) // 1_000_000))
    each = rows.select("page", "bad", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n"), *[F.sum(F.xxhash64("page", F.lit(k)).bitwiseAND(F.lit((1 << 40) - 1))).alias(f"pages{k}") for k in (1, 2)]).where(F.col("n") >= need)
    often = often.groupBy("n", "pages1", "pages2").agg(F.min("token").alias("token")).select("token")
    held = each.join(often, "token").groupBy("page", "bad").agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    items = F.concat("tokens", F.when(F.col("bad"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>")))
    baskets = materialize(held.select(items.alias("items")), "baskets")
    if n < need or baskets.isEmpty():
        return rows.sparkSession.createDataFrame([], "rule_tokens array<string>, confidence double, lift double, support double, pages long")
    m = baskets.count()
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, need * confidence / m), minConfidence=confidence).fit(baskets).associationRules
    rules = found.where((F.element_at("consequent", 1) == BLOCK) & (F.col("lift") >= lift)).withColumn("pages", F.round(F.col("support") * m / F.col("confidence")).cast("long"))
    rules = rules.select(F.array_sort("antecedent").alias("rule_tokens"), surely(F.col("confidence"), F.col("pages")).alias("confidence"), "lift", "support", "pages")
    rules = materialize(rules.where((F.col("pages") >= need) & (F.col("confidence") >= confidence)), "found-rules")
    # A rule that holds a shorter one as sure says nothing more.
    met = indexed(rules.select(F.col("rule_tokens").alias("tokens")), rules)
    shorter = met.where("rule_tokens <> tokens").groupBy("tokens").agg(F.max("confidence").alias("without"))
    kept = rules.join(shorter.withColumnRenamed("tokens", "rule_tokens"), "rule_tokens", "left")
    return kept.where("without is null or without < confidence").drop("without")


def indexed(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, rule_tokens, confidence): the rules that each distinct set of tokens holds, itself among them."""
    each = sets.select("tokens", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("n"))
    rules = rules.withColumn("rule", F.xxhash64("rule_tokens")).select("rule", "rule_tokens", "confidence")
    under = rules.select("*", F.explode("rule_tokens").alias("token")).join(often, "token").groupBy("rule").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    index = rules.join(under, "rule").drop("rule")
    if rules.count() <= SMALL:
        index = F.broadcast(index)
    return each.join(index, "token").where(F.size(F.array_except("rule_tokens", "tokens")) == 0).select("tokens", "rule_tokens", "confidence")


def judge(pages: DataFrame, mined: DataFrame, rules=RULES) -> DataFrame:
    """Per page: page_id, host, path, rule (null if none fits), verdict, and the confidence of the mined rule that was met."""
    rows = parts(pages).withColumn("fit", fitting_rule(rules))
    given, rest = rows.where("fit is not null"), rows.where("fit is null").withColumn("tokens", tokens())
    sets = materialize(rest.groupBy("tokens").agg(F.count("*").alias("n")), "token-sets")
    met = indexed(sets.select("tokens"), materialize(mined, "rules")).groupBy("tokens").agg(F.max("confidence").alias("mined_confidence"))
    named = materialize(sets.join(met, "tokens", "left"), "judged-sets")
    out = given.withColumn("mined_confidence", F.lit(None).cast("double")).unionByName(join_hot(rest, named, "tokens").drop("tokens"))
    block = F.coalesce(F.col("fit")["block"], F.col("mined_confidence").isNotNull())
    return out.select("page_id", "host", "path", F.col("fit")["rule"].alias("rule"), F.when(block, "block").otherwise("allow").alias("verdict"), "mined_confidence")
