"""Queries of aggregations, evaluation roll-ups, conversations, tokenised tables and JSON helpers."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import arrow
from ..functions import text as T
from ..operators import dedup, joins, reports, tokens, windows
from ..operators import filters as Q
from ..sources import writers


def vocabulary(name):
    """The place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def docs(spark, sf):
    return table(spark, sf, "documents")


def talks(spark, sf):
    return table(spark, sf, "conversations")


_REASON = "CASE WHEN length(text) < 200 THEN 'too_short' WHEN len(regexp_extract_all(text, '(?i)https?://|www\\.')) >= greatest(4, length(text) // 1000) THEN 'url_density' ELSE '' END"


def judged(spark, sf):
    x = F.col("text")
    return docs(spark, sf).withColumn("reason", Q.reason((F.length(x) < 200, "too_short"), (Q.url_density(x), "url_density")))


@query("a01_drop_counters", f"SELECT source, {_REASON} AS reason, count(*) AS docs FROM documents GROUP BY ALL")
def a01(spark, sf):
    return judged(spark, sf).groupBy("source", "reason").agg(F.count("*").alias("docs"))


_BUCKET = "CASE WHEN n_chars < 2000 THEN 'chars_lt_2k' WHEN n_chars < 8000 THEN 'chars_2k_8k' WHEN n_chars < 32000 THEN 'chars_8k_32k' ELSE 'chars_ge_32k' END"
_SPLIT = "CASE WHEN doc_id % 50 = 0 THEN 'val' ELSE 'train' END"


@query(
    "a02_cleaning_report",
    rf"""WITH s AS (SELECT lower(regexp_replace(text, '\s+', '', 'g')) AS k FROM benchmark), hit AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, lower(regexp_replace(text, '\s+', '', 'g')) AS t FROM documents) JOIN s ON contains(t, k) WHERE length(k) >= 24)
    SELECT dimension, value, count(*) AS docs, sum(b)::BIGINT AS bytes FROM (SELECT unnest(['lang', 'source', 'split', 'reason', 'source_split', 'source_length_bucket', 'source_reason', 'source_year', 'source_license', 'source_contaminated']) AS dimension,
    unnest([lang, source, sp, r, source || '|' || sp, source || '|' || lb, source || '|' || r, source || '|' || y, source || '|' || lic, source || '|' || c]) AS value, b FROM (SELECT lang, source, {_SPLIT} AS sp, {_BUCKET} AS lb, {_REASON} AS r, strlen(text) AS b,
    CASE WHEN doc_id % 7 = 0 THEN 'unknown' ELSE (2000 + doc_id % 25)::VARCHAR END AS y, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'cc-' || lang END AS lic, CASE WHEN doc_id IN (SELECT doc_id FROM hit) THEN 'yes' ELSE 'no' END AS c FROM documents)) GROUP BY ALL""",
)
def a02(spark, sf):
    d = judged(spark, sf).withColumn("split", F.when(F.col("doc_id") % 50 == 0, "val").otherwise("train")).withColumn("length_bucket", T.length_bucket("n_chars"))
    signatures = table(spark, sf, "benchmark").select(F.col("item_id").alias("sid"), F.lit(0).alias("rank"), F.lower(T.squeeze("text")).alias("skey"))
    hit = joins.decontaminate(docs(spark, sf).select("doc_id", F.lower(T.squeeze("text")).alias("key")), signatures).select("doc_id", F.lit("yes").alias("contaminated"))
    year = T.document_year(F.when(F.col("doc_id") % 7 == 0, "n. d.").otherwise((2000 + F.col("doc_id") % 25).cast("string")))
    d = d.join(hit, "doc_id", "left").withColumns({"contaminated": F.coalesce("contaminated", F.lit("no")), "year": year, "license": F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("cc-"), "lang"))})
    own = ("split", "length_bucket", "reason", "year", "license", "contaminated")
    d = d.withColumns({f"source_{c}": F.concat_ws("|", "source", c) for c in own})
    return reports.by_dimension(d, ["lang", "source", "split", "reason", *(f"source_{c}" for c in own)], docs=F.lit(1), bytes=F.octet_length("text").cast("long"))


@query("a03_memorised_skeletons", r"SELECT k AS skeleton, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(text, '[0-9]+|[零一二三四五六七八九十百千万两]+', '#', 'g'), '\s+', '', 'g') AS k FROM conversations WHERE turn = 0) GROUP BY k HAVING count(*) >= 50")
def a03(spark, sf):
    return reports.memorised(talks(spark, sf).where("turn = 0"), "text")


_PROFILE = ("split", "source", "source_revision", "repo_id", "license", "language", "domain", "character_length_bucket", "token_length_bucket", "mix_bucket", "document_time_year", "source_document_time_year", "user_taxonomy", "source_user_taxonomy", "source_split", "mix_bucket_split")


@query(
    "a04_token_profile",
    f"""WITH d AS (SELECT source, lang, {_SPLIT} AS split, source || '@r' || (doc_id % 3) AS rev, 'org/' || source AS repo, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'cc-' || lang END AS lic, CASE WHEN n_chars < 1000 THEN 'web' ELSE 'book' END AS domain,
    {_BUCKET} AS cb, source || ':' || lang AS mix, CASE WHEN doc_id % 7 = 0 THEN 'unknown' ELSE (2000 + doc_id % 25)::VARCHAR END AS y, {_REASON} AS tax, len(regexp_extract_all(text, '[^ \n\t\r]+')) + 1 AS n, strlen(text) AS b FROM documents),
    e AS (SELECT *, CASE WHEN n < 4096 THEN 'tokens_lt_4k' WHEN n < 8192 THEN 'tokens_4k_8k' WHEN n < 16384 THEN 'tokens_8k_16k' ELSE 'tokens_ge_16k' END AS tb FROM d)
    SELECT dimension, value, count(*) AS docs, sum(n)::BIGINT AS tokens, sum(b)::BIGINT AS bytes FROM (SELECT unnest({list(_PROFILE)}) AS dimension,
    unnest([split, source, rev, repo, lic, lang, domain, cb, tb, mix, y, source || '|' || y, tax, source || '|' || tax, source || '|' || split, mix || '|' || split]) AS value, n, b FROM e) GROUP BY ALL""",
)
def a04(spark, sf):
    return reports.token_profile(profiled(spark, sf).withColumn("tokens", T.hits("text", r"[^ \n\t\r]++") + 1).drop("text"))


def profiled(spark, sf):
    d = judged(spark, sf)
    return d.select(
        "text",
        "source",
        F.col("lang").alias("language"),
        F.when(F.col("doc_id") % 50 == 0, "val").otherwise("train").alias("split"),
        F.concat(F.lit("r"), (F.col("doc_id") % 3).cast("string")).alias("revision"),
        F.concat(F.lit("org/"), "source").alias("repo_id"),
        F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("cc-"), "lang")).alias("license"),
        F.when(F.col("n_chars") < 1000, "web").otherwise("book").alias("domain"),
        F.concat_ws(":", "source", "lang").alias("mix_bucket"),
        F.when(F.col("doc_id") % 7 == 0, "n. d.").otherwise((2000 + F.col("doc_id") % 25).cast("string")).alias("timestamp"),
        F.col("reason").alias("user_taxonomy"),
        "n_chars",
        F.octet_length("text").alias("bytes"),
    )


@query("a05_long_context_supply", "SELECT t AS at_least, count(*) AS docs, coalesce(sum(n_chars), 0)::BIGINT AS tokens FROM documents, (VALUES (4096), (8192), (16384)) v(t) WHERE n_chars >= t GROUP BY t")
def a05(spark, sf):
    n = F.col("n_chars")
    reached = F.filter(F.array(F.lit(4096), F.lit(8192), F.lit(16384)), lambda t: n >= t)
    return docs(spark, sf).select(n, F.explode(reached).alias("at_least")).groupBy("at_least").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("tokens"))


@query("a06_merge_profiles", "SELECT source, count(*) AS docs, sum(n_chars)::BIGINT AS tokens FROM documents GROUP BY source")
def a06(spark, sf):
    part = lambda r: docs(spark, sf).where(f"doc_id % 2 = {r}").groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("tokens"))
    return part(0).unionByName(part(1)).groupBy("source").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


@query(
    "a07_revision_profile",
    """SELECT event_type, year(ts) AS y, count(*) AS n, min(ts) AS first, max(ts) AS last, count(*) FILTER (WHERE ts > TIMESTAMP '2024-01-15') AS after_snapshot, count(*) FILTER (WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-01-15') BETWEEN 0 AND 365) AS within_365, count(*) FILTER (WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-01-15') BETWEEN 0 AND 730) AS within_730,
    round(count(*) FILTER (WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-01-15') BETWEEN 0 AND 365) / count(*), 6) AS share_365, round(count(*) FILTER (WHERE trim(props) <> props OR props <> lower(props)) / count(*), 6) AS changed_share FROM events GROUP BY ALL""",
)
def a07(spark, sf):
    age = F.datediff(F.lit("2024-01-15").cast("date"), F.col("ts").cast("date"))
    changed = F.lower(F.trim("props")) != F.col("props")
    within = lambda n: F.count_if(age.between(0, n))
    return table(spark, sf, "events").groupBy("event_type", F.year("ts").cast("long").alias("y")).agg(
        F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_if(F.col("ts") > F.lit("2024-01-15").cast("timestamp_ntz")).alias("after_snapshot"),
        within(365).alias("within_365"), within(730).alias("within_730"), F.round(within(365) / F.count("*"), 6).alias("share_365"), F.round(F.count_if(changed) / F.count("*"), 6).alias("changed_share"),
    )


@query("a08_score_quantiles", "SELECT event_type, round(quantile_cont(value, 0), 6) AS p0, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90, round(quantile_cont(value, 1), 6) AS p100 FROM events GROUP BY event_type")
def a08(spark, sf):
    p = F.percentile("value", F.array(*map(F.lit, (0.0, 0.1, 0.5, 0.9, 1.0))))
    return table(spark, sf, "events").groupBy("event_type").agg(p.alias("p")).select("event_type", *[F.round(F.element_at("p", k + 1), 6).alias(n) for k, n in enumerate(("p0", "p10", "p50", "p90", "p100"))])


@query(
    "a09_candidate_profile",
    f"""WITH d AS (SELECT doc_id, lang, source, n_chars, sha256(text) AS h, {_REASON} AS r FROM documents), e AS (SELECT d.*, h IN (SELECT h FROM d WHERE source = 'src1') AND source <> 'src1' AS seen, row_number() OVER (PARTITION BY h ORDER BY doc_id) > 1 AS again, coalesce(quality = 0, false) AS low
    FROM d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)), f AS (SELECT *, r = '' AND NOT seen AND NOT again AND NOT low AS ok FROM e)
    SELECT lang, count(*) AS docs, count(*) FILTER (WHERE r <> '') AS rejected, count(*) FILTER (WHERE seen) AS overlaps, count(*) FILTER (WHERE again) AS copies, count(*) FILTER (WHERE low) AS low_quality, count(*) FILTER (WHERE ok) AS accepted, sum(n_chars) FILTER (WHERE ok)::BIGINT AS accepted_tokens,
    count(*) FILTER (WHERE ok AND n_chars >= 2000) AS accepted_long FROM f GROUP BY lang""",
)
def a09(spark, sf):
    rows = judged(spark, sf).select("doc_id", "lang", "source", "n_chars", "reason", F.sha2("text", 256).alias("sha"))
    of_sha = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max((F.col("source") == "src1").cast("int")).alias("old"), F.count("*").alias("n"))
    low = table(spark, sf, "labels").groupBy("doc_id").agg((F.min("quality") == 0).alias("low"))
    j = dedup.join_counted(rows, of_sha, "sha", "n").join(low, "doc_id", "left")
    seen, again, low = (F.col("old") == 1) & (F.col("source") != "src1"), F.col("doc_id") != F.col("first"), F.coalesce("low", F.lit(False))
    ok = (F.col("reason") == "") & ~seen & ~again & ~low
    counts = {"rejected": F.col("reason") != "", "overlaps": seen, "copies": again, "low_quality": low, "accepted": ok}
    return j.groupBy("lang").agg(F.count("*").alias("docs"), *[F.count_if(c).alias(n) for n, c in counts.items()], F.sum(F.when(ok, F.col("n_chars"))).alias("accepted_tokens"), F.count_if(ok & (F.col("n_chars") >= 2000)).alias("accepted_long"))


@query(
    "a10_exclusion_by_priority",
    """WITH e AS (SELECT source, sha256(text) AS h, arg_min(CASE WHEN n_chars < 500 THEN 'short' WHEN lang = 'es' THEN 'language' ELSE 'other' END, CASE WHEN n_chars < 500 THEN 1 WHEN lang = 'es' THEN 2 ELSE 3 END) AS reason, min(n_chars) AS t FROM documents GROUP BY source, h),
    r AS (SELECT *, row_number() OVER (PARTITION BY source, reason ORDER BY h) AS place FROM e) SELECT source, reason, count(*) AS n, sum(t)::BIGINT AS tokens, string_agg(left(h, 12), ',' ORDER BY h) FILTER (WHERE place <= 3) AS samples FROM r GROUP BY ALL""",
)
def a10(spark, sf):
    r = F.when(F.col("n_chars") < 500, "short").when(F.col("lang") == "es", "language").otherwise("other")
    p = F.when(F.col("n_chars") < 500, 1).when(F.col("lang") == "es", 2).otherwise(3)
    per = docs(spark, sf).groupBy("source", F.sha2("text", 256).alias("h")).agg(F.min_by(r, p).alias("reason"), F.min("n_chars").alias("t"))
    some = windows.top_k(per, ["source", "reason"], [F.col("h")], 3).groupBy("source", "reason").agg(F.array_join(F.array_sort(F.collect_list(F.left("h", F.lit(12)))), ",").alias("samples"))
    return per.groupBy("source", "reason").agg(F.count("*").alias("n"), F.sum("t").alias("tokens")).join(some, ["source", "reason"])


@query("a11_fertility_stats", r"SELECT lang, count(*) AS samples, sum(length(text))::BIGINT AS chars, sum(strlen(text))::BIGINT AS bytes, sum(len(regexp_extract_all(text, '[^ \n\t\r]+')))::BIGINT AS tokens, round(sum(len(regexp_extract_all(text, '[^ \n\t\r]+'))) / greatest(sum(length(text)), 1), 6) AS tokens_per_char FROM documents GROUP BY lang")
def a11(spark, sf):
    n = T.hits("text", r"[^ \n\t\r]+")
    g = docs(spark, sf).groupBy("lang").agg(F.count("*").alias("samples"), F.sum(F.length("text")).alias("chars"), F.sum(F.octet_length("text")).alias("bytes"), F.sum(n).alias("tokens"))
    return g.withColumn("tokens_per_char", F.round(F.col("tokens") / F.greatest("chars", F.lit(1)), 6))


@query(
    "a12_audit_marks",
    """WITH d AS (SELECT doc_id, n_chars, unnest(list_filter([CASE WHEN contains(text, '@') THEN 'at' END, CASE WHEN contains(text, '|') THEN 'bar' END, CASE WHEN n_chars > 4000 THEN 'long' END], lambda x: x IS NOT NULL)) AS flag FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY n_chars DESC, doc_id) AS place FROM d) SELECT flag, count(*) AS n, max(n_chars) AS longest, round(avg(n_chars), 4) AS mean, string_agg(doc_id::VARCHAR, ',' ORDER BY place) FILTER (WHERE place <= 10) AS examples FROM r GROUP BY flag""",
)
def a12_marks(spark, sf):
    x = F.col("text")
    flags = F.array_compact(F.array(F.when(x.contains("@"), "at"), F.when(x.contains("|"), "bar"), F.when(F.col("n_chars") > 4000, "long")))
    out = reports.audit_summary(docs(spark, sf).select("doc_id", "n_chars", flags.alias("flags")), "flags", "n_chars", "doc_id", 10)
    return out.withColumn("mean", F.round("mean", 4)).withColumn("examples", F.array_join("examples", ","))


@query("a11_encoder_fertility")
def a11_encoder(spark, sf):
    return tokens.fertility(docs(spark, sf), vocabulary("piece_bpe_32k.model"), "lang")


@query("a04_encoder_profile")
def a04_encoder(spark, sf):
    """The profile with an encoder's tokens."""
    d = tokens.encoded(profiled(spark, sf), vocabulary("byte_bpe_50k.json"))
    return reports.token_profile(d.withColumn("tokens", F.col("n_tokens")).drop("text", "ids", "n_tokens"))


@query("a12_audit_summary")
def a12(spark, sf):
    d = docs(spark, sf).select("doc_id", "n_chars", Q.triage(F.col("text"), F.split("text", r"\s+")).alias("flags"))
    return reports.audit_summary(d, "flags", "n_chars", "doc_id", 10)


@query("a13_generation_summary", "SELECT coalesce(role, '') AS role, coalesce(t, -1) AS turn, count(*) AS n, round(avg(CASE WHEN contains(text, 'tion') THEN 1.0 ELSE 0.0 END), 6) AS rate, round(avg(CASE WHEN turn > 0 THEN length(text) END), 4) AS mean FROM (SELECT role, turn AS t, turn, text FROM conversations) GROUP BY GROUPING SETS ((), (role), (t))")
def a13(spark, sf):
    c = talks(spark, sf).withColumn("t", F.col("turn"))
    g = c.groupingSets([[], [F.col("role")], [F.col("t")]], "role", "t").agg(F.count("*").alias("n"), F.round(F.avg(F.col("text").contains("tion").cast("double")), 6).alias("rate"), F.round(F.avg(F.when(F.col("turn") > 0, F.length("text"))), 4).alias("mean"))
    return g.select(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("t", F.lit(-1)).alias("turn"), "n", "rate", "mean")


@query("a14_mc_summary", "SELECT coalesce(l_returnflag, '') AS benchmark, coalesce(l_linestatus, '') AS subject, count(*) AS n, round(avg(CASE WHEN l_linenumber = 1 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) FILTER (WHERE l_linenumber = 2) AS predicted_f FROM lineitem GROUP BY GROUPING SETS ((), (l_returnflag), (l_returnflag, l_linestatus))")
def a14(spark, sf):
    rows = table(spark, sf, "lineitem")
    g = rows.groupingSets([[], [F.col("l_returnflag")], [F.col("l_returnflag"), F.col("l_linestatus")]], "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.avg((F.col("l_linenumber") == 1).cast("double")), 6).alias("accuracy"), F.count_if(F.col("l_linenumber") == 2).alias("predicted_f"))
    return g.select(F.coalesce("l_returnflag", F.lit("")).alias("benchmark"), F.coalesce("l_linestatus", F.lit("")).alias("subject"), "n", "accuracy", "predicted_f")


@query("a15_exec_summary", "SELECT round(avg(CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0.0 END END), 6) AS math_rate, round(avg(CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0.0 END END), 6) AS code_rate FROM orders")
def a15(spark, sf):
    hit = (F.col("o_totalprice") > 100000).cast("double")
    return table(spark, sf, "orders").agg(F.round(F.avg(F.when(F.col("o_orderstatus") == "F", hit)), 6).alias("math_rate"), F.round(F.avg(F.when(F.col("o_orderstatus") == "O", hit)), 6).alias("code_rate"))


@query(
    "a16_perplexity_table",
    """WITH d AS (SELECT l_returnflag AS dataset, round(exp(least(CASE WHEN sum(q) > 0 THEN sum(l_discount::DOUBLE * q) / sum(q) ELSE avg(l_discount::DOUBLE) END, 50)), 6) AS ppl FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity::DOUBLE END AS q FROM lineitem) GROUP BY l_returnflag)
    SELECT * FROM d UNION ALL SELECT 'mean', round(avg(ppl), 6) FROM d""",
)
def a16(spark, sf):
    # Datasets without supervised tokens take the plain mean of their batches.
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("dataset"), F.col("l_discount").cast("double").alias("loss"), F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_quantity").cast("double")).alias("tokens"))
    return reports.perplexities(rows)


@query("a17_probe_summary")
def a17(spark, sf):
    c = talks(spark, sf).where("role = 'assistant'")
    own = c.select(arrow.loop_coverage("text").alias("loop"), T.distinct_ngram_ratio("text").alias("distinct4"), F.length("text").alias("chars"), F.col("text").rlike(r"[.!?]\s*$").alias("eos"), (F.length("text") % 101).cast("double").alias("judge"), F.array_compact(F.array(F.when(F.length("text") < 40, "short"), F.when(F.col("text").contains("\n"), "lines"))).alias("flags"))
    return reports.probe_summary(own)


@query("a18_group_signal", "SELECT count(*) AS groups, count(*) FILTER (WHERE n >= 2 AND s >= 5) AS with_signal FROM (SELECT count(*) AS n, stddev_pop(l_quantity::DOUBLE) AS s FROM lineitem GROUP BY l_orderkey)")
def a18(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), reports.spread_at_least(F.col("l_quantity").cast("double"), 5).alias("s"))
    return g.agg(F.count("*").alias("groups"), F.count_if((F.col("n") >= 2) & F.col("s")).alias("with_signal"))


@query("a19_preference_pairs", "SELECT l_orderkey AS prompt_id, hi.i AS chosen, lo.i AS rejected FROM (SELECT l_orderkey, max({'s': l_quantity, 'i': CAST(l_linenumber AS VARCHAR)}) AS hi, min({'s': l_quantity, 'i': CAST(l_linenumber AS VARCHAR)}) AS lo, count(*) AS n FROM lineitem GROUP BY l_orderkey) WHERE n >= 2 AND hi.s - lo.s >= 20")
def a19(spark, sf):
    own = F.struct(F.col("l_quantity").alias("s"), F.col("l_linenumber").cast("string").alias("i"))
    g = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("prompt_id")).agg(F.max(own).alias("hi"), F.min(own).alias("lo"), F.count("*").alias("n"))
    return g.where((F.col("n") >= 2) & (F.col("hi.s") - F.col("lo.s") >= 20)).select("prompt_id", F.col("hi.i").alias("chosen"), F.col("lo.i").alias("rejected"))


@query(
    "a20_rft_select",
    """WITH s AS (SELECT l_orderkey AS prompt_id, l_linenumber AS i, l_quantity::DOUBLE AS judge, l_discount::DOUBLE AS rep, l_returnflag <> 'R' AS eos, l_extendedprice::DOUBLE AS reward, l_orderkey % 3 = 0 AS anchor FROM lineitem),
    g AS (SELECT prompt_id, bool_or(anchor) AS anchor, avg(judge) AS mean, arg_max(i, {'r': reward, 'i': i}) FILTER (WHERE eos AND rep <= 0.06) AS best, arg_max(judge, {'r': reward, 'i': i}) FILTER (WHERE eos AND rep <= 0.06) AS bj FROM s GROUP BY prompt_id)
    SELECT prompt_id, best, CASE WHEN best IS NULL THEN 'no_clean_sample' WHEN anchor AND bj < 35 THEN 'anchor_below_floor' WHEN NOT anchor AND bj < 20 THEN 'best_below_floor' WHEN NOT anchor AND mean > 40 THEN 'fuel_group_already_good' WHEN NOT anchor AND bj - mean < 2 THEN 'no_gain' ELSE 'kept' END AS reason FROM g""",
)
def a20(spark, sf):
    s = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("prompt_id"), F.col("l_linenumber").alias("index"), F.col("l_quantity").cast("double").alias("judge"), F.col("l_discount").cast("double").alias("repetition"), (F.col("l_returnflag") != "R").alias("eos"), F.col("l_extendedprice").cast("double").alias("reward"), (F.col("l_orderkey") % 3 == 0).alias("anchor"))
    return reports.rft_select(s, repetition=0.06, anchor_floor=35, floor=20, ceiling=40, gain=2)


@query("a21_reward_breakdown")
def a21(spark, sf):
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    resp, _ = Q.responsiveness(F.col("text"), numeral=F.col("turn") % 2 == 1, differs_from=F.col("before"), min_chars=F.lit(60))
    c = talks(spark, sf).withColumn("before", before)
    own = c.select("conv_id", "turn", arrow.loop_coverage("text").alias("loop"), T.distinct_ngram_ratio("text").alias("distinct4"), (F.length("text") % 101 / 100).alias("coherence"), resp.alias("responsive"), (T.strip("text") == "").alias("empty"), F.col("text").rlike(r"[.!?]\s*$").alias("finished"))
    return reports.rewards(own).select("conv_id", "turn", F.round("repetition", 6).alias("repetition"), F.round("reward", 6).alias("reward"))


@query("a22_stage_checks", "SELECT 'no_null_text' AS name, count(*) FILTER (WHERE text IS NULL) = 0 AS passed FROM documents UNION ALL SELECT 'four_languages', count(DISTINCT lang) = 4 FROM documents UNION ALL SELECT 'all', count(*) FILTER (WHERE text IS NULL) = 0 AND count(DISTINCT lang) = 4 FROM documents")
def a22(spark, sf):
    one = docs(spark, sf).agg(F.count_if(F.col("text").isNull()).alias("a"), F.countDistinct("lang").alias("b"))
    return reports.checks(one, ("no_null_text", F.col("a") == 0), ("four_languages", F.col("b") == 4))


_SCORED = "(SELECT quality AS label, least(n_chars / 4000.0, 1.0)::DOUBLE AS score FROM documents JOIN labels USING (doc_id))"


def scored(spark, sf):
    j = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    return j.select(F.col("quality").alias("label"), F.least(F.col("n_chars") / 4000.0, F.lit(1.0)).alias("score"))


_METRICS = "round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy, round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fn + fp)) / 2, 6) AS macro_f1, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1"


@query("a23_classifier_metrics", f"SELECT {_METRICS} FROM (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.3) AS tp, count(*) FILTER (WHERE label = 0 AND score >= 0.3) AS fp, count(*) FILTER (WHERE label = 1 AND score < 0.3) AS fn, count(*) FILTER (WHERE label = 0 AND score < 0.3) AS tn FROM {_SCORED})")
def a23(spark, sf):
    one = scored(spark, sf).agg(*reports.confusion(F.col("label"), F.col("score") >= 0.3))
    return one.select(*[F.round(c, 6).alias(n) for n, c in reports.classifier_metrics(*map(F.col, ("tp", "fp", "fn", "tn"))).items()])


@query("a24_threshold_search", f"WITH s AS {_SCORED}, g AS (SELECT round(0.05 + i * 0.005, 6) AS threshold, round(0.05 + i * 0.005 - 5e-12, 13) AS cut FROM range(181) r(i)), c AS (SELECT threshold, count(*) FILTER (WHERE label = 1 AND score >= cut) AS tp, count(*) FILTER (WHERE label = 0 AND score >= cut) AS fp, count(*) FILTER (WHERE label = 1 AND score < cut) AS fn, count(*) FILTER (WHERE label = 0 AND score < cut) AS tn FROM s, g GROUP BY threshold) SELECT max(round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6)) AS best_precision, count(*) AS thresholds, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp FROM c")
def a24(spark, sf):
    t = reports.threshold_table(scored(spark, sf))
    m = reports.classifier_metrics(*map(F.col, ("tp", "fp", "fn", "tn")))
    return t.agg(F.max(F.round(m["precision"], 6)).alias("best_precision"), F.count("*").alias("thresholds"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))


@query("a25_text_health_scan")
def a25(spark, sf):
    d = docs(spark, sf).select("doc_id", "text", T.document_split(F.sha2("text", 256)).alias("split"))
    return reports.health(d.select("doc_id", "split", Q.poison_repetition(F.col("text")).alias("poison"), Q.repeated_sentences(F.col("text")).alias("repeated")), "split", "doc_id", 8)


@query(
    "a26_run_summary",
    """WITH e AS (SELECT event_type AS run, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS b FROM events)
    SELECT run, round(avg(value) FILTER (WHERE r <= 20), 6) AS first, round(avg(value) FILTER (WHERE b <= 20), 6) AS last, round(avg(value) FILTER (WHERE r <= 20) - avg(value) FILTER (WHERE b <= 20), 6) AS improvement, max(value) AS highest, round(avg(value) FILTER (WHERE r > 20), 6) AS steady, count(*) FILTER (WHERE value IS NULL) AS bad, arg_max(event_id, event_id) % 2 = 0 AS completed FROM e GROUP BY run""",
)
def a26(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("run"), "event_id", "value", (F.col("event_id") % 2 == 0).alias("end"))
    return reports.run_summary(e, "run", "event_id", "value", "end", 20)


# Conversations.


def messages(spark, sf):
    """One row a conversation: messages in turn order."""
    rows = talks(spark, sf).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    return rows


@query("p27_conversation_prompt", "SELECT conv_id, max(turn) FILTER (WHERE role = 'user') + 1 AS kept FROM conversations GROUP BY conv_id HAVING max(turn) FILTER (WHERE role = 'user') IS NOT NULL")
def p27(spark, sf):
    last = F.array_max(F.transform("messages", lambda m, i: F.when(m["role"] == "user", i + 1)))
    kept = messages(spark, sf).select("conv_id", "messages", last.alias("k")).where("k is not null")
    return kept.select("conv_id", F.element_at(F.slice("messages", F.lit(1), F.col("k")), -1)["turn"].alias("t")).select("conv_id", (F.col("t") + 1).alias("kept"))


@query("p28_first_user_message", "SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS first, count(*) FILTER (WHERE role = 'user') AS user_turns FROM conversations GROUP BY conv_id")
def p28(spark, sf):
    own = F.filter("messages", lambda m: m["role"] == "user")
    return messages(spark, sf).select("conv_id", F.get(own, F.lit(0))["text"].alias("first"), F.size(own).cast("long").alias("user_turns"))


@query("p29_turn_cuts", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS cut FROM conversations WHERE role = 'user'")
def p29(spark, sf):
    cuts = messages(spark, sf).select("conv_id", F.posexplode(F.filter("messages", lambda m: m["role"] == "user")).alias("k", "m"))
    return cuts.select("conv_id", "m.turn", (F.col("k") + 1).cast("long").alias("cut"))


@query("p30_conversation_segments")
def p30(spark, sf):
    # Words of at most 400 a talk, counted from its end; the prompt's half of a pair is masked to its last turn.
    words = F.transform("messages", lambda m: F.struct(F.split(F.concat(F.lit("<"), m["role"], F.lit("> "), m["text"]), r"\s+").alias("w"), (m["role"] == "assistant").alias("on")))
    last = F.array_max(F.transform("parts", lambda p, i: F.when(p["on"], i)))
    rows = messages(spark, sf).select("conv_id", words.alias("parts")).withColumn("last", last)
    labels = lambda pair: F.flatten(F.transform("parts", lambda p, i: F.transform(p["w"], lambda w: F.when(p["on"] & (F.lit(not pair) | (i == F.col("last"))), 1).otherwise(-100))))
    tail = lambda a: F.slice(a, F.greatest(F.size(a) - 399, F.lit(1)), F.lit(400))
    cut = rows.select("conv_id", F.size("parts").alias("segments"), tail(labels(False)).alias("own"), tail(labels(True)).alias("pair"))
    n = lambda c: F.size(F.filter(c, lambda x: x != -100))
    return cut.select("conv_id", "segments", F.size("own").alias("tokens"), n("own").alias("supervised"), n("pair").alias("supervised_in_pairs")).where("supervised > 0")


@query("p31_supervised_tokens", r"SELECT conv_id, coalesce(sum(len(regexp_split_to_array(text, '\s+'))) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS supervised FROM conversations GROUP BY conv_id")
def p31(spark, sf):
    labels = F.flatten(F.transform("messages", lambda m: F.transform(F.split(m["text"], r"\s+"), lambda w: F.when(m["role"] == "assistant", 1).otherwise(-100))))
    first = F.array(F.lit(-100))  # a begin mark, so that the shift by one loses nothing
    shifted = F.slice(F.concat(first, labels), F.lit(2), F.size(labels))
    return messages(spark, sf).select("conv_id", F.size(F.filter(shifted, lambda x: x != -100)).cast("long").alias("supervised"))


@query("p35_merge_user_turns", "WITH g AS (SELECT conv_id, turn, role, text, sum(CASE WHEN role = 'user' AND p = 'user' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations)) SELECT conv_id, min(turn) AS turn, min(role) AS role, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM g GROUP BY conv_id, g")
def p35(spark, sf):
    w = Window.partitionBy("conv_id").orderBy("turn")
    same = (F.col("role") == "user") & (F.lag("role").over(w) == "user")
    rows = talks(spark, sf).withColumn("new", F.when(same, 0).otherwise(1)).withColumn("g", F.sum("new").over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda m: m["text"]), "\n\n")
    return rows.groupBy("conv_id", "g").agg(F.min("turn").alias("turn"), F.min("role").alias("role"), joined.alias("text")).drop("g")


@query("f29_hard_prompt_filter")
def f29(spark, sf):
    t = talks(spark, sf).where("role = 'user'").withColumn("k", T.skeleton("text"))
    known = reports.memorised(talks(spark, sf).where("turn = 0"), "text").select(F.col("skeleton").alias("k"))
    return t.where(Q.hard_prompt(F.col("text"))).join(known, "k", "left_anti").select("conv_id", "turn")


@query(
    "f33_numeric_agreement",
    r"""WITH n AS (SELECT conv_id, turn, (conv_id % 50)::VARCHAR AS r, regexp_extract_all(text, '-?[0-9][0-9,]*(?:\.[0-9]+)?') AS a, regexp_extract_all(text, '([0-9]+)\s*/\s*([0-9]+)') AS f FROM conversations)
    SELECT conv_id, turn, len(list_filter(a, lambda x: abs(replace(x, ',', '')::DOUBLE - r::DOUBLE) <= 0.5 * pow(10, -coalesce(length(regexp_extract(x, '\.([0-9]+)', 1)), 0)))) > 0
    OR len(list_filter(f, lambda x: try_cast(regexp_extract(x, '/\s*([0-9]+)', 1) AS DOUBLE) > 0 AND abs(try_cast(regexp_extract(x, '^([0-9]+)', 1) AS DOUBLE) / try_cast(regexp_extract(x, '/\s*([0-9]+)', 1) AS DOUBLE) - r::DOUBLE) < 1e-12)) > 0 AS agrees FROM n""",
)
def f33(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", arrow.agrees("text", (F.col("conv_id") % 50).cast("string")).alias("agrees"))


# Sources over the given tables.


@query("s01_read_source", "SELECT doc_id, text, source FROM documents WHERE lang = 'en'")
def s01(spark, sf):
    from ..sources import readers

    return readers.read_source(spark, [f"{sf}/documents.parquet"], {"id_column": "doc_id", "text_column": "text", "source_column": "source", "language_column": "lang"}).where("language = 'en'").select(F.col("id").cast("long").alias("doc_id"), "text", "source")


@query("s06_evenly_spaced_rows", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r FROM orders WHERE o_orderpriority LIKE '1%') WHERE r IN (SELECT (i * ((SELECT count(*) FROM orders WHERE o_orderpriority LIKE '1%') - 1)) // 19 FROM range(20) t(i))")
def s06(spark, sf):
    return windows.evenly_spaced(table(spark, sf, "orders").where("o_orderpriority like '1%'").select("o_orderkey"), ["o_orderkey"], 20)


@query("s07_evenly_spaced_files", "SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS r FROM part WHERE p_size > 40) WHERE r IN (SELECT CAST(round_even(i * ((SELECT count(*) FROM part WHERE p_size > 40) - 1) / 6.0, 0) AS BIGINT) FROM range(7) t(i))")
def s07(spark, sf):
    return windows.evenly_spaced(table(spark, sf, "part").where("p_size > 40").select("p_partkey"), ["p_partkey"], 7, "even")


@query("s08_catalog_select", "SELECT p_partkey, p_name FROM (SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS r FROM part WHERE regexp_matches(p_name, 'a.*e')) WHERE r IN (SELECT (i * ((SELECT count(*) FROM part WHERE regexp_matches(p_name, 'a.*e')) - 1)) // 29 FROM range(30) t(i))")
def s08(spark, sf):
    from ..sources import readers

    files = table(spark, sf, "part").where(F.col("p_name").rlike("a.*e")).select("p_partkey", "p_name")
    return readers.select_files(files, ["p_name", "p_partkey"], spaced=30, expected=files.count())


@query("s09_paired_shards", "WITH w AS (SELECT l_orderkey AS shard, row_number() OVER (ORDER BY l_orderkey) - 1 AS r FROM lineitem WHERE l_linenumber <= 2 GROUP BY l_orderkey HAVING count(*) = 2 AND count(DISTINCT l_linenumber) = 2) SELECT shard FROM w WHERE r IN (SELECT (i * ((SELECT count(*) FROM w) - 1)) // 49 FROM range(50) t(i))")
def s09(spark, sf):
    from ..sources import readers

    files = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("shard"), F.col("l_linenumber").cast("string").alias("role"))
    return readers.paired(files, "shard", "role", ["1", "2"], 50)


@query("s11_pages_to_documents")
def s11(spark, sf):
    from ..sources import readers

    return readers.pages_to_documents(table(spark, sf, "pages"))


@query("s13_read_text_column", "SELECT item_id, text AS content FROM benchmark")
def s13(spark, sf):
    from ..sources import readers

    return readers.read_text_column(table(spark, sf, "benchmark")).select("item_id", F.col("text").alias("content"))


@query("s04_list_inputs", "SELECT p_partkey FROM part WHERE p_partkey % 6 IN (0, 1, 2)")
def s04(spark, sf):
    from ..sources import readers

    # Names of six kinds: data in three forms, then a manifest, statistics and a file of another kind.
    kind = F.element_at(F.array(*map(F.lit, (".jsonl", ".json", ".jsonl.gz", "_manifest.json", ".stats.json", ".parquet"))), (F.col("p_partkey") % 6 + 1).cast("int"))
    return readers.list_inputs(table(spark, sf, "part").select("p_partkey", F.concat(F.lit("/data/reports/part"), F.col("p_partkey").cast("string"), kind).alias("path"))).select("p_partkey")


@query("s05_prefer_plain_files", "SELECT o_orderkey FROM (SELECT o_orderkey, o_orderstatus = 'F' AS plain, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS any_plain FROM orders) WHERE plain OR any_plain = 0")
def s05(spark, sf):
    from ..sources import readers

    files = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("family"), (F.col("o_orderstatus") == "F").alias("plain"))
    return readers.prefer_plain(files).select("o_orderkey")


@query(
    "s14_read_benchmark_tables",
    r"SELECT item_id::VARCHAR AS id, CASE WHEN item_id % 3 = 0 THEN 'dev' ELSE 'test' END AS split, 'subject' || (item_id % 5) AS subject, trim(regexp_replace(text, '\s+', ' ', 'g')) AS question, CASE WHEN item_id % 4 = 3 THEN '' ELSE chr(CAST(65 + item_id % 4 AS INTEGER)) END AS answer, CASE WHEN item_id % 2 = 0 THEN 2 ELSE 3 END AS choices FROM benchmark WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''",
)
def s14(spark, sf):
    from ..sources import readers

    subject, split = F.concat(F.lit("subject"), (F.col("item_id") % 5).cast("string")), F.when(F.col("item_id") % 3 == 0, "dev").otherwise("test")
    raw = F.element_at(F.array(*map(F.lit, ("a ", "B", "C", "X"))), (F.col("item_id") % 4 + 1).cast("int"))
    rows = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), F.trim(F.regexp_replace("text", r"\s+", " ")).alias("question"), raw.alias("answer"), subject.alias("subject"), split.alias("split"))
    at = f"{dedup.shared(spark)}/questions-{uuid.uuid4().hex}"
    even, odd = rows.where("id % 2 = 0"), rows.where("id % 2 <> 0")
    even.withColumns({"A": F.lit("yes"), "B": F.lit("no"), "C": F.lit(" ")}).withColumnsRenamed({"question": "Question", "answer": "Answer"}).write.partitionBy("subject", "split").option("header", True).option("escape", '"').csv(f"{at}/csv")
    odd.withColumns({"a": F.lit("1"), "b": F.lit("2"), "d": F.lit("4")}).write.partitionBy("subject", "split").parquet(f"{at}/parquet")
    own = readers.read_benchmark_tables(spark, [f"{at}/csv"], [f"{at}/parquet"])
    return own.select("id", "split", "subject", "question", "answer", F.size("choices").cast("long").alias("choices"))


# Tokenised tables.


@query("g01_tokenize", r"SELECT doc_id, len(regexp_extract_all(text, '[^ \n\t\r]+')) + 1 AS n_tokens FROM documents")
def g01(spark, sf):
    return docs(spark, sf).select("doc_id", (F.size(F.regexp_extract_all("text", F.lit(r"[^ \n\t\r]+"), F.lit(0))) + 1).cast("long").alias("n_tokens"))


@query("g01_encode")
def g01_encode(spark, sf):
    own = tokens.encoded(docs(spark, sf), vocabulary("byte_bpe_50k.json"))
    return own.select("doc_id", "n_tokens", F.md5(F.array_join("ids", ",").cast("binary")).alias("digest"))


def shard_rows(shards):
    """A row a shard: its tokens and a digest of them."""
    joined = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "tokens"))), lambda x: x["tokens"])), ",")
    return shards.groupBy("source", "shard").agg(F.sum(F.size("tokens")).alias("tokens"), F.md5(joined.cast("binary")).alias("digest"))


@query("g02_encode_pack")
def g02(spark, sf):
    """Shards of each source's documents up to a quota of half its words."""
    quotas = docs(spark, sf).groupBy("source").agg(F.floor(F.sum(T.hits("text", r"[^ \n\t\r]++")) / 2).alias("quota"))
    return shard_rows(tokens.encode_pack(docs(spark, sf), vocabulary("byte_bpe_50k.json"), "source", 50256, 65_536, quotas=dedup.written(quotas, "quotas")))


@query(
    "g03_admit_and_verify_rows",
    """WITH d AS (SELECT doc_id, source, CASE WHEN b < 9600 THEN 'train' WHEN b < 9800 THEN 'val' ELSE 'test' END AS own FROM (SELECT doc_id, source, ('0x' || left(sha256(text), 8))::BIGINT % 10000 AS b FROM documents))
    SELECT doc_id, CASE WHEN source <> 'src' || (doc_id % 20) THEN 'source_mismatch' WHEN own <> CASE WHEN doc_id % 11 = 0 THEN 'test' ELSE own END THEN 'split_mismatch' ELSE '' END AS violation FROM d""",
)
def g03(spark, sf):
    # The declared source follows the id; every eleventh document lies in the path of the test split.
    own = T.document_split(F.sha2("text", 256))
    d = docs(spark, sf).select("doc_id", "source", F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string")).alias("declared"), own.alias("own"), F.when(F.col("doc_id") % 11 == 0, "test").otherwise(own).alias("path_split"))
    return d.select("doc_id", Q.reason((F.col("source") != F.col("declared"), "source_mismatch"), (F.col("own") != F.col("path_split"), "split_mismatch")).alias("violation"))


@query("g04_post_clean_admission", "SELECT doc_id, CASE WHEN sha256(text) IN (SELECT sha256(text) FROM documents WHERE source = 'src5') AND source <> 'src5' THEN 'legacy_exact' WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'manifest' ELSE '' END AS reason FROM documents")
def g04(spark, sf):
    sha = F.sha2("text", 256)
    seen = docs(spark, sf).where("source = 'src5'").select(sha.alias("seen")).distinct()
    bad = table(spark, sf, "labels").where("quality = 0").select("doc_id", F.lit(1).alias("bad")).distinct()
    j = docs(spark, sf).withColumn("sha", sha).join(seen, F.col("sha") == F.col("seen"), "left").join(bad, "doc_id", "left")
    return j.select("doc_id", Q.reason((F.col("seen").isNotNull() & (F.col("source") != "src5"), "legacy_exact"), (F.col("bad") == 1, "manifest")).alias("reason"))


@query("g05_build_full")
def g05(spark, sf):
    """All documents that the mixture's cleaning keeps, encoded and packed without quotas."""
    clean, why = Q.mix_clean(F.col("text"))
    kept = docs(spark, sf).select("source", "doc_id", clean.alias("text"), why.alias("why")).where("why = ''")
    return shard_rows(tokens.encode_pack(kept, vocabulary("byte_bpe_50k.json"), "source", 50256, 65_536))


@query("g06_mix_bucket", "SELECT doc_id, source || ':' || CASE WHEN doc_id % 10 = 0 THEN 'UNKNOWN' ELSE lang END AS bucket FROM documents")
def g06(spark, sf):
    lang = F.trim(F.when(F.col("doc_id") % 10 == 0, " ").otherwise(F.col("lang")))
    return docs(spark, sf).select("doc_id", F.concat_ws(":", "source", F.when(lang == "", "UNKNOWN").otherwise(lang)).alias("bucket"))


@query(
    "g07_split_manifest_check",
    "WITH w AS (SELECT source, lang, sum(n_chars) AS n FROM documents GROUP BY ALL), s AS (SELECT source, CAST(sum(floor(n * 0.9)) AS BIGINT) AS parts, CAST(floor(sum(n) * 0.9) AS BIGINT) AS quota, CAST(sum(n) AS BIGINT) AS n FROM w GROUP BY source) SELECT source, parts = quota AS quotas_agree, quota <= n AS supply_holds, true AS bytes_agree FROM s",
)
def g07(spark, sf):
    per = docs(spark, sf).groupBy("source", "lang").agg(F.sum("n_chars").alias("n"))
    composite = per.select("source", "lang", F.floor(F.col("n") * 0.9).cast("long").alias("quota"))
    quotas = docs(spark, sf).groupBy("source").agg(F.sum("n_chars").alias("n")).select("source", F.floor(F.col("n") * 0.9).cast("long").alias("quota"))
    tokens = F.transform(F.sequence(F.lit(1), F.greatest(F.ceil(F.col("n_chars") / 1000), F.lit(1))), lambda i: i.cast("int"))
    shards = writers.token_shards(docs(spark, sf).select("source", "doc_id", tokens.alias("ids")), "source", ["doc_id"], "ids", 500)
    files = shards.groupBy("source", "shard").agg(F.sum(F.size("tokens")).alias("tokens"), F.sum(F.octet_length(F.array_join(F.transform("tokens", lambda t: F.lpad(F.hex(t), 4, "0")), ""))).alias("bytes"))
    return reports.manifest_check(quotas, composite, per.groupBy("source").agg(F.sum("n").alias("supply")), files, "source")


@query(
    "g08_dataset_lineage_check",
    "SELECT source AS label, count(*) FILTER (WHERE n_chars > 15000) = 0 AS equal, count(DISTINCT lang) > 0 AND count(*) FILTER (WHERE doc_id % 5 = 4) > 0 AS complete, count(*) FILTER (WHERE n_chars > 15000) = 0 AND count(*) FILTER (WHERE doc_id % 5 = 4) > 0 AS passed FROM documents GROUP BY source",
)
def g08(spark, sf):
    # Five stages give a fingerprint of each source's documents; the merge loses long ones, and the shards have a source only with some documents.
    d = docs(spark, sf)
    mark = lambda rows, stage: rows.groupBy(F.col("source").alias("label")).agg(F.md5(F.concat_ws(":", F.count("*").cast("string"), F.sum("doc_id").cast("string"))).alias("fingerprint")).withColumn("stage", F.lit(stage))
    have = d.where("doc_id % 5 = 4").select("source").distinct()
    stages = [mark(d, "acquired"), mark(d.repartition("doc_id"), "cleaned"), mark(d.where("n_chars <= 15000"), "merged"), mark(d.join(have, "source", "left_semi"), "sharded"), mark(d, "trained")]
    return reports.lineage_check(functools.reduce(lambda a, b: a.unionByName(b), stages), ["acquired", "cleaned", "merged", "sharded", "trained"])


@query("g04_near_admission")
def g04b(spark, sf):
    """Legacy exact, legacy near, manifest and severe repetition, the first that hits."""
    s = dedup.written(dedup.signed(docs(spark, sf)).select("doc_id", "source", "text", F.sha2("key", 256).alias("sha"), "sig"), "signed")
    new, old = s.where("source <> 'src5'"), s.where("source = 'src5'")
    near = joins.near_overlap(new, old, "doc_id").withColumn("near", F.lit(True))
    seen = old.select("sha").distinct().withColumn("seen", F.lit(True))
    low = table(spark, sf, "labels").where("quality = 0").select("doc_id", F.lit(True).alias("low")).distinct()
    j = new.join(seen, "sha", "left").join(near, "doc_id", "left").join(low, "doc_id", "left")
    excess = Q.repeated_chars(F.col("text"), 20, 2, beyond_first=True) >= F.greatest(F.lit(500), F.floor(F.length("text") * 0.3))
    hit = lambda c: F.coalesce(F.col(c), F.lit(False))
    return j.select("doc_id", Q.reason((hit("seen"), "legacy_exact_overlap"), (hit("near"), "legacy_near_overlap"), (hit("low"), "manifest"), (excess, "severe_repetition")).alias("reason"))


# JSON helpers and live metrics.


@query("x01_parse_verdict", "SELECT event_id, CASE WHEN s BETWEEN 0 AND 100 THEN s END AS score FROM (SELECT event_id, try_cast(regexp_extract(CASE WHEN event_id % 2 = 0 THEN '{\"score\": ' || (event_id % 130) || '}' ELSE 'score: ' || (event_id % 130) || ' broken' END, '[0-9]+') AS BIGINT) AS s FROM events)")
def x01(spark, sf):
    n = (F.col("event_id") % 130).cast("string")
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"score": '), n, F.lit("}"))).otherwise(F.concat(F.lit("score: "), n, F.lit(" broken")))
    s = F.coalesce(F.try_variant_get(F.try_parse_json(raw), "$.score", "bigint"), F.regexp_extract(raw, r'"?score"?\s*[:=]\s*([0-9]+)', 1).try_cast("bigint"))
    return table(spark, sf, "events").select("event_id", F.when(s.between(0, 100), s).alias("score"))


@query("x02_manifest_digest", "SELECT source, sha256(string_agg(d, ',' ORDER BY p)) AS digest FROM (SELECT source, left(h, 4) AS p, sha256(string_agg(h, ',' ORDER BY h)) AS d FROM (SELECT source, sha256(text) AS h FROM documents) GROUP BY ALL) GROUP BY source")
def x02(spark, sf):
    rows = docs(spark, sf).select("source", F.sha2("text", 256).alias("h"))
    return reports.digest_by(rows, "source", F.substring("h", 1, 4), F.col("h"), F.col("h"))


@query("x03_inventory_digest", "SELECT root, sha256(string_agg(d, ',' ORDER BY p)) AS digest FROM (SELECT c_mktsegment AS root, c_custkey // 4096 AS p, sha256(string_agg(c_custkey || ':' || c_nationkey, ',' ORDER BY c_custkey)) AS d FROM customer GROUP BY ALL) GROUP BY root")
def x03(spark, sf):
    rows = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "root")
    return reports.digest_by(rows, "root", F.floor(F.col("c_custkey") / 4096), F.col("c_custkey"), F.concat_ws(":", "c_custkey", "c_nationkey"))


@query("r06_progress_eta", "SELECT event_type AS run, count(*) * 100 // 5000 AS pct, CASE WHEN sum(value) > 0 THEN round((5000 - count(*)) / avg(value), 4) END AS eta FROM events GROUP BY event_type")
def r06(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("run")).agg(F.floor(F.count("*") * 100 / 5000).alias("pct"), F.when(F.sum("value") > 0, F.round((5000 - F.count("*")) / F.avg("value"), 4)).alias("eta"))


@query("r07_health_rules", "SELECT run, list_filter([CASE WHEN hi > 100 THEN 'grad_high' END, CASE WHEN bad > 0 THEN 'non_finite' END, CASE WHEN n >= 10 AND recent < 0.35 * med THEN 'slow' END], lambda x: x IS NOT NULL)::VARCHAR AS issues FROM (SELECT event_type AS run, max(value) AS hi, count(*) FILTER (WHERE value IS NULL) AS bad, count(*) AS n, median(value) AS med, avg(value) FILTER (WHERE event_id % 7 = 0) AS recent FROM events GROUP BY event_type)")
def r07(spark, sf):
    v = F.col("value")
    g = table(spark, sf, "events").groupBy(F.col("event_type").alias("run")).agg(F.max(v).alias("hi"), F.count_if(v.isNull() | F.isnan(v)).alias("bad"), F.count("*").alias("n"), F.median(v).alias("med"), F.avg(F.when(F.col("event_id") % 7 == 0, v)).alias("recent"))
    issues = F.array_compact(F.array(F.when(F.col("hi") > 100, "grad_high"), F.when(F.col("bad") > 0, "non_finite"), F.when((F.col("n") >= 10) & (F.col("recent") < 0.35 * F.col("med")), "slow")))
    return g.select("run", F.concat(F.lit("["), F.array_join(issues, ", "), F.lit("]")).alias("issues"))
