"""Queries of joins, deduplication, windows, mixture planning, sorts and set operations."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import arrow
from ..functions import text as T
from ..operators import dedup, joins, policy, windows, reports
from ..sources import readers


def docs(spark, sf):
    return table(spark, sf, "documents")


# Joins.


@query("j01_exact_overlap", "SELECT doc_id, sha256(text) IN (SELECT sha256(text) FROM documents WHERE source = 'src1') AS exact_overlap FROM documents WHERE source <> 'src1'")
def j01(spark, sf):
    d = docs(spark, sf).select("doc_id", "source", F.sha2("text", 256).alias("sha"))
    return joins.exact_overlap(d.where("source <> 'src1'"), d.where("source = 'src1'"), "sha").select("doc_id", "exact_overlap")


@query("j01_exact_overlap_exclude", "SELECT doc_id FROM documents WHERE source <> 'src1' AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src1')")
def j01b(spark, sf):
    d = docs(spark, sf).select("doc_id", "source", F.sha2("text", 256).alias("sha"))
    return joins.exact_overlap(d.where("source <> 'src1'"), d.where("source = 'src1'"), "sha", "exclude").select("doc_id")


@query("j02_near_overlap")
def j02(spark, sf):
    s = dedup.written(dedup.signed(docs(spark, sf)).select("doc_id", "source", "sig"), "signed")
    return joins.near_overlap(s.where("source <> 'src1'"), s.where("source = 'src1'"), "doc_id")


@query("j03_near_pairs")
def j03(spark, sf):
    return dedup.near_pairs(dedup.written(dedup.signed(docs(spark, sf)).select("doc_id", "sig"), "signed"), "doc_id")


@query(
    "j04_decontaminate",
    r"""WITH s AS (SELECT item_id, item_id % 3 AS rank, lower(regexp_replace(text, '\s+', '', 'g')) AS k FROM benchmark), d AS (SELECT doc_id, lower(regexp_replace(text, '\s+', '', 'g')) AS t FROM documents)
    SELECT doc_id, item_id FROM d JOIN s ON contains(t, k) WHERE length(k) >= 24 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank, strpos(t, substr(k, (length(k) - 24) // 2 + 1, 24)), item_id) = 1""",
)
def j04(spark, sf):
    signatures = table(spark, sf, "benchmark").select(F.col("item_id").alias("sid"), (F.col("item_id") % 3).alias("rank"), F.lower(T.squeeze("text")).alias("skey"))
    d = docs(spark, sf).select("doc_id", F.lower(T.squeeze("text")).alias("key"))
    return joins.decontaminate(d, signatures).withColumnRenamed("sid", "item_id")


@query("j05_manifest_reconcile", "SELECT coalesce(a.o_orderkey, b.l_orderkey) AS k, CASE WHEN b.l_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'unexpected' WHEN a.n IS DISTINCT FROM b.n THEN 'n_drift' ELSE 'matched' END AS status FROM (SELECT o_orderkey, 4::BIGINT AS n FROM orders WHERE o_orderkey % 5 <> 0) a FULL JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY 1) b ON a.o_orderkey = b.l_orderkey")
def j05(spark, sf):
    a = table(spark, sf, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), F.lit(4).cast("long").alias("n"))
    b = table(spark, sf, "lineitem").where("l_orderkey % 7 <> 0").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
    return joins.reconcile(a, b, ["k"], ["n"])


@query("j06_apply_exclusion_manifest", "SELECT d.doc_id, CASE WHEN source IN ('src1', 'src2') AND l.doc_id IS NOT NULL THEN 'low_quality' ELSE '' END AS reason FROM documents d LEFT JOIN (SELECT doc_id FROM labels WHERE quality = 0) l USING (doc_id)")
def j06(spark, sf):
    bad = table(spark, sf, "labels").where("quality = 0").select("doc_id", F.lit("low_quality").alias("reason"))
    hit = F.col("source").isin("src1", "src2")
    return joins.lookup(docs(spark, sf), bad, "doc_id").select("doc_id", F.when(hit, F.coalesce("reason", F.lit(""))).otherwise("").alias("reason"))


@query("j07_source_rule_lookup", "SELECT doc_id, length(text) < m AS too_short FROM documents d JOIN (SELECT source, CAST(avg(n_chars) / 4 AS BIGINT) AS m FROM documents GROUP BY source) r USING (source)")
def j07(spark, sf):
    rules = docs(spark, sf).groupBy("source").agg(F.round(F.avg("n_chars") / 4).cast("long").alias("m"))
    return joins.lookup(docs(spark, sf), rules, "source").select("doc_id", (F.length("text") < F.col("m")).alias("too_short"))


@query("j08_quota_lookup", "SELECT doc_id, CASE WHEN source IN ('src1', 'src3') THEN '' ELSE 'bucket_off' END AS reason FROM documents")
def j08(spark, sf):
    quotas = docs(spark, sf).where("source in ('src1', 'src3')").groupBy("source").agg(F.sum("n_chars").alias("quota"))
    return joins.lookup(docs(spark, sf), quotas, "source").select("doc_id", F.when(F.coalesce("quota", F.lit(0)) > 0, "").otherwise("bucket_off").alias("reason"))


@query("j09_eval_trajectory", "SELECT step, a.mean AS gen, b.mean AS ppl, c.mean AS exec FROM (SELECT hour(ts) AS step, round(avg(value), 6) AS mean FROM events WHERE event_type = 'click' GROUP BY 1) a FULL JOIN (SELECT hour(ts) AS step, round(avg(value), 6) AS mean FROM events WHERE event_type = 'purchase' AND hour(ts) % 2 = 0 GROUP BY 1) b USING (step) FULL JOIN (SELECT hour(ts) AS step, round(avg(value), 6) AS mean FROM events WHERE event_type = 'view' AND hour(ts) % 3 = 0 GROUP BY 1) c USING (step)")
def j09(spark, sf):
    e = table(spark, sf, "events").withColumn("step", F.hour("ts").cast("long"))
    part = lambda kind, every: e.where((F.col("event_type") == kind) & (F.col("step") % every == 0)).groupBy("step").agg(F.round(F.avg("value"), 6).alias("value"))
    return reports.trajectory({"gen": part("click", 1), "ppl": part("purchase", 2), "exec": part("view", 3)})


@query("j10_judge_merge", "SELECT o_orderkey AS prompt_id, 0::BIGINT AS index, round(CASE WHEN v.s IS NULL THEN o_totalprice ELSE (o_totalprice + v.s) / 2 END, 4)::DOUBLE AS judge_score, round(CASE WHEN v.s IS NULL THEN 1.0 ELSE 1.0 + ((o_totalprice + v.s) / 2 - o_totalprice) / 100 END, 6)::DOUBLE AS reward FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity)::DOUBLE AS s FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1) v ON o_orderkey = l_orderkey")
def j10(spark, sf):
    flags = F.array(F.lit("a"))
    samples = table(spark, sf, "orders").select(F.col("o_orderkey").alias("prompt_id"), F.lit(0).cast("long").alias("index"), F.col("o_totalprice").cast("double").alias("score"), flags.alias("flags"), F.lit(1.0).alias("reward"))
    second = table(spark, sf, "lineitem").where("l_orderkey % 2 = 0").groupBy(F.col("l_orderkey").alias("prompt_id")).agg(F.sum("l_quantity").cast("double").alias("score")).select("prompt_id", F.lit(0).cast("long").alias("index"), "score", flags.alias("flags"))
    return joins.merge_verdicts(samples, second).select("prompt_id", "index", F.round("judge_score", 4).alias("judge_score"), F.round("reward", 6).alias("reward"))


@query("j11_baseline_candidate_compare", "SELECT lang, round((b.m - a.m) / a.m, 6) AS change, (b.m - a.m) / a.m >= -0.05 AS passed FROM (SELECT lang, avg(n_chars) AS m FROM documents WHERE doc_id % 2 = 0 GROUP BY lang) a JOIN (SELECT lang, avg(n_chars) AS m FROM documents WHERE doc_id % 2 = 1 GROUP BY lang) b USING (lang)")
def j11(spark, sf):
    part = lambda r, name: docs(spark, sf).where(f"doc_id % 2 = {r}").groupBy("lang").agg(F.avg("n_chars").alias(name))
    change = (F.col("b") - F.col("a")) / F.col("a")
    return part(0, "a").join(part(1, "b"), "lang").select("lang", F.round(change, 6).alias("change"), (change >= -0.05).alias("passed"))


@query("j12_curated_exemption", "SELECT doc_id FROM documents WHERE lower(source) NOT IN (SELECT DISTINCT lower(source) FROM documents WHERE n_chars > 20000)")
def j12(spark, sf):
    exempt = docs(spark, sf).where("n_chars > 20000").select(F.lower("source").alias("s")).distinct()
    return docs(spark, sf).join(exempt, F.lower("source") == F.col("s"), "left_anti").select("doc_id")


@query("j13_asset_pins", "SELECT 'asset' || k AS asset, CASE k % 5 WHEN 0 THEN 'matched' WHEN 1 THEN 'rows_drift' WHEN 2 THEN 'sha256_drift' WHEN 3 THEN 'missing' ELSE 'duplicate' END AS status FROM (SELECT DISTINCT item_id // 20 AS k FROM benchmark)")
def j13(spark, sf):
    # Files of benchmark items are written, then checked against pins of which four fifths are wrong in one way each.
    items = table(spark, sf, "benchmark").select(F.floor(F.col("item_id") / 20).alias("k"), F.to_json(F.struct("item_id", "text")).alias("line"))
    lines = F.array_join(F.array_sort(F.collect_list("line")), "\n")
    assets = dedup.written(items.groupBy("k").agg(F.concat(lines, F.lit("\n")).alias("content"), F.count("*").alias("rows")), "assets")
    at = f"{dedup.shared(spark)}/assets-{uuid.uuid4().hex}"
    assets.where("k % 5 <> 3").select(F.expr("substring(content, 1, length(content) - 1)").alias("value"), F.concat(F.lit("asset"), "k").alias("asset")).write.partitionBy("asset").text(at)
    pinned = F.when(F.col("k") % 5 == 1, F.col("rows") + 1).otherwise(F.col("rows"))
    sha = F.when(F.col("k") % 5 == 2, F.sha2(F.concat("content", F.lit("x")), 256)).otherwise(F.sha2("content", 256))
    pins = assets.select(F.concat(F.lit("asset"), "k").alias("asset"), sha.alias("sha256"), pinned.alias("rows"))
    pins = pins.unionByName(pins.join(assets.where("k % 5 = 4").select(F.concat(F.lit("asset"), "k").alias("asset")), "asset", "left_semi"))
    return joins.asset_pins(pins, readers.text_assets(spark, at, r"asset=([^/]+)/"))


# Deduplication.


@query("u01_exact_dedup", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def u01(spark, sf):
    return dedup.keep_first(docs(spark, sf).select("doc_id", F.sha2("text", 256).alias("sha")), "sha", "doc_id").select("doc_id")


@query("u02_content_chunks")
def u02(spark, sf):
    return docs(spark, sf).select("doc_id", arrow.nfkc_fold("text").alias("key")).select("doc_id", F.posexplode(arrow.content_chunks("key")).alias("pos", "chunk"))


@query("u03_minhash_signature")
def u03(spark, sf):
    return dedup.signed(docs(spark, sf)).select("doc_id", F.array_join(F.transform("sig", lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), ",").alias("near_signature"))


@query("u04_lsh_bands")
def u04(spark, sf):
    return dedup.bands(dedup.signed(docs(spark, sf)).select("doc_id", "sig")).select("doc_id", "band", "x", "y")


@query("u05_near_dedup_greedy")
def u05(spark, sf):
    return dedup.near_dedup(docs(spark, sf), "doc_id")


@query("u06_near_dedup_index")
def u06(spark, sf):
    return dedup.wide_pairs(dedup.written(dedup.wide_signed(docs(spark, sf)).select("doc_id", "sig"), "signed"), "doc_id")


@query("u07_sample_near_duplicate_rate")
def u07(spark, sf):
    s = dedup.written(dedup.signed(docs(spark, sf)).select("doc_id", "sig"), "signed")
    later = dedup.near_pairs(s, "doc_id", measure=dedup.overlap).select(F.col("b").alias("doc_id")).distinct()
    copies = s.where(F.size("sig") == dedup.COORDINATES).groupBy("sig").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"))
    hits = copies.join(later.withColumn("hit", F.lit(1)), "doc_id", "left").agg(F.coalesce(F.sum(F.col("n") - F.when(F.col("hit") == 1, 0).otherwise(1)), F.lit(0)).alias("near_duplicates"))
    return hits.join(s.agg(F.count("*").alias("documents")), F.lit(True))


@query("u08_build_overlap_index")
def u08(spark, sf):
    both = docs(spark, sf).select("doc_id", F.posexplode(F.array("text", T.with_title("source", "text"))).alias("variant", "text"))
    return dedup.signed(both).select("doc_id", F.sha2("key", 256).alias("sha"), "sig").distinct()


@query("u09_dedupe_prompts", r"SELECT min(conv_id * 1000 + turn) AS ord FROM conversations WHERE role = 'user' GROUP BY lower(regexp_replace(text, '\s+', '', 'g'))")
def u09(spark, sf):
    rows = table(spark, sf, "conversations").where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), F.lower(T.squeeze("text")).alias("key"))
    return dedup.keep_first(rows, "key", "ord").select("ord")


@query("u10_label_dedup", "SELECT sha256(text) AS sha, min(doc_id) AS doc_id, min(quality) <> max(quality) AS conflict FROM documents JOIN labels USING (doc_id) GROUP BY sha256(text)")
def u10(spark, sf):
    j = docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    return j.groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"), (F.min("quality") != F.max("quality")).alias("conflict"))


@query("u11_one_per_conversation", "SELECT conv_id, arg_min(turn, md5(CAST(turn AS VARCHAR))) AS turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def u11(spark, sf):
    rows = table(spark, sf, "conversations").where("role = 'assistant'")
    return rows.groupBy("conv_id").agg(F.min_by("turn", F.md5(F.col("turn").cast("string").cast("binary"))).alias("turn"))


# Windows.

_QUOTA = "CASE WHEN source = 'src1' THEN 20000 ELSE 9000 END"


@query("w01_select_under_quota", f"SELECT doc_id, least(n_chars + 1, q - b) AS accepted FROM (SELECT doc_id, n_chars, {_QUOTA} AS q, coalesce(sum(n_chars + 1) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM documents WHERE n_chars > 0) WHERE b < q")
def w01(spark, sf):
    return windows.under_quota(docs(spark, sf).select("doc_id", "source", "n_chars").withColumn("q", F.expr(_QUOTA)), "source", ["doc_id"], "n_chars", "q").select("doc_id", "accepted")


@query("w02_select_soft_quota", f"SELECT doc_id, n_chars + 1 AS accepted FROM (SELECT doc_id, n_chars, {_QUOTA} AS q, coalesce(sum(n_chars + 1) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) WHERE b < q")
def w02(spark, sf):
    return windows.soft_quota(docs(spark, sf).select("doc_id", "source", "n_chars").withColumn("q", F.expr(_QUOTA)), "source", ["doc_id"], "n_chars", "q").select("doc_id", "accepted")


@query(
    "w03_select_byte_budget",
    r"SELECT doc_id, CASE WHEN n <= 3000 - b THEN n ELSE strlen(regexp_replace(left(t, 3000 - b), '^\s+|\s+$', '', 'g')) END AS bytes FROM (SELECT doc_id, t, strlen(t)::BIGINT AS n, coalesce(sum(strlen(t)) OVER (PARTITION BY source, doc_id % 10 ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM (SELECT doc_id, source, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') AS t FROM documents)) WHERE b < 3000 AND n > 0",
)
def w03(spark, sf):
    # Each source's budget is spread over ten files of it; in ASCII a cut falls at its byte.
    rows = docs(spark, sf).select("doc_id", F.concat_ws("/", "source", (F.col("doc_id") % 10).cast("string")).alias("file"), F.regexp_replace("text", r"[^\x{00}-\x{7F}]", "?").alias("text"))
    return windows.byte_budget(rows, "file", ["doc_id"], "text", 3000).select("doc_id", F.octet_length("text").cast("long").alias("bytes"))


@query("w03_select_byte_budget_utf8")
def w03_utf8(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.concat_ws("/", "source", (F.col("doc_id") % 10).cast("string")).alias("file"), "text")
    return windows.byte_budget(rows, "file", ["doc_id"], "text", 3000).select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha"))


@query("w04_round_robin", "SELECT doc_id, row_number() OVER (ORDER BY r, source) AS place FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) ORDER BY r, source LIMIT 100")
def w04(spark, sf):
    first = windows.ranked(docs(spark, sf).select("doc_id", "source"), ["source"], [F.col("doc_id")], "r").orderBy("r", "source").limit(100)
    return first.select("doc_id", F.row_number().over(Window.orderBy("r", "source")).alias("place"))


@query("w05_top_k_per_group", "SELECT source, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 10")
def w05(spark, sf):
    return windows.top_k(docs(spark, sf).select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 10)


@query("w06_hash_sample_k", "SELECT source, min(doc_id) AS doc_id FROM (SELECT source, doc_id, dense_rank() OVER (PARTITION BY source ORDER BY sha256(source || '~' || text)) AS r FROM documents WHERE length(text) >= 64) WHERE r <= 5 GROUP BY source, r")
def w06(spark, sf):
    rows = docs(spark, sf).where(F.length("text") >= 64).withColumn("h", F.sha2(F.concat("source", F.lit("~"), "text"), 256))
    unique = rows.groupBy("source", "h").agg(F.min("doc_id").alias("doc_id"))
    return windows.top_k(unique, ["source"], [F.col("h")], 5).select("source", "doc_id")


@query("w07_seeded_select", "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('17:' || doc_id)) <= 20")
def w07(spark, sf):
    key = F.sha2(F.concat(F.lit("17:"), F.col("doc_id").cast("string")), 256)
    return windows.top_k(docs(spark, sf).select("doc_id", "lang"), ["lang"], [key], 20)


_SHARES = "(SELECT source, sum(n_chars)::DOUBLE / (SELECT sum(n_chars) FROM documents) AS f FROM documents GROUP BY source)"


def shares(spark, sf):
    per = docs(spark, sf).groupBy("source").agg(F.sum("n_chars").alias("n"))
    return per.withColumn("f", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def _remainder(order):
    return f"WITH p AS (SELECT source, f, floor(round(f * 100003, 9)) AS fl, round(round(f * 100003, 9) - floor(round(f * 100003, 9)), 9) AS rest FROM {_SHARES}) SELECT source, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, {order}) <= 100003 - sum(fl) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM p"


@query("w08_largest_remainder", _remainder("f DESC, source"))
def w08(spark, sf):
    return windows.largest_remainder(shares(spark, sf), F.lit(100003), "f", "source", []).select("source", "quota")


@query("w09_largest_remainder_name", _remainder("source"))
def w09(spark, sf):
    return windows.largest_remainder(shares(spark, sf), F.lit(100003), "f", "source", [], "name").select("source", "quota")


@query("w09_largest_remainder_descending", _remainder("source DESC"))
def w09b(spark, sf):
    return windows.largest_remainder(shares(spark, sf), F.lit(100003), "f", "source", [], "descending").select("source", "quota")


_MINIMUM = f"WITH c AS (SELECT 100003 - count(*) AS t FROM {_SHARES}), p AS (SELECT source, f, t, floor(round(f * t, 9)) AS fl, round(round(f * t, 9) - floor(round(f * t, 9)), 9) AS rest FROM {_SHARES}, c) SELECT source, CAST(1 + fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, source DESC) <= t - sum(fl) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM p"


@query("w09_largest_remainder_minimum", _MINIMUM)
def w09c(spark, sf):
    return windows.largest_remainder(shares(spark, sf), F.lit(100003), "f", "source", [], "minimum").select("source", "quota")


@query("w09_rounded_half_even", f"WITH p AS (SELECT source, f, round_even(round(f * 100003, 9), 0) AS own, row_number() OVER (ORDER BY f DESC, source) AS r FROM {_SHARES}) SELECT source, CAST(own + CASE WHEN r = 1 THEN 100003 - sum(own) OVER () ELSE 0 END AS BIGINT) AS quota FROM p")
def w09d(spark, sf):
    return windows.largest_remainder(shares(spark, sf), F.lit(100003), "f", "source", [], "half_even").select("source", "quota")


@query("w10_ordered_sources", "SELECT source, row_number() OVER (ORDER BY p DESC, source) AS place FROM (SELECT source, count(*) % 3 AS p FROM documents GROUP BY source)")
def w10(spark, sf):
    per = docs(spark, sf).groupBy("source").agg((F.count("*") % 3).alias("p"))
    return per.select("source", F.row_number().over(Window.orderBy(F.desc("p"), "source")).alias("place"))


@query("w11_group_advantages", "SELECT l_orderkey, l_linenumber, round((q - avg(q) OVER w) / (stddev_pop(q) OVER w + 1e-6), 4) AS advantage FROM (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS q FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey)")
def w11(spark, sf):
    w = Window.partitionBy("l_orderkey")
    q = F.col("l_quantity").cast("double")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round((q - F.avg(q).over(w)) / (F.stddev_pop(q).over(w) + 1e-6), 4).alias("advantage"))


@query("w12_series_stats", "SELECT event_type, min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean, round(median(value), 6) AS median, arg_max(value, event_id) AS latest, round(arg_max(r, event_id), 6) AS rolling FROM (SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS r FROM events) GROUP BY event_type")
def w12(spark, sf):
    roll = F.avg("value").over(Window.partitionBy("event_type").orderBy("event_id").rowsBetween(-19, 0))
    e = table(spark, sf, "events").select("event_type", "event_id", "value", roll.alias("r"))
    return e.groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("median"), F.max_by("value", "event_id").alias("latest"), F.round(F.max_by("r", "event_id"), 6).alias("rolling"))


@query("w13_latest_per_step", "SELECT event_type, user_id AS step, max(event_id) AS event_id FROM events GROUP BY event_type, user_id")
def w13(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", F.col("user_id").alias("step")).agg(F.max("event_id").alias("event_id"))


@query("w14_step_continuity", "SELECT user_id, count(*) FILTER (WHERE p > event_id) AS breaks, bool_or(user_id % 3 = 0 OR event_id % 7 = 3) AS resumed FROM (SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY user_id")
def w14(spark, sf):
    # Every third user began anew; the others resumed at a step that leaves 3 by 7, if they have one.
    start = F.when(F.col("user_id") % 3 != 0, F.when(F.col("event_id") % 7 == 3, F.col("event_id")).otherwise(-1))
    return windows.step_continuity(table(spark, sf, "events").withColumn("start", start), "user_id", ["ts", "event_id"], "event_id", "start")


_PACK = "SELECT source, doc_id, list_append(list_transform(regexp_split_to_array(text, '\\s+'), lambda x: length(x)), 0) AS t FROM documents"


@query("w15_pack_windows", f"WITH e AS (SELECT source, doc_id, unnest(t) AS v, generate_subscripts(t, 1) AS i FROM ({_PACK})), n AS (SELECT source, v, row_number() OVER (PARTITION BY source ORDER BY doc_id, i) - 1 AS p FROM e) SELECT source, p // 512 AS w, sum(v)::BIGINT AS total, sum(v * (p % 512))::BIGINT AS weighted FROM n GROUP BY source, p // 512 HAVING count(*) = 512")
def w15(spark, sf):
    tokens = F.concat(F.transform(F.split("text", r"\s+"), F.length), F.array(F.lit(0)))
    packed = windows.pack_windows(docs(spark, sf).select("source", "doc_id", tokens.alias("t")), "source", ["doc_id"], "t", 512)
    total = F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    weighted = F.aggregate(F.transform("tokens", lambda x, i: (x * i).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return packed.select("source", F.col("window").alias("w"), total.alias("total"), weighted.alias("weighted"))


@query("w16_epoch_order", "SELECT doc_id, doc_id % 4 AS worker, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY sha256('7:1:' || doc_id)) AS place FROM documents")
def w16(spark, sf):
    key = F.sha2(F.concat(F.lit("7:1:"), F.col("doc_id").cast("string")), 256)
    rows = docs(spark, sf).select("doc_id", (F.col("doc_id") % 4).alias("worker"), key.alias("k"))
    return windows.placed(rows, "worker", ["k"], "place").drop("k")


@query("w16_window_order")
def w16_windows(spark, sf):
    """The windows of 4,096 characters that the documents fill, in the order of an epoch, dealt to four workers."""
    n = docs(spark, sf).agg(F.floor(F.sum("n_chars") / 4096).alias("n")).first().n
    return windows.epoch_windows(spark, n or 0, 7, 1, 4)


@query("w17_split_long_docs", "SELECT doc_id, len(t) AS n, CASE WHEN len(t) <= 100 THEN 1 WHEN len(t) % 100 >= 30 THEN len(t) // 100 + 1 ELSE greatest(len(t) // 100, 1) END AS chunks FROM (SELECT doc_id, regexp_split_to_array(text, '\\s+') AS t FROM documents)")
def w17(spark, sf):
    t = F.split("text", r"\s+")
    return docs(spark, sf).select("doc_id", F.size(t).cast("long").alias("n"), F.size(windows.split_long(t, 100, 30)).cast("long").alias("chunks"))


@query("w18_sample_document_at_offset", "WITH d AS (SELECT doc_id, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, sum(n_chars) OVER (ORDER BY doc_id) AS b FROM documents), k AS (SELECT i, (i * 7919 * 104729) % (SELECT sum(n_chars) FROM documents) AS o FROM range(40) r(i)) SELECT i, doc_id FROM k JOIN d ON o >= a AND o < b")
def w18(spark, sf):
    d = docs(spark, sf).select("doc_id", "n_chars", (F.col("doc_id") * 0).alias("one"))
    total = d.agg(F.sum("n_chars")).first()[0]
    d = windows.with_prefix(d, "one", ["doc_id"], F.col("n_chars"), "a").withColumn("b", F.col("a") + F.col("n_chars"))
    k = spark.range(40).select(F.col("id").alias("i"), (F.col("id") * 7919 * 104729 % total).alias("o"))
    return d.join(F.broadcast(k), (F.col("o") >= F.col("a")) & (F.col("o") < F.col("b"))).select("i", "doc_id")


@query("w19_length_batches")
def w19(spark, sf):
    return windows.length_batches(docs(spark, sf).select("doc_id", "n_chars"), "n_chars", "doc_id", 65_536, 32)


# Mixture planning.


@query(
    "m01_max_unique_total",
    """WITH s AS (SELECT source, sum(n_chars) AS s, (count(*) + 100)::DOUBLE / (SELECT count(*) + 100 * count(DISTINCT source) FROM documents) AS f FROM documents GROUP BY source), b AS (SELECT CAST(min(floor(round(s / f, 6))) AS BIGINT) AS lo, CAST(min(ceil((s + 1) / f)) AS BIGINT) + 1 AS hi FROM s),
    t AS (SELECT unnest(range(greatest(lo - 25, 0), hi + 1)) AS total FROM b), x AS (SELECT total, source, s, f, round(f * total, 9) AS own FROM s, t), y AS (SELECT *, floor(own) AS fl, row_number() OVER (PARTITION BY total ORDER BY round(own - floor(own), 9) DESC, f DESC, source) AS r, total - sum(floor(own)) OVER (PARTITION BY total) AS drift FROM x),
    g AS (SELECT total, bool_and(fl + CASE WHEN r <= drift THEN 1 ELSE 0 END <= s) AS ok FROM y GROUP BY total), n AS (SELECT min(total) AS m FROM g, b WHERE NOT ok AND total > (SELECT max(total) FROM g, b WHERE ok AND total <= lo)) SELECT m - 1 AS total FROM n""",
)
def m01(spark, sf):
    per = docs(spark, sf).groupBy("source").agg(F.sum("n_chars").alias("s"), F.count("*").alias("c"))
    whole = per.agg(F.sum(F.col("c") + 100).alias("w"))
    shares_ = per.join(whole, F.lit(True)).select("source", "s", ((F.col("c") + 100) / F.col("w")).alias("f"))
    return policy.max_unique_total(shares_, "source", "s", "f")


@query("m02_resolve_mix", "WITH p AS (SELECT source, CASE WHEN n_chars < 2000 THEN 'short' ELSE 'long' END AS b, sum(n_chars) AS s FROM documents GROUP BY ALL), x AS (SELECT source, b, s, 5000 * s::DOUBLE / sum(s) OVER (PARTITION BY source) AS raw FROM p), y AS (SELECT *, floor(round(raw, 9)) AS fl, round(round(raw, 9) - floor(round(raw, 9)), 9) AS rest FROM x) SELECT source, b, CAST(fl + CASE WHEN row_number() OVER (PARTITION BY source ORDER BY rest DESC, s DESC, b) <= 5000 - sum(fl) OVER (PARTITION BY source) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM y")
def m02(spark, sf):
    p = docs(spark, sf).groupBy("source", F.when(F.col("n_chars") < 2000, "short").otherwise("long").alias("b")).agg(F.sum("n_chars").alias("s"))
    p = p.withColumn("f", F.col("s") / F.sum("s").over(Window.partitionBy("source")))
    return windows.largest_remainder(p, F.lit(5000), "f", "b", ["source"]).select("source", "b", "quota")


@query(
    "m03_materialize_policy",
    """WITH s AS (SELECT source, sum(n_chars)::DOUBLE AS s FROM documents GROUP BY source), g AS (SELECT source, s, CASE WHEN source IN ('src0', 'src1') THEN 'a' WHEN source IN ('src2', 'src3', 'src4') THEN 'b' ELSE 'c' END AS g FROM s),
    t AS (SELECT floor(0.5 * sum(s)) AS t FROM s), q AS (SELECT g, sum(s) AS have, CASE g WHEN 'a' THEN floor(t * 0.5) WHEN 'b' THEN floor(t * 0.2) ELSE t - floor(t * 0.5) - floor(t * 0.2) END AS want FROM g, t GROUP BY g, t),
    f AS (SELECT g, have, CASE g WHEN 'a' THEN least(want, have) WHEN 'c' THEN want + (SELECT greatest(0, want - have) FROM q WHERE g = 'a') + (SELECT greatest(0, want - have) FROM q WHERE g = 'b') ELSE least(want, have) END AS target FROM q),
    x AS (SELECT source, g.g, s, target, have, CASE g.g WHEN 'c' THEN greatest(0, least(s, target - coalesce(sum(s) OVER (PARTITION BY g.g ORDER BY source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) ELSE floor(s * target / have) END AS own, row_number() OVER (PARTITION BY g.g ORDER BY source DESC) = 1 AS last FROM g JOIN f ON g.g = f.g)
    SELECT source, g AS "group", CAST(own + CASE WHEN last AND g <> 'c' THEN target - sum(own) OVER (PARTITION BY g) ELSE 0 END AS BIGINT) AS target FROM x""",
)
def m03(spark, sf):
    supply = docs(spark, sf).groupBy("source").agg(F.sum("n_chars").alias("tokens"))
    group = F.when(F.col("source").isin("src0", "src1"), "a").when(F.col("source").isin("src2", "src3", "src4"), "b").otherwise("c")
    total = int(supply.agg(F.floor(F.sum("tokens") * 0.5)).first()[0] or 0)
    groups = [policy.Group("a", 0.5, "c"), policy.Group("b", 0.2, "c"), policy.Group("c", 0.3, "", fill=True)]
    return policy.materialized(supply.withColumn("group", group), groups, total)


@query(
    "m04_validate_policy",
    f"""SELECT 'fractions_sum_to_one' AS name, abs(sum(f) - 1) < 1e-9 AS passed FROM {_SHARES} UNION ALL SELECT 'source_maximum', max(f) <= 0.2 FROM {_SHARES} UNION ALL SELECT 'group_minimum', coalesce(sum(f) FILTER (WHERE source IN ('src0', 'src1', 'src2')), 0) >= 0.1 FROM {_SHARES}
    UNION ALL SELECT 'group_exact', abs(coalesce(sum(f) FILTER (WHERE source IN ('src0', 'src3')), 0) - 0.25) < 1e-9 FROM {_SHARES} UNION ALL SELECT 'unique_only', count(*) = count(DISTINCT source) FROM {_SHARES}""",
)
def m04(spark, sf):
    limits = [policy.Limit("group_minimum", ("src0", "src1", "src2"), least=0.1), policy.Limit("group_exact", ("src0", "src3"), exactly=0.25)]
    return policy.violations(shares(spark, sf), "source", "f", 0.2, limits)


@query("m05_split_quotas", "SELECT source, CASE WHEN doc_id % 50 = 0 THEN 'val' ELSE 'train' END AS split, CASE WHEN doc_id % 50 = 0 THEN sum(n_chars + 1) ELSE least(sum(n_chars + 1), 20000) END AS quota FROM documents GROUP BY source, doc_id % 50 = 0")
def m05(spark, sf):
    val = F.col("doc_id") % 50 == 0
    p = docs(spark, sf).groupBy("source", val.alias("v")).agg(F.sum(F.col("n_chars") + 1).alias("s"))
    return p.select("source", F.when(F.col("v"), "val").otherwise("train").alias("split"), F.when(F.col("v"), F.col("s")).otherwise(F.least(F.col("s"), F.lit(20000))).alias("quota"))


@query(
    "m06_remaining_quota",
    """WITH p AS (SELECT source, count(*) * 3000 AS quota, coalesce(sum(n_chars) FILTER (WHERE doc_id % 4 = 0), 0) AS done FROM documents GROUP BY source), r AS (SELECT source, greatest(0, quota - done) AS remaining, quota, done FROM p), d AS (SELECT greatest(0, sum(quota) - sum(done)) - sum(remaining) AS drift FROM r)
    SELECT source, CAST(remaining + CASE WHEN row_number() OVER (ORDER BY remaining DESC, source) = 1 THEN drift ELSE 0 END AS BIGINT) AS remaining FROM r, d""",
)
def m06(spark, sf):
    plan = docs(spark, sf).groupBy("source").agg((F.count("*") * 3000).alias("quota"))
    done = docs(spark, sf).where("doc_id % 4 = 0").groupBy("source").agg(F.sum("n_chars").alias("done"))
    return policy.remaining(plan, done, "source")


@query("m07_filter_sources_fill", "WITH p AS (SELECT source, sum(n_chars)::DOUBLE AS s FROM documents WHERE source IN ('src0', 'src1', 'src2') GROUP BY source), x AS (SELECT source, s / (SELECT sum(s) FROM p) AS f FROM p), y AS (SELECT source, f, floor(round(f * 100003, 9)) AS fl, round(round(f * 100003, 9) - floor(round(f * 100003, 9)), 9) AS rest FROM x) SELECT source, CAST(fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, source DESC) <= 100003 - sum(fl) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM y")
def m07(spark, sf):
    p = docs(spark, sf).where("source in ('src0', 'src1', 'src2')").groupBy("source").agg(F.sum("n_chars").cast("double").alias("s"))
    scaled = p.withColumn("f", F.col("s") / F.sum("s").over(Window.partitionBy(F.lit(1))))
    return windows.largest_remainder(scaled, F.lit(100003), "f", "source", [], "descending").select("source", "quota")


# Sorts, pools, set operations.


@query("t01_sort_by_id", "SELECT doc_id, source FROM documents ORDER BY doc_id")
def t01(spark, sf):
    return docs(spark, sf).select("doc_id", "source").orderBy("doc_id")


@query("t02_seeded_shuffle", "SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha256('3:' || source || ':' || doc_id)) AS place FROM documents")
def t02(spark, sf):
    key = F.sha2(F.concat(F.lit("3:"), "source", F.lit(":"), F.col("doc_id").cast("string")), 256)
    return windows.placed(docs(spark, sf).select("doc_id", "source", key.alias("k")), "source", ["k"], "place").drop("k")


@query("t03_limit_inputs", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def t03(spark, sf):
    return docs(spark, sf).select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(25)


@query("t04_stratified_pool", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY sha256('5:' || doc_id)) AS r, floor(100 * count(*) OVER (PARTITION BY lang) / (SELECT count(*) FROM documents)) AS k FROM documents) WHERE r <= k")
def t04(spark, sf):
    key = F.sha2(F.concat(F.lit("5:"), F.col("doc_id").cast("string")), 256)
    per = docs(spark, sf).groupBy("lang").agg(F.count("*").alias("n"))
    per = per.withColumn("k", F.floor(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))))
    # A hundred rows at most are wanted of a language, so each partition sends no more (row_number with a limit).
    first = windows.top_k(docs(spark, sf).select("doc_id", "lang", key.alias("key")), ["lang"], [F.col("key")], 100, "r")
    return first.join(joins.small(per), "lang").where("r <= k").select("doc_id")


@query("t05_prefer_long_turns", "SELECT conv_id, least(count(*), 9) AS turns FROM conversations GROUP BY conv_id ORDER BY least(count(*), 9) DESC, sha256('9:' || conv_id) LIMIT 50")
def t05(spark, sf):
    per = table(spark, sf, "conversations").groupBy("conv_id").agg(F.least(F.count("*"), F.lit(9)).alias("turns"))
    return per.orderBy(F.desc("turns"), F.sha2(F.concat(F.lit("9:"), F.col("conv_id").cast("string")), 256)).limit(50)


@query("t06_probe_set", "SELECT doc_id, 'fixed' AS part FROM documents WHERE n_chars > 15000 UNION ALL SELECT doc_id, 'drawn' FROM (SELECT doc_id, lang, n_chars FROM documents WHERE n_chars <= 15000 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('p:' || doc_id)) <= 7)")
def t06(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang", "n_chars")
    drawn = windows.top_k(d.where("n_chars <= 15000"), ["lang"], [F.sha2(F.concat(F.lit("p:"), F.col("doc_id").cast("string")), 256)], 7)
    return d.where("n_chars > 15000").select("doc_id", F.lit("fixed").alias("part")).unionByName(drawn.select("doc_id", F.lit("drawn").alias("part")))


@query("e01_bundle_union", "SELECT name, count(*) AS n, count(*) = 1 AS passed FROM (SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation WHERE n_nationkey % 5 = 0) GROUP BY name")
def e01(spark, sf):
    nation, region = table(spark, sf, "nation").select(F.col("n_name").alias("name"), "n_nationkey"), table(spark, sf, "region").select(F.col("r_name").alias("name"))
    return policy.bundled([nation, region, nation.where("n_nationkey % 5 = 0").drop("n_nationkey")], "name").groupBy("name").agg(F.count("*").alias("n"), F.bool_and("unique").alias("passed"))


@query(
    "e02_append_only_check",
    """WITH o AS (SELECT source, row_number() OVER (ORDER BY source) AS p FROM documents WHERE source <> 'src9' GROUP BY source), n AS (SELECT source, row_number() OVER (ORDER BY source) AS p FROM documents GROUP BY source)
    SELECT (SELECT count(*) FROM (SELECT doc_id, text FROM documents WHERE source <> 'src9' EXCEPT ALL SELECT doc_id, text FROM documents)) = 0 AS kept, (SELECT count(*) FROM documents) > (SELECT count(*) FROM documents WHERE source <> 'src9') AS grown,
    (SELECT count(*) FROM o LEFT JOIN n USING (source, p) WHERE n.p IS NULL) = 0 AS ordered_prefix""",
)
def e02(spark, sf):
    # The sources in order: without the last one the old list is a prefix of the new one.
    new = docs(spark, sf).select("doc_id", "text", "source")
    old = new.where("source <> 'src9'")
    listed = lambda d: d.select("source").distinct().withColumn("p", F.row_number().over(Window.orderBy("source")))
    return policy.append_only(old.select("doc_id", "text"), new.select("doc_id", "text"), listed(old), listed(new), ["source", "p"])


@query("e03_partition_check", "SELECT source, count(DISTINCT lang) AS domains, count(DISTINCT lang) = 1 AS disjoint FROM documents GROUP BY source")
def e03(spark, sf):
    return policy.disjoint(docs(spark, sf), "source", "lang").withColumnRenamed("n", "domains")


_DOMAINS = {"chinese": "lang = 'es'", "code": "contains(text, '=')", "math": "regexp_like(text, '[0-9]{4,}')"}


@query("e04_domain_difference", "SELECT DISTINCT sha256(text) AS sha FROM documents EXCEPT SELECT sha256(text) FROM documents WHERE lang = 'es' OR contains(text, '=') OR regexp_matches(text, '[0-9]{4,}')")
def e04(spark, sf):
    # English is what no other domain has, by content: a copy in another domain takes a text out.
    d = docs(spark, sf).withColumn("sha", F.sha2("text", 256))
    others = functools.reduce(lambda a, b: a.unionByName(b), [d.where(rule).select("sha") for rule in _DOMAINS.values()])
    return d.select("sha").distinct().join(others.distinct(), "sha", "left_anti")


@query("e05_benchmark_union", r"SELECT arg_min(id, o) AS id FROM (SELECT 'old' || item_id AS id, item_id AS o, text FROM benchmark UNION ALL SELECT 'new' || doc_id, doc_id + 1000000000, text FROM documents) WHERE length(regexp_replace(text, '\s+', '', 'g')) >= 24 GROUP BY lower(regexp_replace(text, '\s+', '', 'g'))")
def e05(spark, sf):
    new = docs(spark, sf).select(F.concat(F.lit("new"), "doc_id").alias("id"), (F.col("doc_id") + 1_000_000_000).alias("ord"), "text")
    old = table(spark, sf, "benchmark").select(F.concat(F.lit("old"), "item_id").alias("id"), F.col("item_id").alias("ord"), "text")
    keyed = old.unionByName(new).withColumn("key", F.lower(T.squeeze("text"))).where(F.length("key") >= 24)
    return keyed.groupBy(F.sha2("key", 256).alias("k")).agg(F.min_by("id", "ord").alias("id")).select("id")
