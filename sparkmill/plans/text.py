"""Queries of the text functions and quality rules, over documents, benchmark and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import query, table
from ..functions import arrow
from ..functions import patterns as P
from ..functions import text as T
from ..operators import filters as Q

# DuckDB's RE2 has \s for ASCII white space; the tables have no other.
LINES = r"list_filter(regexp_split_to_array(text, '\r\n|\r|\n'), lambda x: true)"


def docs(spark, sf):
    return table(spark, sf, "documents")


def talks(spark, sf):
    return table(spark, sf, "conversations")


@query("p01_normalize_text")
def p01(spark, sf):
    return docs(spark, sf).select("doc_id", T.strip(arrow.nfc(T.control_free("text"))).alias("text"))


@query("p02_dedup_normalize")
def p02(spark, sf):
    return docs(spark, sf).select("doc_id", arrow.nfkc_fold("text").alias("key"))


@query("p03_poison_normalize", r"SELECT doc_id, regexp_replace(text, '\s+', '', 'g') AS squeezed FROM documents")
def p03(spark, sf):
    return docs(spark, sf).select("doc_id", T.squeeze("text").alias("squeezed"))


@query(
    "p04_strip_trailing_boilerplate",
    r"""WITH l AS (SELECT doc_id, unnest(ls) AS s, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS ls FROM documents)),
    e AS (SELECT doc_id, max(i) AS last FROM l WHERE trim(s, chr(32) || chr(9)) <> '' GROUP BY doc_id),
    k AS (SELECT l.doc_id, e.last, e.last - i AS back, regexp_matches(s, '(?i)(?:订阅|手机报|免责声明|版权所有|备案号|ICP备|联系我们|扫码关注|all rights reserved|privacy policy|cookie policy)') AS hit FROM l JOIN e USING (doc_id) WHERE i <= e.last),
    c AS (SELECT doc_id, last, least(coalesce(min(CASE WHEN NOT hit THEN back END), last), 8) AS cut FROM k GROUP BY doc_id, last)
    SELECT d.doc_id, CASE WHEN c.doc_id IS NULL THEN '' ELSE regexp_replace(array_to_string(list_slice(regexp_split_to_array(d.text, '\r\n|\r|\n'), 1, c.last - c.cut), chr(10)), '^\s+|\s+$', '', 'g') END AS text FROM documents d LEFT JOIN c USING (doc_id)""",
)
def p04(spark, sf):
    return docs(spark, sf).select("doc_id", arrow.drop_footer("text").alias("text"))


@query(
    "p05_language_ratios",
    r"""SELECT doc_id, round(cjk / greatest(cjk + latin, 1), 6) AS cjk_ratio, round(latin / greatest(cjk + latin, 1), 6) AS latin_ratio FROM
    (SELECT doc_id, len(regexp_extract_all(text, '[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]'))::DOUBLE AS cjk, len(regexp_extract_all(text, '[A-Za-z]'))::DOUBLE AS latin FROM documents)""",
)
def p05(spark, sf):
    cjk, latin = T.script_ratios("text")
    return docs(spark, sf).select("doc_id", F.round(cjk, 6).alias("cjk_ratio"), F.round(latin, 6).alias("latin_ratio"))


@query("p06_length_bucket", "SELECT doc_id, CASE WHEN length(text) < 2000 THEN 'chars_lt_2k' WHEN length(text) < 8000 THEN 'chars_2k_8k' WHEN length(text) < 32000 THEN 'chars_8k_32k' ELSE 'chars_ge_32k' END AS length_bucket FROM documents")
def p06(spark, sf):
    return docs(spark, sf).select("doc_id", T.length_bucket(F.length("text")).alias("length_bucket"))


@query("p07_token_length_bucket", "SELECT doc_id, CASE WHEN n_chars < 4096 THEN 'tokens_lt_4k' WHEN n_chars < 8192 THEN 'tokens_4k_8k' WHEN n_chars < 16384 THEN 'tokens_8k_16k' ELSE 'tokens_ge_16k' END AS token_bucket FROM documents")
def p07(spark, sf):
    return docs(spark, sf).select("doc_id", T.token_length_bucket("n_chars").alias("token_bucket"))


@query("p08_document_year", r"SELECT event_id, CASE WHEN regexp_extract(s, '^(19[0-9]{2}|20[0-9]{2}|2100)(?:[-T]|$)', 1) = '' THEN 'unknown' ELSE regexp_extract(s, '^(19[0-9]{2}|20[0-9]{2}|2100)(?:[-T]|$)', 1) END AS year FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN props ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS s FROM events)")
def p08(spark, sf):
    stamp = F.when(F.col("event_id") % 7 == 0, F.col("props")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf, "events").select("event_id", T.document_year(stamp).alias("year"))


@query(
    "p09_license_ids",
    r"""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array(lic, '\s*(?:,|\bOR\b|\bAND\b)\s*'), lambda x: lower(trim(x))), lambda x: x <> ''))), '|') AS ids
    FROM (SELECT doc_id, source || ' OR MIT, ' || upper(lang) || ' AND mit' AS lic FROM documents)""",
)
def p09(spark, sf):
    lic = F.concat("source", F.lit(" OR MIT, "), F.upper("lang"), F.lit(" AND mit"))
    return docs(spark, sf).select("doc_id", F.array_join(T.license_ids(lic), "|").alias("ids"))


@query("p09_license_label", "SELECT source, array_to_string(list_sort(list_distinct(list(trim(lang)))), ' OR ') AS label FROM documents GROUP BY source")
def p09b(spark, sf):
    return docs(spark, sf).groupBy("source").agg(F.collect_set("lang").alias("l")).select("source", T.license_label("l").alias("label"))


@query("p10_record_value", "SELECT event_id, json_extract_string(props, '$.page') AS page, json_extract_string(props, '$.missing.deep') AS missing FROM events")
def p10(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.page").alias("page"), F.get_json_object("props", "$.missing.deep").alias("missing"))


@query("p11_prepend_title", "SELECT doc_id, CASE WHEN starts_with(text, t) THEN text ELSE t || chr(10) || chr(10) || text END AS text FROM (SELECT doc_id, text, CASE WHEN doc_id % 2 = 0 THEN left(source, 3) ELSE left(trim(text), 1) END AS t FROM documents) WHERE t <> ''")
def p11(spark, sf):
    title = F.when(F.col("doc_id") % 2 == 0, F.left("source", F.lit(3))).otherwise(F.left(F.trim("text"), F.lit(1)))
    return docs(spark, sf).where(T.strip(title) != "").select("doc_id", T.with_title(title, "text").alias("text"))


@query("p12_coalesce_lineage", "SELECT e.event_id, coalesce(nullif(json_extract_string(props, '$.id'), ''), nullif(json_extract_string(props, '$.page'), ''), sha256(props)) AS document_id, coalesce(json_extract_string(props, '$.license'), 'source default') AS license FROM events e")
def p12(spark, sf):
    first = F.coalesce(F.nullif(F.get_json_object("props", "$.id"), F.lit("")), F.nullif(F.get_json_object("props", "$.page"), F.lit("")), F.sha2("props", 256))
    return table(spark, sf, "events").select("event_id", first.alias("document_id"), F.coalesce(F.get_json_object("props", "$.license"), F.lit("source default")).alias("license"))


@query("p13_document_sha256")
def p13(spark, sf):
    return docs(spark, sf).select("doc_id", F.sha2(arrow.nfkc_fold("text"), 256).alias("document_sha256"))


@query("p14_document_split", "SELECT doc_id, CASE WHEN b < 9600 THEN 'train' WHEN b < 9800 THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, CAST('0x' || left(sha256(text), 8) AS BIGINT) % 10000 AS b FROM documents)")
def p14(spark, sf):
    return docs(spark, sf).select("doc_id", T.document_split(F.sha2("text", 256)).alias("split"))


@query("p15_sizes", "SELECT doc_id, strlen(text) AS utf8_bytes, length(text) AS character_count FROM documents")
def p15(spark, sf):
    return docs(spark, sf).select("doc_id", F.octet_length("text").cast("long").alias("utf8_bytes"), F.length("text").cast("long").alias("character_count"))


@query("p16_trim_to_utf8_budget")
def p16(spark, sf):
    return docs(spark, sf).select("doc_id", T.trim_to_bytes("text", 101).alias("text"))


@query("p17_chunk_text")
def p17(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(arrow.chunker(1200, 80)("text")).alias("chunk", "text"))


@query("p18_skeleton", r"SELECT conv_id, turn, regexp_replace(regexp_replace(text, '[0-9]+|[零一二三四五六七八九十百千万两]+', '#', 'g'), '\s+', '', 'g') AS skeleton FROM conversations")
def p18(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", T.skeleton("text").alias("skeleton"))


_RAW = "CASE WHEN turn % 2 = 1 THEN '<think> ' || left(text, 20) || '</think>' || text || '<eos>' ELSE text END"


@query("p19_split_think", rf"SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN regexp_replace(left(text, 20), '^\s+|\s+$', '', 'g') ELSE '' END AS think, regexp_replace(text, '^\s+|\s+$', '', 'g') AS answer FROM conversations")
def p19(spark, sf):
    think, answer = T.split_think(F.expr(_RAW), "<eos>")
    return talks(spark, sf).select("conv_id", "turn", think.alias("think"), answer.alias("answer"))


@query("p20_strip_think_blocks", rf"SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace({_RAW}, '(?is)<\s*think\s*>.*?<\s*/\s*think\s*>', '', 'g'), '(?i)<\s*/?\s*think\s*>', '', 'g'), '^\s+|\s+$', '', 'g') AS text FROM conversations")
def p20(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", T.without_think(F.expr(_RAW)).alias("text"))


@query("p21_has_emoji", r"SELECT doc_id, regexp_matches(text, '[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1FAFF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{FE00}-\x{FE0F}]') AS emoji FROM documents")
def p21(spark, sf):
    return docs(spark, sf).select("doc_id", F.col("text").rlike(P.EMOJI).alias("emoji"))


@query("p22_canonical_url", "SELECT p_partkey, 'https://en.example.org/wiki/' || replace(p_name, ' ', '_') AS url FROM part")
def p22(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.canonical_url(F.lit("en.example.org"), "p_name").alias("url"))


@query("p23_choice_prompt", r"SELECT item_id, trim(text, E' \n\t') || chr(10) || 'A. ' || CAST(item_id AS VARCHAR) || chr(10) || 'C. no' AS prompt FROM benchmark")
def p23(spark, sf):
    choices = F.array(F.col("item_id").cast("string"), F.lit(" "), F.lit("no"))
    return table(spark, sf, "benchmark").select("item_id", T.choice_prompt("text", F.array(*map(F.lit, "ABC")), choices).alias("prompt"))


@query("p24_benchmark_prompt", r"SELECT item_id, benchmark, prompt FROM (SELECT item_id, CASE item_id % 2 WHEN 0 THEN 'qa' ELSE 'code' END AS benchmark, CASE item_id % 2 WHEN 0 THEN trim(text, E' \n\t') ELSE 'def f' || item_id || '():' || chr(10) || trim(text, E' \n\t') END AS prompt FROM benchmark) WHERE length(regexp_replace(prompt, '\s+', '', 'g')) >= 40")
def p24(spark, sf):
    rows = table(spark, sf, "benchmark").select("item_id", F.when(F.col("item_id") % 2 == 0, "qa").otherwise("code").alias("benchmark"), F.col("text").alias("question"), F.concat(F.lit("def f"), F.col("item_id").cast("string"), F.lit("():")).alias("signature"))
    forms = {"qa": T.strip("question"), "code": F.concat_ws("\n", "signature", T.strip("question"))}
    return T.prompts(rows, "benchmark", forms, 40).select("item_id", "benchmark", "prompt")


@query("p25_feature_text")
def p25(spark, sf):
    return docs(spark, sf).select("doc_id", arrow.nfkc_spaced("text").alias("text"))


@query(
    "p26_numeric_text_features",
    r"""SELECT doc_id, round(least(log2(n + 1) / 16, 1.0), 6) AS log_length, round(len(regexp_extract_all(text, '[\x{3400}-\x{9fff}]')) / n, 6) AS cjk_share, round(len(regexp_extract_all(text, '\p{Nd}')) / n, 6) AS digit_share,
    round(len(regexp_extract_all(text, '[A-Za-z]')) / n, 6) AS latin_share, round(least(len(regexp_extract_all(text, '(?i)https?://|www\.')) / 5.0, 1.0), 6)::DOUBLE AS url_share, round(len(regexp_extract_all(text, '[，。！？；：,.!?;:]')) / n, 6) AS punct_share
    FROM (SELECT doc_id, text, greatest(length(text), 1)::DOUBLE AS n FROM documents)""",
)
def p26(spark, sf):
    return docs(spark, sf).select("doc_id", *[F.round(c, 6).alias(n) for n, c in T.text_features("text").items()])


@query("p32_score_bucket", "SELECT l_orderkey, l_linenumber, CAST(least(floor(l_discount * 10 * 7), 9) AS INTEGER) AS bucket FROM lineitem")
def p32(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.least(F.floor(F.col("l_discount") * 10 * 7), F.lit(9)).cast("int").alias("bucket"))


@query("p33_normalized_compare_text", r"SELECT doc_id, lower(regexp_replace(text, '\s+', '', 'g')) AS key FROM documents")
def p33(spark, sf):
    return docs(spark, sf).select("doc_id", F.lower(T.squeeze("text")).alias("key"))


@query("p34_safe_float", "SELECT event_id, try_cast(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS x FROM events")
def p34(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf, "events").select("event_id", raw.try_cast("double").alias("x"))


# Rules: the reason of each document, alone and composed.


@query("f01_upstream_language_filter", "SELECT doc_id, lang FROM documents WHERE lower(lang) IN ('en', 'de')")
def f01(spark, sf):
    return docs(spark, sf).where(F.lower("lang").isin("en", "de")).select("doc_id", "lang")


@query("f02_min_chars_filter", "SELECT doc_id, length(text) < 200 AS too_short FROM documents")
def f02(spark, sf):
    return docs(spark, sf).select("doc_id", (F.length("text") < 200).alias("too_short"))


@query("f03_poison_repetition")
def f03(spark, sf):
    return docs(spark, sf).select("doc_id", Q.poison_repetition(F.col("text")).alias("poison"))


@query("f04_repeated_sentences")
def f04(spark, sf):
    return docs(spark, sf).select("doc_id", Q.repeated_sentences(F.col("text"), 16).alias("repeated"))


@query("f05_repeated_sentence_excess")
def f05(spark, sf):
    n = Q.repeated_chars(F.col("text"), 20, 2, beyond_first=True)
    return docs(spark, sf).select("doc_id", n.alias("chars"), F.round(n / F.greatest(F.length(T.squeeze("text")), F.lit(1)), 6).alias("fraction"))


@query(
    "f06_ocr_enumeration",
    r"""SELECT doc_id, len(ls) >= 6 AND len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[0-9]{1,4}\s*[、.)．]\s*'))) / greatest(len(ls), 1) >= 0.45 AS ocr
    FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\r\n|\r|\n'), lambda x: regexp_matches(x, '\S')) AS ls FROM documents)""",
)
def f06(spark, sf):
    return docs(spark, sf).select("doc_id", F.coalesce(Q.ocr_enumeration(F.col("text")), F.lit(False)).alias("ocr"))


@query(
    "f07_repeated_line_prefix",
    r"""WITH l AS (SELECT doc_id, left(lower(regexp_replace(s, '\s+', '', 'g')), 24) AS p FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS s FROM documents) WHERE length(regexp_replace(s, '^\s+|\s+$', '', 'g')) >= 32),
    c AS (SELECT doc_id, p, count(*) AS k FROM l GROUP BY doc_id, p), m AS (SELECT doc_id, sum(k) AS n, max(k) AS top FROM c GROUP BY doc_id)
    SELECT doc_id, coalesce(n >= 12 AND top / n >= 0.5, false) AS repeated FROM documents LEFT JOIN m USING (doc_id)""",
)
def f07(spark, sf):
    return docs(spark, sf).select("doc_id", F.coalesce(Q.repeated_line_prefix(F.col("text")), F.lit(False)).alias("repeated"))


@query("f08_url_density", r"SELECT doc_id, len(regexp_extract_all(text, '(?i)https?://|www\.')) >= greatest(4, length(text) // 1000) AS dense FROM documents")
def f08(spark, sf):
    return docs(spark, sf).select("doc_id", Q.url_density(F.col("text")).alias("dense"))


@query("f09_markup_density", r"SELECT page_id, len(regexp_extract_all(html, '</?[A-Za-z][^>]{0,200}>')) >= greatest(6, length(html) // 500) AS dense FROM pages")
def f09(spark, sf):
    return table(spark, sf, "pages").select("page_id", Q.markup_density(F.col("html")).alias("dense"))


@query(
    "f10_language_mismatch",
    r"""SELECT doc_id, (lang IN ('zh', 'en') AND letters < 32) OR (lang = 'en' AND latin / greatest(cjk + latin, 1) < 0.55) OR (lang = 'zh' AND cjk / greatest(cjk + latin, 1) < 0.2) AS mismatch FROM
    (SELECT doc_id, lang, len(regexp_extract_all(text, '\p{L}')) AS letters, len(regexp_extract_all(text, '[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}]'))::DOUBLE AS cjk, len(regexp_extract_all(text, '[A-Za-z]'))::DOUBLE AS latin FROM documents)""",
)
def f10(spark, sf):
    return docs(spark, sf).select("doc_id", Q.language_mismatch(F.col("text"), F.col("lang")).alias("mismatch"))


@query("f11_clean_document")
def f11(spark, sf):
    rows = docs(spark, sf).select("doc_id", "lang", arrow.cleaner(True, 16)("text").alias("done"))
    return rows.select("doc_id", Q.drop_reason(F.col("done"), F.col("lang")).alias("reason"), F.length("done.text").alias("n_chars"))


@query("f12_code_quality")
def f12(spark, sf):
    path = F.concat(F.lit("src/"), "source", F.when(F.col("doc_id") % 10 == 0, "/vendor/").otherwise("/"), F.lit("a.py"))
    return docs(spark, sf).select("doc_id", Q.code_reason(F.col("text"), path, 100).alias("reason"))


@query("f13_license_filter", "SELECT doc_id, lang IN ('en', 'fr') AS ok FROM documents")
def f13(spark, sf):
    return docs(spark, sf).select("doc_id", Q.license_ok(T.license_ids("lang"), ["en", "fr"]).alias("ok"))


@query("f14_mojibake", "SELECT doc_id, length(text) > 0 AND (length(text) - length(replace(text, chr(65533), ''))) > 0 AND (length(text) - length(replace(text, chr(65533), ''))) / length(text) >= 0.02 AS bad FROM documents")
def f14(spark, sf):
    return docs(spark, sf).select("doc_id", Q.mojibake(F.col("text")).alias("bad"))


@query("f15_generated_code_blob")
def f15(spark, sf):
    return docs(spark, sf).select("doc_id", Q.generated_blob(F.col("text")).alias("reason"))


@query("f16_hygiene_filter", r"SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)<\s*/?\s*(human|bot)\b') THEN 'human_bot_tags' WHEN regexp_matches(text, '(?i)\b(?:i\s*(?:am|''m)|as\s+an?)\s+(?:ai|artificial\s+intelligence|llm|(?:large\s+)?language\s+model)\b') THEN 'ai_mention' WHEN regexp_matches(text, '(?i)TODO|TBA|<\.\.\.>|<\s*\.\.\.\s*>|\[\.\.\.\]|\{\.{3}\}') THEN 'placeholder' ELSE '' END AS reason FROM documents")
def f16(spark, sf):
    return docs(spark, sf).select("doc_id", Q.hygiene(F.col("text")).alias("reason"))


@query("f17_mix_clean")
def f17(spark, sf):
    clean, why = Q.mix_clean(F.col("text"))
    return docs(spark, sf).select("doc_id", why.alias("reason"))


@query("f18_score_range", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE CASE WHEN l_linenumber = 3 THEN true ELSE l_discount >= 0.02 AND l_discount <= 0.07 END")
def f18(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("score", F.when(F.col("l_linenumber") != 3, F.col("l_discount")))
    return rows.where(Q.score_in_range(F.col("score"), 0.02, 0.07)).select("l_orderkey", "l_linenumber", "l_discount")


@query("f19_template_page_reason", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'finemath_academic_mill' WHEN doc_id % 5 = 1 THEN 'finemath_subscription_preview' WHEN doc_id % 5 = 2 THEN 'finemath_date_calculator' ELSE '' END AS reason FROM documents")
def f19(spark, sf):
    added = F.expr("concat(text, element_at(array('\nessay writing service', '\nUnlock the solution to this question', '\nWhat is the date 90 days from today\nAdding 90 days from Monday the first is some other day', '', ''), cast(doc_id % 5 as int) + 1))")
    return docs(spark, sf).select("doc_id", Q.template_page(added).alias("reason"))


@query("f20_topic_precision_gate", r"SELECT doc_id, regexp_matches(left(text, 240), '(?i)(the|der|que) ') AND len(regexp_extract_all(text, '(?i)(and|und|los) ')) >= 2 AS ok FROM documents")
def f20(spark, sf):
    return docs(spark, sf).select("doc_id", Q.topic_gate(F.col("text"), "(?i)(the|der|que) ", "(?i)(and|und|los) ").alias("ok"))


@query("f21_taxonomy_label")
def f21(spark, sf):
    return docs(spark, sf).select("doc_id", Q.taxonomy(F.col("text")).alias("label"))


@query("f22_structural_helpers")
def f22(spark, sf):
    return docs(spark, sf).select("doc_id", *[rule(F.col("text")).alias(name) for name, rule in Q.STRUCTURES.items()])


@query("f23_triage_reasons")
def f23(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(Q.triage(F.col("text"), F.split("text", r"\s+")), ",").alias("reasons"))


@query(
    "f24_dup_ngram_ratio",
    "SELECT doc_id, round(CASE WHEN len(t) < 8 THEN 0.0 ELSE 1 - len(list_distinct(list_transform(range(1, len(t) - 2), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3]))) / (len(t) - 3) END, 6) AS dup FROM (SELECT doc_id, string_split(text, ' ') AS t FROM documents)",
)
def f24(spark, sf):
    return docs(spark, sf).select("doc_id", F.round(arrow.duplicate_ngrams(F.split("text", " ")), 6).alias("dup"))


@query(
    "f25_repeated_ngram_ratio",
    r"""SELECT conv_id, turn, CASE WHEN len(t) < 4 THEN 0.0::DOUBLE ELSE round(1 - len(list_distinct(list_transform(range(1, len(t) - 2), lambda i: t[i:i + 3]))) / (len(t) - 3), 6) END AS rep FROM
    (SELECT conv_id, turn, regexp_extract_all(text, '[\p{L}\p{N}_\p{M}]+|[^\p{L}\p{N}_\p{M}\s]') AS t FROM conversations)""",
)
def f25(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", F.round(T.repeated_ngram_ratio("text"), 6).alias("rep"))


@query(
    "f26_distinct_ngram_ratio",
    r"""SELECT conv_id, turn, CASE WHEN length(t) <= 4 THEN 1.0::DOUBLE ELSE round(len(list_distinct(list_transform(range(1, length(t) - 2), lambda i: substr(t, i, 4)))) / (length(t) - 3), 6) END AS distinct4 FROM
    (SELECT conv_id, turn, regexp_replace(text, '\s+', '', 'g') AS t FROM conversations)""",
)
def f26(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", F.round(T.distinct_ngram_ratio("text"), 6).alias("distinct4"))


@query("f27_loop_coverage")
def f27(spark, sf):
    return talks(spark, sf).select("conv_id", "turn", F.round(arrow.loop_coverage("text"), 6).alias("loop"))


@query(
    "f28_responsiveness",
    r"""SELECT conv_id, turn, round(1 - (CASE WHEN turn % 2 = 1 AND NOT regexp_matches(text, '[0-9]|[一二三四五六七八九十百千万零两]') THEN 1 ELSE 0 END + CASE WHEN turn > 0 AND before <> '' AND contains(own, before) THEN 1 ELSE 0 END
    + CASE WHEN length(own) < 60 THEN 1 ELSE 0 END) / (CASE WHEN turn % 2 = 1 THEN 1 ELSE 0 END + CASE WHEN turn > 0 AND before <> '' THEN 1 ELSE 0 END + 1)::DOUBLE, 6) AS score FROM
    (SELECT conv_id, turn, text, regexp_replace(text, '\s+', '', 'g') AS own, coalesce(regexp_replace(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '\s+', '', 'g'), '') AS before FROM conversations)""",
)
def f28(spark, sf):
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    score, _ = Q.responsiveness(F.col("text"), numeral=F.col("turn") % 2 == 1, differs_from=F.col("before"), min_chars=F.lit(60))
    return talks(spark, sf).withColumn("before", before).select("conv_id", "turn", F.round(score, 6).alias("score"))


@query(
    "f30_forbidden_roots",
    "SELECT page_id, CASE WHEN starts_with(regexp_replace(url, '^[a-z]+://', ''), 'www.') THEN 'root' WHEN lower(split_part(split_part(url, '://', 2), '/', 1)) IN (SELECT lower(split_part(split_part(url, '://', 2), '/', 1)) FROM pages WHERE page_id % 97 = 0) THEN 'upstream' ELSE '' END AS forbidden FROM pages",
)
def f30(spark, sf):
    pages = table(spark, sf, "pages").withColumn("rest", F.regexp_replace("url", "^[a-z]+://", "")).withColumn("repo", F.split("rest", "/")[0])
    denied = pages.where("page_id % 97 = 0").select("repo")
    return Q.forbidden(pages, "rest", ["www."], "repo", denied).select("page_id", "forbidden")


@query("f31_response_language_match", "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL WHEN trim(text, E' \\n\\t') = '' THEN false WHEN turn % 3 = 1 THEN true ELSE NOT regexp_matches(text, '[A-Za-z]') END AS matches FROM conversations")
def f31(spark, sf):
    mode = F.when(F.col("turn") % 3 == 0, "exempt").otherwise("auto")
    language = F.when(F.col("turn") % 3 == 1, "en").otherwise("zh")
    return talks(spark, sf).select("conv_id", "turn", Q.language_of_response(F.col("text"), language, F.array().cast("array<string>"), mode).alias("matches"))


@query("f32_answer_match", r"SELECT conv_id, turn, starts_with(lower(regexp_replace(text, '\s+', '', 'g')), 'the') OR starts_with(lower(regexp_replace(text, '\s+', '', 'g')), 'in') AS prefix, contains(lower(regexp_replace(text, '\s+', '', 'g')), 'tion') AS holds FROM conversations")
def f32(spark, sf):
    a = F.array(F.lit("The"), F.lit("in "))
    return talks(spark, sf).select("conv_id", "turn", Q.answers(F.col("text"), a, F.lit("prefix")).alias("prefix"), Q.answers(F.col("text"), F.array(F.lit("tion")), F.lit("contains")).alias("holds"))
