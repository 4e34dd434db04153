"""Rules and functions on hand-written rows."""

import base64
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkmill.functions import arrow, kernels
from sparkmill.functions import text as T
from sparkmill.functions import topics as K
from sparkmill.operators import filters as Q


def one(spark, expr, **row):
    df = spark.createDataFrame([tuple(row.values())], list(row)) if row else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_normal_forms(spark):
    assert one(spark, T.strip(arrow.nfc(T.control_free("t"))), t="﻿a\r\nb\x00​é�\t ") == "a\nbé"
    assert one(spark, arrow.nfkc_fold("t"), t=" Ｆｕｌｌ ﬁ Straße\n") == "fullfistrasse"
    assert one(spark, T.skeleton("t"), t="儿子 今年 10 岁") == one(spark, T.skeleton("t"), t="儿子今年十七岁") == "儿子今年#岁"


def test_footer_and_years(spark):
    assert one(spark, arrow.drop_footer("t"), t="body\nmore\n\nAll rights reserved\nPrivacy Policy\n \n") == "body\nmore"
    assert one(spark, arrow.drop_footer("t"), t="\n".join(["body"] + ["版权所有"] * 10)) == "body\n版权所有\n版权所有"
    for value, year in (("2024-05-01", "2024"), ("1999T", "1999"), ("20245", "unknown"), ("x", "unknown"), ("2100", "2100")):
        assert one(spark, T.document_year("t"), t=value) == year


def test_byte_budget_never_cuts_a_character(spark):
    s = "aé漢🙂b " * 5
    for n in range(1, 40):
        want = s.encode()[:n].decode("utf-8", "ignore").strip()
        assert one(spark, T.trim_to_bytes("t", n), t=s) == want, n


def test_repetition(spark):
    assert one(spark, Q.poison_repetition(F.col("t")), t="*_" * 600) is True
    assert one(spark, Q.poison_repetition(F.col("t")), t="*_" * 100) is False
    line = "The very same sentence stands here again and again without end. "
    assert one(spark, Q.repeated_sentences(F.col("t"), 16), t=line * 6) is True
    assert one(spark, Q.repeated_sentences(F.col("t"), 16), t=line * 2) is False
    assert one(spark, Q.repeated_chars(F.col("t"), 20, 2, beyond_first=True), t=line * 3) == 2 * (len(line) - 2)
    assert one(spark, arrow.loop_coverage("t"), t="ab" * 20) == 1.0 and one(spark, arrow.loop_coverage("t"), t="abcdefgh") == 0.0
    assert one(spark, T.distinct_ngram_ratio("t"), t="abababab") == 2 / 5


def test_code_rules_in_order(spark):
    body = "def add(a, b):\n    return a + b  # adds two numbers and gives the sum back\n" * 5
    reason = lambda t, p="src/a.py": one(spark, Q.code_reason(F.col("t"), F.lit(p), 50), t=t)
    assert reason(body) == ""
    assert reason(body, "x\\node_modules\\a.js") == "code_vendor"
    assert reason("# auto-generated, do not edit\n" + body) == "code_generated"
    assert reason(body + "AKIA" + "Z" * 16) == "code_secret"
    assert reason(body + base64.b64encode(random.Random(1).randbytes(1500)).decode()) == "code_embedded_blob"
    assert reason("x" * 20) == "too_short"


def test_language_and_templates(spark):
    assert one(spark, Q.language_mismatch(F.col("t"), F.lit("zh")), t="plain English text of more than thirty-two letters") is True
    assert one(spark, Q.language_mismatch(F.col("t"), F.lit("en")), t="plain English text of more than thirty-two letters") is False
    assert one(spark, Q.template_page(F.col("t")), t="Buy an essay from our essay writing service") == "finemath_academic_mill"
    assert one(spark, Q.template_page(F.col("t")), t="question\n" + "answer:\nquestion\n" * 4) in ("finemath_broken_qa", "")


def test_chunks(spark):
    text = "\n\n".join(["One sentence here. Another one follows! " * 4] * 6)
    chunks = one(spark, arrow.chunker(200, 20)("t"), t=text)
    assert chunks and all(20 <= len(c) <= 200 for c in chunks)
    cut = one(spark, arrow.content_chunks("t"), t="x1y2z3w4" * 100)
    assert "".join(cut) == "x1y2z3w4" * 100 and all(32 <= len(c) <= 128 for c in cut[:-1])


def test_structures_and_topics(spark):
    config = "\n".join(f"key{k}: value {k}" for k in range(9))
    assert one(spark, Q.config_file(F.col("t")), t=config) is True and one(spark, Q.config_file(F.col("t")), t="plain words") is False
    assert one(spark, Q.config_file(F.col("t")), t="[a]\nx = 1\ny = 2\nz = 3\n[b]\nu = 1\nv = 2\nw = 3") is True
    assert one(spark, Q.parallel_text(F.col("t")), t="translation\n中文: 你好") is True and one(spark, Q.parallel_text(F.col("t")), t="a translation of it") is False
    assert one(spark, Q.classical_literature(F.col("t")), t="吾乃言之矣" * 70) is True and one(spark, Q.classical_literature(F.col("t")), t="吾乃说道矣" * 70) is False
    assert one(spark, Q.web_novel(F.col("t")), t="第三章 " + "他说道。" * 250) is True and one(spark, Q.web_novel(F.col("t")), t="Chapter 3 he said " * 60) is False
    assert one(spark, Q.narrative_book(F.col("t")), t="Chapter 3. He said so, she replied. " + "And on it went. " * 90) is True
    assert one(spark, Q.narrative_book(F.col("t")), t="And on it went. " * 90) is False
    assert one(spark, Q.forum_talk(F.col("t")), t="> hi\nyes") is True and one(spark, Q.forum_talk(F.col("t")), t="plain words") is False
    rows = {
        "def f(x): return x": "code_application", "pip install it, then def f(x)": "code_scripting", "python 算法 of it": "code_algorithm", config: "code_config", " ": "other", "All Rights Reserved": "boiler",
        "the doctor and the dose": "medical_guideline", "请问是什么": "medical_qa", "the court and the law of it": "legal_statute", "one court": "other", "GDP went up": "finance_macro", "股票": "finance_market", "贷款": "finance_banking",
        "国考": "gov_exam", "国务院": "gov_policy", "quantum things": "stem_physics_math", "an ISO": "stem_engineering", "posts on reddit": "tech_blog_forum", "psychology": "social_psychology", "ethics": "humanities_philosophy", "皇帝": "humanities_history",
        "see Wikipedia": "encyclopedia_core", "Q: so\n" + "word " * 300: "encyclopedia_qa", "Abstract. We": "academic_paper", "例题": "academic_textbook", "数据来源": "professional_report", "a proof by the matrix": "math_derivation", "sin of it": "math_calculation",
        "记者": "news_mainstream", "记者观点": "news_commentary", "an editorial": "article_editorial", "a blog": "article_blog", "plain words": "other", "grammar in translation": "linguistics_grammar", "porn": "nsfw",
    }
    got = spark.createDataFrame([(t,) for t in rows], "t string").select("t", Q.taxonomy(F.col("t")).alias("label")).collect()
    assert {r.t: r.label for r in got} == rows and set(rows.values()) <= set(K.LABELS) and len(K.LABELS) == 40


def test_triage_and_prompts(spark):
    flags = lambda t: one(spark, Q.triage(F.col("t"), F.split("t", " ")), t=t)
    assert flags("see http://x.y or a@b.cd <div> &amp;\ndef f\n联系我们 下一页 版权所有 下载 APP " + "\ufffd" * 6)[:9] == ["url", "email", "html", "code", "contact", "nav", "footer", "download", "mojibake"]
    assert flags("a b " * 200) == ["repetitive", "low_token_diversity", "ngram_dup_high"] and flags("。，" * 3) == ["punct_high"] and flags("1234567") == ["digit_high"]
    for t, hard in (("为什么天空在傍晚的时候会变成红色而不是蓝色呢", True), ("谢谢，为什么天空在傍晚的时候会变成红色", False), ("why is the sky red in the evening?", False), ("为什么呢", False)):
        assert one(spark, Q.hard_prompt(F.col("t")), t=t) is hard
    score = lambda t, **k: tuple(spark.createDataFrame([(t,)], ["t"]).select(*Q.responsiveness(F.col("t"), **k)).first())
    assert score("abc") == (1.0, [])
    assert score("a b c 5", numeral=F.lit(True), differs_from=F.lit("b c"), min_chars=F.lit(9), code_block=F.lit(False)) == (pytest.approx(1 / 3), ["differs_from", "min_chars"])


def test_generated_blobs(spark):
    reason = lambda t: one(spark, Q.generated_blob(F.col("t")), t=t)
    body = "let x = 1;\n" * 3000
    for mark, want in (("base64.b64decode('" + "A" * 9000 + "')", "code_embedded_base64_blob"), ("//# sourceMappingURL=data:x", "code_embedded_sourcemap_blob"), ("data:font/x;base64," + "A" * 21_000, "code_embedded_base64_asset_blob"), ("__webpack_require__" + "x" * 51_000, "code_minified_js_bundle"), ("_scriptDir wasm " + "x" * 51_000, "code_emscripten_wasm_bundle"), ("tagInfoJSON" + "x" * 51_000, "code_huge_data_literal"), ("ModelData[] = " + "0x1,\n" * 30_000, "code_numeric_data_blob"), ("", "")):
        assert reason(body + mark) == want
    assert reason("File generated automatically by the QuickJS compiler") == "code_generated_quickjs_blob"


def test_numbers_in_prose(spark):
    for text, reference, want in (("it took 19.41 days", "19.4118", True), ("19.5 days", "19.4118", False), ("about 3/4 of it", "0.75", True), ("四分之三", "0.75", True), ("六十一点五四", "61.54", True), ("一千二百三十四", "1234", True), ("十五", "15", True), ("三万零五", "30005", True), ("1,234 of them", "1234", True), ("none", "1", False), ("3/0", "3", True), ("2/0", "5", False)):
        assert one(spark, arrow.agrees("t", "r"), t=text, r=reference) is want, text


def test_kernels_against_plain_versions():
    r = random.Random(4)
    for _ in range(60):
        s = "".join(r.choice("abcé漢🙂 \n") for _ in range(r.randint(0, 80)))
        got = kernels.runs(s, 5, None)
        want = dict.fromkeys(s[i : i + 5] for i in range(len(s) - 4))
        assert [s[x["at"] - 1 : x["at"] + 4] for x in got] == list(want) and len({x["h"] for x in got}) == len(got)
        wanted = np.sort(np.array([x["h"] for x in got[::2]], dtype=np.int64))
        assert kernels.runs(s, 5, wanted) == got[::2]
        assert [x.tolist() for x in kernels.gram_counts(s, 3, 16)] == [x.tolist() for x in kernels.gram_counts(s, 3, 16, block=7)]
    n = Counter(s[i : i + k] for s in ["abcabcab"] for k in (1, 2, 3) for i in range(len(s) - k + 1))
    assert sorted(kernels.gram_counts("abcabcab", 3, 16)[1].tolist()) == sorted(n.values())
    assert kernels.clean("a\r\nb\x00\u200b\ufffd c\u0301\n\nCopyright\nPrivacy Policy ", True) == "a\nb ć\n\nCopyright"


def test_forbidden_rows_stop_if_asked(spark):
    rows = spark.createDataFrame([("/bad/x", "a/b"), ("/ok", "Org/Repo"), ("/ok", "c/d"), (None, None)], "path string, repo string")
    denied = spark.createDataFrame([("org/repo",), ("org/REPO",)], "repo string")
    assert sorted(r.forbidden for r in Q.forbidden(rows, "path", ["/bad"], "repo", denied).collect()) == ["", "", "root", "upstream"]
    with pytest.raises(Exception, match="upstream: /ok"):
        Q.forbidden(rows.where("path = '/ok'"), "path", ["/bad"], "repo", denied, stop=True).collect()


def test_alternatives_by_script():
    assert Q.by_script(r"(?i)银行(?:业)?|PE\b|法?x|\b(?:law|法)\b|[、.]\s|第[一二|]{1,6}条|a\|贷|x贷{0,3}") == (r"(?i)银行(?:业)?|第[一二|]{1,6}条|a\|贷", r"(?i)PE\b|法?x|\b(?:law|法)\b|[、.]\s|x贷{0,3}")
    assert Q.by_script("利率|收益率") == ("利率|收益率", None) and Q.by_script("a|b") == (None, "a|b")
    every = [p for n, p in vars(K).items() if n.isupper() and isinstance(p, str)]
    for p in every:  # each alternative of an East Asian half matches nothing in Latin text, and the halves have all of them
        own, rest = Q.by_script(p)
        flags = re.match(r"(?:\(\?[a-z]+\))?", p)[0]
        assert sum(len(h) - len(flags) for h in (own, rest) if h) + (1 if own and rest else 0) == len(p) - len(flags)
        assert not own or not re.search(own, "".join(map(chr, range(0x2E80))))


def test_taxonomy_strips_a_text_once(spark):
    df = spark.createDataFrame([("A text",), (None,)], "t string").select(Q.taxonomy(F.col("t")).alias("label"))
    assert df._jdf.queryExecution().analyzed().toString().count(r"(?U)^\s+|\s+$") == 1 + 1  # the text, and forum_talk's lines
    assert [r.label for r in df.collect()] == ["other", "other"]
