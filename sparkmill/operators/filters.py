"""Quality rules as columns: each gives a boolean or the reason for which a text is dropped; the first reason counts."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow, text as T
from ..functions import patterns as P
from ..functions import topics as K
from . import joins


def reason(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule that hits; an empty string if none does."""
    return F.coalesce(*[F.when(hit, F.lit(name)) for hit, name in rules], F.lit(""))


def poison_repetition(x: Column) -> Column:
    """Long, compressible and with few distinct character pairs; short texts never reach the Arrow function's work."""
    return arrow.poison(x)


def repeated_chars(x: Column, least: int, repeats: int, beyond_first: bool = False) -> Column:
    """Characters in sentences of `least` characters and more that occur `repeats` times and more."""
    return arrow.repeated_chars(least, repeats, beyond_first)(x)


def repeated_sentences(x: Column, least: int = 12, repeats: int = 3, chars: int = 240, share: float = 0.08) -> Column:
    return arrow.repeated(least, repeats, chars, share)(x)


def ocr_enumeration(x: Column) -> Column:
    own = F.filter(T.lines(x), lambda s: T.strip(s) != "")
    return (F.size(own) >= 6) & (F.size(F.filter(own, lambda s: s.rlike(P.OCR_LINE))) / F.size(own) >= 0.45)


def repeated_line_prefix(x: Column) -> Column:
    own = F.transform(F.filter(T.lines(x), lambda s: F.length(T.strip(s)) >= 32), lambda s: F.substring(F.lower(T.squeeze(s)), 1, 24))
    most = T.fold_counts(own, lambda t, s, k: F.greatest(t, k))
    return (F.size(own) >= 12) & (most / F.size(own) >= 0.5)


def url_density(x: Column) -> Column:
    return T.hits(x, P.URL) >= F.greatest(F.lit(4), F.floor(F.length(x) / 1000))


def markup_density(x: Column) -> Column:
    return T.hits(x, P.TAG) >= F.greatest(F.lit(6), F.floor(F.length(x) / 500))


def language_mismatch(x: Column, language: Column, least: float | None = None) -> Column:
    cjk, latin = T.script_ratios(x)
    few = language.isin("zh", "en") & (T.count_of(x, r"\p{L}") < 32)
    zh = (language == "zh") & (cjk < (0.20 if least is None else least))
    en = (language == "en") & (latin < (0.55 if least is None else least))
    return few | zh | en


def clean_document(x: Column, language: Column, min_chars: int = 200, ocr: bool = True) -> tuple[Column, Column]:
    """The cleaned text and the reason why it is dropped ('' for none), from one pass in Python."""
    done = arrow.cleaner(True, 16)(x)
    return done["text"], drop_reason(done, language, min_chars, ocr)


def drop_reason(done: Column, language: Column, min_chars: int = 200, ocr: bool = True) -> Column:
    """The reason for a struct of the cleaned text, poison and repeated (see arrow.cleaner)."""
    clean = done["text"]
    return F.when(F.length(clean) < min_chars, F.lit("too_short")).otherwise(
        reason(
            (done["poison"], "poison_repetition"),
            (done["repeated"], "repeated_sentences"),
            (ocr_enumeration(clean) & F.lit(ocr), "ocr_enumeration"),
            (repeated_line_prefix(clean), "repeated_line_prefix"),
            (url_density(clean), "url_density"),
            (markup_density(clean), "markup_density"),
            (language_mismatch(clean, F.lower(language)), "language_mismatch"),
        )
    )


def longest_line(x: Column) -> Column:
    return F.array_max(F.transform(T.lines(x), F.length))


def code_reason(clean: Column, path: Column, min_chars: int = 200) -> Column:
    head = F.substring(clean, 1, 4096)
    secret = F.lit(False)
    for p in P.SECRETS:
        secret = secret | clean.rlike(p)
    longest = longest_line(clean)
    return reason(
        (F.length(clean) < min_chars, "too_short"),
        (poison_repetition(clean), "poison_repetition"),
        (F.replace(path, F.lit("\\"), F.lit("/")).rlike(P.VENDOR_PATH), "code_vendor"),
        (head.rlike(P.GENERATED), "code_generated"),
        (head.rlike(P.PROPRIETARY), "code_proprietary"),
        (secret, "code_secret"),
        (clean.rlike(P.BASE64_BLOB), "code_embedded_blob"),
        (T.count_of(clean, r"[\p{L}\p{N}]") < 32, "code_without_content"),
        ((longest > 50_000) | ((longest > 5_000) & (longest >= F.floor(F.length(clean) * 0.9))), "minified_or_binary_line"),
    )


def license_ok(ids: Column, allowed: list[str], missing_ok: bool = False) -> Column:
    return F.when(F.size(ids) == 0, F.lit(missing_ok)).otherwise(F.size(F.array_except(ids, F.array(*map(F.lit, allowed)))) == 0)


def mojibake(x: Column, share: float = 0.02) -> Column:
    return (F.length(x) > 0) & (T.hits(x, "�") > 0) & (T.hits(x, "�") / F.greatest(F.length(x), F.lit(1)) >= share)


def generated_blob(x: Column, least: int = 20_000) -> Column:
    """The kind of generated data a code file mostly is; '' for none. `least`: characters below which only a marker counts."""
    head, n, longest = F.left(x, F.lit(200_000)), F.length(x), longest_line(x)
    has = lambda *w: F.greatest(*[head.contains(s) for s in w]) if len(w) > 1 else head.contains(w[0])
    big = n >= least
    long = big & (longest >= 50_000)
    starts = F.ltrim(head).startswith(P.BLOB_BUNDLE_START[0]) | F.ltrim(head).startswith(P.BLOB_BUNDLE_START[1])
    many = (T.hits(x, "0x") > 1000) | (T.hits(x, ",") > 5000)
    return reason(
        (x.contains(*P.BLOB_QUICKJS), "code_generated_quickjs_blob"),
        (big & has(*P.BLOB_BASE64) & ((longest >= 8000) | (n >= 100_000)), "code_embedded_base64_blob"),
        (big & has(*P.BLOB_SOURCEMAP), "code_embedded_sourcemap_blob"),
        (big & has(*P.BLOB_FONT) & has("base64,") & (longest >= 20_000), "code_embedded_base64_asset_blob"),
        (long & (has(*P.BLOB_BUNDLE) | starts), "code_minified_js_bundle"),
        (long & has(P.BLOB_WASM[0]) & has(*P.BLOB_WASM[1:]), "code_emscripten_wasm_bundle"),
        (long & has(*P.BLOB_LITERAL), "code_huge_data_literal"),
        ((n >= 100_000) & has(*P.BLOB_NUMBERS) & many, "code_numeric_data_blob"),
    )


def hygiene(x: Column, code: bool = False) -> Column:
    rules = [(x.rlike(P.HUMAN_BOT), "human_bot_tags"), (x.rlike(P.AI_MENTION), "ai_mention")]
    return reason(*rules, *([] if code else [(x.rlike(P.PLACEHOLDER), "placeholder")]))


def mix_clean(x: Column, min_chars: int = 200, code: bool = False) -> tuple[Column, Column]:
    """Text and drop reason of the mixture path: damage is judged on the raw text, the rest on the normalised one."""
    done = arrow.cleaner(False, 12)(x)
    clean = done["text"]
    own = hygiene(clean, code)
    rest = [(done["poison"], "poison_repetitive")] + ([] if code else [(done["repeated"], "repeated_sentences")])
    why = F.coalesce(
        F.when(mojibake(x), F.lit("mojibake")),
        *([F.nullif(generated_blob(x), F.lit(""))] if code else []),
        F.when(clean == "", F.lit("empty")),
        F.when(F.length(clean) < min_chars, F.lit("too_short")),
        F.nullif(own, F.lit("")),
        reason(*rest),
    )
    return clean, why


def score_in_range(score: Column, low: float | None = None, high: float | None = None) -> Column:
    """Null scores pass."""
    ok = F.lit(True)
    if low is not None:
        ok = ok & (score >= low)
    if high is not None:
        ok = ok & (score <= high)
    return F.coalesce(ok, F.lit(True))


def forbidden(rows: DataFrame, path: str, roots: list[str], repo: str, denied: DataFrame, stop: bool = False) -> DataFrame:
    """With `forbidden`: root (a path under a forbidden root), upstream (a repository of the deny list, in any case of
    letters) or ''. stop: such a row is an error."""
    under = F.lit(False)
    for r in roots:
        under = under | F.col(path).startswith(r)
    listed = joins.small(denied.select(F.lower(denied.columns[0]).alias("__denied")).distinct())
    j = rows.join(listed, F.lower(repo) == F.col("__denied"), "left")
    why = F.when(under, "root").when(F.col("__denied").isNotNull(), "upstream").otherwise("")
    out = j.withColumn("forbidden", why).drop("__denied")
    return out.withColumn("forbidden", F.when(F.col("forbidden") == "", "").otherwise(F.raise_error(F.concat_ws(": ", F.col("forbidden"), path)))) if stop else out


def template_page(x: Column) -> Column:
    low = F.lower(x)
    has = lambda *w: F.greatest(*[low.contains(s) for s in w])
    mill = has("service", "academic writers", "write my", "do my", "buy essay", "buy paper") & has("assignment", "homework", "essay", "paper", "academic")
    number = low.contains(" in braille:") & low.contains("qr code bar code") & low.contains("mathematics of no.") & low.contains("images of the number")
    return reason(
        (mill & x.rlike(P.ESSAY_MILL), "finemath_academic_mill"),
        (low.contains("days") & low.contains("what") & x.rlike(P.DATE_TITLE) & (x.rlike(P.DATE_BODY) | x.rlike(P.DATE_HAND)), "finemath_date_calculator"),
        (number, "finemath_number_properties"),
        (has("subscribe", "unlock") & x.rlike(P.PAYWALL), "finemath_subscription_preview"),
        (low.contains("question") & (T.hits(low, "answer:") >= 4) & (T.hits(x, P.EMPTY_ANSWER) >= 4), "finemath_broken_qa"),
    )


def topic_gate(x: Column, strong: str, anchor: str, head: int = 240, least: int = 2) -> Column:
    """A strong anchor near the beginning and so many anchors in all."""
    return F.left(x, F.lit(head)).rlike(strong) & (T.hits(x, anchor) >= least)


def label_by_rules(x: Column, rules: list[tuple[str, str]], other: str = "other") -> Column:
    """The label of the first pattern that is found, in order; rules are (label, pattern)."""
    out = F.lit(other)
    for label, pattern in reversed(rules):
        out = F.when(x.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def config_file(x: Column, t: Column | None = None) -> Column:
    """Container or XML files, JSON of some size, many YAML lines, INI sections, or dense markup."""
    t = T.strip(x) if t is None else t
    head = F.left(t, F.lit(20_000))
    json = F.left(t, F.lit(1)).isin("{", "[") & t.rlike(P.JSON_KEY) & (T.count_of(t, r"[{}\[\]]") >= 10)
    ini = (T.hits(head, P.INI_SECTION) >= 2) & (T.hits(head, P.INI_LINE) >= 6)
    return t.rlike(P.DOCKERFILE) | t.rlike(P.XML_DECLARATION) | json | (T.hits(head, P.YAML_LINE) >= 8) | ini | (T.hits(head, P.HTML_TAG) >= 18)


def parallel_text(x: Column, t: Column | None = None) -> Column:
    """Of translation, and marked as two languages side by side, or with tabs, or in both scripts."""
    t = T.strip(x) if t is None else t
    mixed = (F.length(t) >= 200) & (t.contains("\t") | (t.rlike(P.HAN) & t.rlike(P.LATIN)))
    return t.rlike(P.TRANSLATION) & (t.rlike(P.PARALLEL) | mixed)


def classical_literature(x: Column, t: Column | None = None) -> Column:
    t = T.strip(x) if t is None else t
    return (F.length(t) >= 300) & (T.hits(F.left(t, F.lit(4000)), P.CLASSICAL) >= 12) & ~F.left(t, F.lit(2000)).rlike(P.DIALOGUE)


def web_novel(x: Column, t: Column | None = None) -> Column:
    t = T.strip(x) if t is None else t
    return (F.length(t) >= 800) & (t.rlike(P.WEB_NOVEL) | (t.rlike(P.CHAPTER_ZH) & (T.hits(F.left(t, F.lit(6000)), P.DIALOGUE) >= 3)))


def narrative_book(x: Column, t: Column | None = None) -> Column:
    """Long, and with dialogue, of which chapter headings make less do."""
    t = T.strip(x) if t is None else t
    head = F.left(t, F.lit(8000))
    spoken = T.hits(head, P.DIALOGUE) + F.floor(T.count_of(head, '"') / 2)
    return (F.length(t) >= 1200) & ((spoken >= 8) | ((spoken >= 2) & (t.rlike(P.CHAPTER_ZH) | t.rlike(P.CHAPTER_EN))))


def forum_talk(x: Column, t: Column | None = None) -> Column:
    """Signs of a thread in a short text or in one of mostly short lines."""
    t = T.strip(x) if t is None else t
    own = F.filter(F.transform(T.lines(t), T.strip), lambda s: s != "")
    brief = T.let(own, lambda a: F.size(a).between(6, 80) & (F.size(F.filter(a, lambda s: F.length(s) <= 30)) / F.greatest(F.size(a), F.lit(1)) >= 0.55))
    return t.rlike(P.FORUM) & ((F.length(t) <= 1200) | brief)


STRUCTURES = {"config_file": config_file, "parallel_text": parallel_text, "classical_literature": classical_literature, "web_novel": web_novel, "narrative_book": narrative_book, "forum_talk": forum_talk}


def first_of(rules: list[tuple[Column, str | Column]], other: Column) -> Column:
    """The value of the first rule that hits; later rules are not looked at."""
    out = other
    for hit, value in reversed(rules):
        out = F.when(hit, F.lit(value) if isinstance(value, str) else value).otherwise(out)
    return out


#: What every alternative with a letter, mark or bracket of an East Asian script needs.
EAST_ASIAN = r"[\x{2e80}-\x{ffff}]"


@functools.cache
def by_script(pattern: str) -> tuple[str | None, str | None]:
    """A pattern as two: the alternatives that only match where an East Asian character stands, and the others. Alternatives
    that hold such a character outside of classes, groups and counted parts are the former."""
    flags = re.match(r"(?:\(\?[a-z]+\))?", pattern)[0]
    parts, depth, at, k = [""], 0, 0, len(flags)
    while k < len(pattern):
        c = pattern[k]
        step = 2 if c == "\\" else 1
        if c == "[":  # a class, without classes within
            step = re.compile(r"\[\^?\]?(?:\\.|[^\]\\])*\]").match(pattern, k).end() - k
        depth += (c == "(") - (c == ")")
        if c == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += pattern[k : k + step]
        k += step
    east, rest = [], []
    for part in parts:
        bare = re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "", part)
        while (inner := re.sub(r"\([^()]*\)", "", bare)) != bare:
            bare = inner
        sure = re.sub(r".[?*{]", "", bare)
        (east if re.search("[\u2e80-\uffff]", sure) else rest).append(part)
    whole = lambda own: flags + "|".join(own) if own else None
    return whole(east), whole(rest)


def taxonomy(x: Column) -> Column:
    """One of the forty topic labels: restricted texts and boilerplate, then structure and fields from the most telling to
    the least, talk at last. A field with finer labels decides among them before the next field is tried. Whether a text has an
    East Asian character is asked once; others are not searched for what can't match without one."""
    return T.let(F.struct(x.alias("x"), T.strip(x).alias("t"), x.rlike(EAST_ASIAN).alias("east")), lambda own: _label(own["x"], own["t"], own["east"]))


def _label(x: Column, t: Column, east: Column) -> Column:
    """The label of a text x, with t, the same without white space at its ends."""

    def has(pattern: str) -> Column:
        own, rest = by_script(pattern)
        both = ([east & x.rlike(own)] if own else []) + ([x.rlike(rest)] if rest else [])
        return both[0] if len(both) == 1 else both[0] | both[1]

    within = lambda *rules, other: first_of(list(rules), F.lit(other))
    asked, head = has(K.QA_MARK), F.left(x, F.lit(20_000))
    n_legal = F.when(east, T.hits(head, K.LEGAL)).otherwise(T.hits(head, by_script(K.LEGAL)[1]))
    fields: list[tuple[Column, str | Column]] = [
        (t == "", "other"),
        (has(K.NSFW), "nsfw"),
        (has(K.BOILER), "boiler"),
        (config_file(x, t), "code_config"),
        (has(K.CODE), within((has(K.CODE_SCRIPT), "code_scripting"), (has(K.CODE_ALGORITHM), "code_algorithm"), other="code_application")),
        (parallel_text(x, t), "translation_parallel"),
        (has(K.GRAMMAR) & has(P.TRANSLATION), "linguistics_grammar"),
        (has(K.MEDICAL_QA), "medical_qa"),
        (has(K.MEDICAL), within((~has(K.MEDICAL_GUIDELINE) & asked, "medical_qa"), other="medical_guideline")),
        (has(K.LEGAL_STATUTE) & (n_legal > 0), "legal_statute"),
        ((has(K.LEGAL_CASE) | asked) & (n_legal > 0), "legal_case"),
        (n_legal >= 2, "legal_statute"),
        (has(K.MACRO) | (has(K.RATE) & has(K.RATE_CONTEXT)), "finance_macro"),
        (has(K.MARKET), "finance_market"),
        (has(K.BANK), "finance_banking"),
        (has(K.EXAM), "gov_exam"),
        (has(K.POLICY), "gov_policy"),
        (has(K.ENGINEERING), "stem_engineering"),
        (has(K.PHYSICS), "stem_physics_math"),
        (has(K.TECH_FORUM), "tech_blog_forum"),
        (has(K.PSYCHOLOGY), "social_psychology"),
        (has(K.PHILOSOPHY), "humanities_philosophy"),
        (has(K.HISTORY), "humanities_history"),
        (has(K.WIKI), "encyclopedia_core"),
        ((F.length(x) >= 1200) & asked, "encyclopedia_qa"),
        (has(K.PAPER), "academic_paper"),
        (has(K.TEXTBOOK), "academic_textbook"),
        (has(K.REPORT), "professional_report"),
        (has(K.MATH), within((has(K.MATH_PROOF), "math_derivation"), (has(K.MATH_PUZZLE), "math_logic_puzzle"), other="math_calculation")),
        (has(K.NEWS), within((has(K.COMMENTARY), "news_commentary"), other="news_mainstream")),
        (has(K.EDITORIAL), "article_editorial"),
        (has(K.BLOG), "article_blog"),
        (classical_literature(x, t), "literature_classical"),
        (web_novel(x, t), "literature_web"),
        (narrative_book(x, t), "literature_classic"),
        (forum_talk(x, t), "comm_conversational"),
    ]
    return first_of(fields, F.lit("other"))


def responsiveness(x: Column, code_block: Column | None = None, numeral: Column | None = None, differs_from: Column | None = None, min_chars: Column | None = None) -> tuple[Column, Column]:
    """Share of the expectations met, and those missed. An expectation is asked for where its column is true, or holds a
    source text or a positive number."""
    off = F.lit(False)
    code, number = (F.coalesce(c, off) if c is not None else off for c in (code_block, numeral))
    source = T.squeeze(F.coalesce(differs_from, F.lit(""))) if differs_from is not None else F.lit("")
    least = F.coalesce(min_chars, F.lit(0)) if min_chars is not None else F.lit(0)
    own = T.squeeze(x)
    rules = [
        (code, ~x.rlike(P.CODE_FENCE), "code_block"),
        (number, ~x.rlike(P.NUMERAL), "numeral"),
        (source != "", own.contains(source), "differs_from"),
        (least > 0, F.length(own) < least, "min_chars"),
    ]
    asked = F.array_compact(F.array(*[F.when(on, F.lit(n)) for on, _, n in rules]))
    missed = F.array_compact(F.array(*[F.when(on & bad, F.lit(n)) for on, bad, n in rules]))
    return F.when(F.size(asked) == 0, 1.0).otherwise(1 - F.size(missed) / F.size(asked)), missed


def hard_prompt(x: Column, min_chars: int = 18) -> Column:
    """Prompts that ask for something, in Chinese, and don't close a talk."""
    t = T.strip(x)
    han = T.count_of(t, P.CJK)
    return (F.length(t) >= min_chars) & ~(t.rlike(P.CLOSING) & (F.length(t) < 40)) & t.rlike(P.ASKING) & (han >= F.greatest(F.lit(4.0), F.length(t) * 0.15))


def triage(x: Column, tokens: Column) -> Column:
    """Audit flags of a text and its tokens."""
    n = F.greatest(F.length(x), F.lit(1))
    marks = F.length(x) - F.length(F.translate(x, P.PUNCTUATION, ""))
    flags = [
        (x.rlike(P.AUDIT_URL), "url"),
        (x.rlike(P.EMAIL), "email"),
        (x.rlike(P.AUDIT_TAG) | x.rlike(P.AUDIT_ENTITY), "html"),
        (x.rlike(P.AUDIT_CODE), "code"),
        (x.rlike(P.AUDIT_CONTACT), "contact"),
        (x.rlike(P.AUDIT_NAV), "nav"),
        (x.rlike(P.AUDIT_FOOTER), "footer"),
        (x.rlike(P.AUDIT_DOWNLOAD), "download"),
        ((T.count_of(x, r"\x{FFFD}") / n >= 0.002) | (T.count_of(x, r"\x{FFFD}") >= 5), "mojibake"),
        (marks / n >= 0.35, "punct_high"),
        (T.count_of(x, r"\p{Nd}") / n >= 0.35, "digit_high"),
        (arrow.compression(x) >= 6, "repetitive"),
        (F.size(F.array_distinct(tokens)) / F.greatest(F.size(tokens), F.lit(1)) <= 0.10, "low_token_diversity"),
        (arrow.duplicate_ngrams(tokens) >= 0.25, "ngram_dup_high"),
    ]
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for hit, name in flags]))


def language_of_response(x: Column, language: Column, expected: Column, mode: Column) -> Column:
    """Whether a response is in the language asked for; null where that isn't judged."""
    own = T.strip(x)
    bare = lambda c: F.regexp_replace(F.lower(T.squeeze(c)), r"^[.,;:!?。；：！？]+|[.,;:!?。；：！？]+$", "")
    cjk = own.rlike(P.CJK)
    return (
        F.when(mode == "exempt", F.lit(None).cast("boolean"))
        .when(own == "", F.lit(False))
        .when(F.lower(language) == "en", ~cjk)
        .when(F.lower(language) != "zh", F.lit(None).cast("boolean"))
        .otherwise(cjk | ~own.rlike("[A-Za-z]") | F.exists(expected, lambda e: bare(e) == bare(own)))
    )


def answers(x: Column, expected: Column, mode: Column) -> Column:
    """Whether a response begins with (mode prefix) or holds an expected answer, case and white space aside."""
    own = F.lower(T.squeeze(x))
    return F.exists(expected, lambda e: F.when(mode == "prefix", own.startswith(F.lower(T.squeeze(e)))).otherwise(own.contains(F.lower(T.squeeze(e)))))
