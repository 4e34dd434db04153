"""Text functions as columns: normalisation, measures, keys. All run inside Spark's own expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P

C = Column | str


def _c(x: C) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hits(x: C, pattern: str) -> Column:
    """Matches of a pattern in a text."""
    return F.regexp_count(_c(x), F.lit(pattern))


def strip(x: C) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def squeeze(x: C) -> Column:
    """Without any white space."""
    return F.regexp_replace(_c(x), r"(?U)\s+", "")


def lines(x: C) -> Column:
    return F.split(_c(x), "\r\n|\r|\n")


def control_free(x: C) -> Column:
    """Line ends as \\n, without NUL, U+FFFD and control or format characters but tab; NFC is left to the Arrow function."""
    return F.regexp_replace(F.regexp_replace(_c(x), "\r\n?", "\n"), r"[\x{0000}\x{FFFD}]|[\p{Cc}\p{Cf}&&[^\n\t]]", "")


def count_of(x: C, kind: str) -> Column:
    """Characters of a class in a text: what is lost when its runs are taken out, far fewer matches than characters."""
    return F.length(_c(x)) - F.length(F.regexp_replace(_c(x), kind + "++", ""))


def script_ratios(x: C) -> tuple[Column, Column]:
    """CJK and Latin letters as shares of both."""
    cjk, latin = count_of(x, P.CJK), count_of(x, P.LATIN)
    n = F.greatest(cjk + latin, F.lit(1))
    return cjk / n, latin / n


def length_bucket(n: C) -> Column:
    n = _c(n)
    return F.when(n < 2000, "chars_lt_2k").when(n < 8000, "chars_2k_8k").when(n < 32000, "chars_8k_32k").otherwise("chars_ge_32k")


def token_length_bucket(n: C) -> Column:
    n = _c(n)
    return F.when(n < 4096, "tokens_lt_4k").when(n < 8192, "tokens_4k_8k").when(n < 16384, "tokens_8k_16k").otherwise("tokens_ge_16k")


def document_year(ts: C) -> Column:
    year = F.regexp_extract(strip(_c(ts).cast("string")), P.YEAR, 1)
    return F.when(F.coalesce(year, F.lit("")) == "", "unknown").otherwise(year)


def license_ids(x: C) -> Column:
    """Sorted distinct identifiers of a licence expression."""
    parts = F.transform(F.split(_c(x), r"\s*(?:,|\bOR\b|\bAND\b)\s*"), lambda s: F.lower(F.trim(s)))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda s: s != "")))


def license_label(x: C) -> Column:
    """One label of a list of licences."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.transform(_c(x), F.trim), lambda s: s != ""))), " OR ")


def with_title(title: C, text: C) -> Column:
    """The title, a blank line and the text, unless the text begins with the title."""
    t = strip(F.coalesce(_c(title), F.lit("")))
    return F.when((t == "") | _c(text).startswith(t), _c(text)).otherwise(F.concat(t, F.lit("\n\n"), _c(text)))


def document_split(sha: C) -> Column:
    """train, val or test by the first 32 bits of a digest: 96, 2 and 2 of 100."""
    n = F.conv(F.substring(_c(sha), 1, 8), 16, 10).cast("long") % 10000
    return F.when(n < 9600, "train").when(n < 9800, "val").otherwise("test")


def trim_to_bytes(x: C, n: int | Column) -> Column:
    """The longest prefix of whole characters within n UTF-8 bytes, stripped."""
    n = F.lit(n) if isinstance(n, int) else n
    coded = F.encode(_c(x), "UTF-8")
    raw = F.substring(coded, F.lit(1), n)
    cut = F.regexp_replace(F.decode(raw, "ISO-8859-1"), r"[\x{C0}-\x{FF}][\x{80}-\x{BF}]*$", "")
    last = F.substring(coded, n + 1, F.lit(1))
    ends = (F.conv(F.hex(last), 16, 10).cast("int").bitwiseAND(F.lit(0xC0)) != 0x80) | (F.octet_length(_c(x)) <= n)
    return strip(F.when(ends, F.decode(raw, "UTF-8")).otherwise(F.decode(F.encode(cut, "ISO-8859-1"), "UTF-8")))


def skeleton(x: C) -> Column:
    """The text without white space, each number as #."""
    return squeeze(F.regexp_replace(_c(x), P.NUMBER_RUN, "#"))


def split_think(x: C, eos: str = "") -> tuple[Column, Column]:
    """Reasoning before the closing tag, and the answer after it."""
    at = F.instr(_c(x), "</think>")
    think = F.when(at > 0, strip(F.replace(F.substring(_c(x), F.lit(1), at - 1), F.lit("<think>"), F.lit("")))).otherwise("")
    answer = F.when(at > 0, F.substring(_c(x), at + 8, F.length(_c(x)))).otherwise(_c(x))
    return think, strip(F.replace(answer, F.lit(eos), F.lit("")) if eos else answer)


def without_think(x: C) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(_c(x), P.THINK_BLOCK, ""), P.THINK_TAG, ""))


def canonical_url(host: C, title: C) -> Column:
    """https://host/wiki/Title with spaces as _ and the rest percent-encoded."""
    coded = F.url_encode(F.replace(_c(title), F.lit(" "), F.lit("_")))
    for code, plain in (("%28", "("), ("%29", ")"), ("%2C", ","), ("%2F", "/"), ("%3A", ":")):
        coded = F.replace(coded, F.lit(code), F.lit(plain))
    return F.concat(F.lit("https://"), _c(host), F.lit("/wiki/"), coded)


def choice_prompt(question: C, labels: C, choices: C) -> Column:
    """The question and a line `A. choice` for each choice that isn't blank."""
    rows = F.zip_with(_c(labels), _c(choices), lambda a, b: F.when((strip(b) != "") & a.isNotNull(), F.concat(strip(a), F.lit(". "), strip(b))))
    return F.array_join(F.concat(F.array(strip(question)), F.array_compact(rows)), "\n")


def prompts(rows: DataFrame, name: str, forms: dict[str, Column], least: int) -> DataFrame:
    """With `prompt`, in the form of each row's benchmark; rows of other benchmarks, or of fewer characters, white space
    aside, go."""
    own = F.coalesce(*[F.when(F.col(name) == n, form) for n, form in forms.items()])
    return rows.withColumn("prompt", own).where(length_of("prompt") >= least)


def length_of(x: C) -> Column:
    """Characters of a text, white space aside."""
    return F.length(squeeze(x))


def text_features(x: C) -> dict[str, Column]:
    """Six measures of a text in [0, 1]."""
    n = F.greatest(F.length(_c(x)), F.lit(1))
    return {
        "log_length": F.least(F.log2(n + 1) / 16, F.lit(1.0)),
        "cjk_share": count_of(x, r"[\x{3400}-\x{9fff}]") / n,
        "digit_share": count_of(x, r"\p{Nd}") / n,
        "latin_share": count_of(x, P.LATIN) / n,
        "url_share": F.least(hits(x, P.URL) / 5, F.lit(1.0)),
        "punct_share": count_of(x, "[，。！？；：,.!?;:]") / n,
    }


def let(value: Column, f) -> Column:
    """f of a value that is worked out once, for use inside the lambdas of f."""
    return F.element_at(F.transform(F.array(value), f), 1)


def windows(a: Column, n: int) -> Column:
    """Runs of n strings of an array, each as one string, which array_distinct hashes; the array must be bound (see let)."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(a) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(a, i, n), "\x01"))


def distinct_share(a: Column, n: int) -> Column:
    """Distinct runs of n elements as a share of all."""
    return let(windows(a, n), lambda w: F.size(F.array_distinct(w)) / F.size(w))


def characters(x: C) -> Column:
    return F.filter(F.split(_c(x), ""), lambda c: c != "")


def distinct_ngram_ratio(x: C, n: int = 4) -> Column:
    """Distinct character n-grams of the text without white space, as a share; 1 for short texts."""
    return let(characters(squeeze(x)), lambda t: F.when(F.size(t) <= n, F.lit(1.0)).otherwise(distinct_share(t, n)))


def repeated_ngram_ratio(x: C, n: int = 4) -> Column:
    """1 less the share of distinct runs of n words and marks; 0 for fewer."""
    words = F.regexp_extract_all(_c(x), F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0))
    return let(words, lambda t: F.when(F.size(t) < n, F.lit(0.0)).otherwise(1 - distinct_share(t, n)))


def fold_counts(a: Column, add) -> Column:
    """Folds add(total, element, count) over the distinct elements of an array of strings: sorted once, counted in one pass."""
    zero = F.struct(F.lit(None).cast("string").alias("s"), F.lit(0).alias("k"), F.lit(0).alias("t"))
    total = lambda z: F.when(z["k"] > 0, add(z["t"], z["s"], z["k"])).otherwise(z["t"])

    def step(z, s):
        same = z["s"].eqNullSafe(s)
        return F.struct(s.alias("s"), F.when(same, z["k"] + 1).otherwise(1).alias("k"), F.when(same, z["t"]).otherwise(total(z)).alias("t"))

    return F.aggregate(F.array_sort(a), zero, step, total)
