"""Quality rules (5): base rules on words, and robust multivariate outliers among what passes.

Statistics of every text (words, characters in words, symbols, repeated lines, words in repeated 3-word windows) are
transformed to a vector of five. Per language and source a minimum-covariance-determinant estimate is made from all
rows that pass the base rules, from several starts (`STARTS`: the medians, the first and the third quartiles as
location, quartile ranges as spread). Concentration steps each take the `SUPPORT` share of rows with the least
Mahalanobis distance and estimate location and covariance anew; a step is one aggregation for all groups and starts:
sums and products by group, start and bin of distance, of which the nearest bins are added up, so no group is gathered,
however large. Of a group's estimates the one of the least determinant stays. Distances are scaled so that the share's
quantile is that of chi-squared, and rows beyond `CUTOFF` are rejected.

An estimate needs `LEAST` rows, ten for each statistic. Rows of smaller groups are judged by the estimate of their
language or, if it has fewer too, by that of all rows, so every row that passes the base rules has a distance at every
size.

Rows: a null or empty text has no words and fails the base rules. Null lang or source is a group like another. Rows that repeat an id are judged each. Other columns are
dropped, whatever their names. An empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, NULL_ID, Words, map_arrow, materialize, slices
from .substring import both

DIMS, STEPS, SUPPORT, LEAST = 5, 4, 0.75, 50
#: Quartiles at which concentration begins: the median and those on either side of it.
STARTS = (1, 0, 2)
#: Estimates (some 200 bytes each) up to which they are broadcast.
SMALL = 100_000
#: The share of normal rows that lie beyond the cutoff.
BEYOND = 1e-9


def chi_squared(beyond: float) -> float:
    """The value that chi-squared with DIMS = 5 degrees of freedom exceeds with the given probability."""
    tail = lambda x: math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if tail(mid) > beyond else (lo, mid)
    return hi


#: The chi-squared quantile of the support, and the scaled squared distance beyond which a row is an outlier.
SUPPORT_QUANTILE, CUTOFF = chi_squared(1 - SUPPORT), chi_squared(BEYOND)
#: Least standard deviation of each transformed statistic: smaller differences say nothing about quality.
FLOOR = (0.5, 0.05, 0.5, 0.5, 0.15)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(rid, lang, source, the five counts) of every text."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("rid"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("text"))

    def run(batch: pa.RecordBatch):
        for lo, hi in slices(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            w = Words(part.column("text"))
            n = len(part)
            within = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][w.offsets])  # noqa: E731  how many bytes of each text
            out = {
                "n_words": np.diff(w.first),
                "word_chars": within(~IS_SPACE[w.data] & ((w.data & 0xC0) != 0x80)),
                "n_symbols": within(_SYMBOL[w.data]),
                "n_dup_lines": np.array([repeated_lines(w.data[w.offsets[k] : w.offsets[k + 1]].tobytes()) for k in range(n)], dtype=np.int64),
                "n_repeat_words": repeated_words(w, n),
            }
            yield {c: part.column(c) for c in ("rid", "lang", "source")} | out

    return map_arrow(rows, "rid long, lang string, source string, " + ", ".join(f"{c} long" for c in STATS), run)


def repeated_lines(raw: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in raw.split(b"\n"):
        if line in seen:
            n += 1
        elif line.strip(b" \t\x0b\x0c\r"):
            seen.add(line)
    return n


def repeated_words(w: Words, n: int) -> np.ndarray:
    """Words of each text in 3-word windows that the text has twice or more."""
    if len(w.name) < 3:
        return np.zeros(n, dtype=np.int64)
    three = both(both(w.name[:-2], w.name[1:-1]), w.name[2:])
    at = np.flatnonzero(w.row[:-2] == w.row[2:])
    order = at[np.lexsort((three[at], w.row[at]))]
    same = (three[order][1:] == three[order][:-1]) & (w.row[order][1:] == w.row[order][:-1])
    often = np.zeros(len(order), dtype=bool)
    often[1:] |= same
    often[:-1] |= same
    hit = np.zeros(len(w.name), dtype=bool)
    for k in range(3):
        hit[order[often] + k] = True
    return np.bincount(w.row[hit], minlength=n)


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def vector() -> list[Column]:
    """The transformed statistics; rows that pass the base rules have words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p("n_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.sqrt(100 * F.col("n_symbols") / n),
        F.sqrt(100 * F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


_PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
_GROUP = ["level", "lang", "source"]
_TRIAL = [*_GROUP, "start"]
_MODEL = "level int, lang string, source string, start int, det double, " + ", ".join(f"m{i} double" for i in range(DIMS)) + ", " + ", ".join(f"p{i}{j} double" for i, j in _PAIRS)
_COLUMNS = [c.split()[0] for c in _MODEL.split(", ")]


def _same_group() -> Column:
    return F.expr("level = g_level and lang <=> g_lang and source <=> g_source")


def _named(model: DataFrame) -> DataFrame:
    return model.withColumnsRenamed({c: f"g_{c}" for c in _GROUP})


#: The groups that a row is in: language and source, the language, and all rows.
LEVELS = "array(named_struct('level', 0, 'lang', lang, 'source', source), named_struct('level', 1, 'lang', lang, 'source', string(null)), named_struct('level', 2, 'lang', string(null), 'source', string(null)))"


def _distance() -> Column:
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(DIMS)]
    return sum((F.col(f"p{i}{j}") * d[i] * d[j] * (1 if i == j else 2) for i, j in _PAIRS), F.lit(0.0))


def _estimate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Location, inverse covariance and its determinant from a group's sums; a group and start is one row."""
    for f in frames:
        rows = []
        for r in f.itertuples(index=False):
            mean = np.array([getattr(r, f"s{i}") for i in range(DIMS)]) / r.n
            cov = np.zeros((DIMS, DIMS))
            for i, j in _PAIRS:
                cov[i, j] = cov[j, i] = getattr(r, f"q{i}{j}") / r.n - mean[i] * mean[j]
            cov += np.diag(np.square(FLOOR))
            inverse = np.linalg.inv(cov)
            rows.append((r.level, r.lang, r.source, r.start, np.linalg.det(cov), *mean, *(inverse[i, j] for i, j in _PAIRS)))
        yield pd.DataFrame(rows, columns=_COLUMNS)


def _nearest(binned: DataFrame) -> DataFrame:
    """Bins in the order of distance, up to and with the one that completes the support."""
    own = ", ".join(_TRIAL)
    return binned.selectExpr("*", f"sum(n) over (partition by {own} order by bin) - n as below", f"sum(n) over (partition by {own}) as n_all").where(f"below < {SUPPORT} * n_all")


def estimates(vectors: DataFrame) -> DataFrame:
    """One row per group of LEAST rows or more, and of all rows: location, inverse covariance and the scale of distances."""
    vectors = vectors.select(F.explode(F.expr(LEVELS)).alias("g"), *(f"x{i}" for i in range(DIMS))).select("g.*", *(f"x{i}" for i in range(DIMS)))
    quartile = [F.percentile_approx(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"t{i}") for i in range(DIMS)]
    begin = vectors.groupBy(*_GROUP).agg(F.count("*").alias("n"), *quartile).where(f"n >= {LEAST} or level = 2").withColumn("start", F.explode(F.array(*map(F.lit, STARTS))))
    spread = [f"1 / (pow((t{i}[2] - t{i}[0]) / 1.349, 2) + pow({FLOOR[i]}, 2)) as p{i}{i}" for i in range(DIMS)]
    first = begin.selectExpr(*_TRIAL, "0D as det", *(f"t{i}[start] as m{i}" for i in range(DIMS)), *spread, *(f"0D as p{i}{j}" for i, j in _PAIRS if i != j))
    model = materialize(first.select(_COLUMNS), "mcd")
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(DIMS)] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in _PAIRS]
    total = [F.sum(c).alias(c) for c in ["n", *(f"s{i}" for i in range(DIMS)), *(f"q{i}{j}" for i, j in _PAIRS)]]
    bin_ = F.floor(32 * F.log2(_distance() + 1e-6)).alias("bin")
    for _ in range(STEPS):
        binned = vectors.join(_named(model), _same_group()).groupBy(*_TRIAL, bin_).agg(F.count("*").alias("n"), *sums)
        model = materialize(_nearest(binned).groupBy(*_TRIAL).agg(*total).mapInPandas(_estimate, _MODEL), "mcd")
    best = model.groupBy(*_GROUP).agg(F.min(F.struct("det", *[c for c in _COLUMNS if c not in ("det", *_GROUP)])).alias("m")).select(*_GROUP, "m.*")
    model = materialize(best.select(_COLUMNS), "mcd")
    binned = vectors.join(_named(model), _same_group()).groupBy(*_TRIAL, bin_).agg(F.count("*").alias("n"))
    at = _nearest(binned).groupBy(*_GROUP).agg(F.max("bin").alias("bin"))
    scaled = model.join(_named(at), _same_group()).drop(*(f"g_{c}" for c in _GROUP))
    return materialize(scaled.withColumn("scale", F.greatest(F.pow(2.0, (F.col("bin") + 1) / 32) / SUPPORT_QUANTILE, F.lit(1e-3))).drop("bin"), "mcd")


def judge(docs: DataFrame, cutoff: float = CUTOFF, id_col: str = "doc_id") -> DataFrame:
    """Per row: the id, counts, base_failed, kept, and `outlyingness`, the scaled squared distance (null where the base rules fail)."""
    stats = statistics(docs, id_col).withColumn("base_failed", base_failed())
    stats = materialize(stats.withColumns({f"x{i}": F.round(c, 9) for i, c in enumerate(vector())}), "statistics")
    model = estimates(stats.where("not base_failed"))
    sent = F.broadcast if model.count() <= SMALL else lambda x: x
    have = sent(model.select(*(F.col(c).alias(f"h_{c}") for c in _GROUP)))
    for k in range(2):  # a row's level is the finest that has an estimate
        at = f"h_level = {k} and h_lang <=> lang" + " and h_source <=> source" * (k == 0)
        stats = stats.join(have.withColumn(f"has{k}", F.lit(True)), F.expr(at), "left").drop(*(f"h_{c}" for c in _GROUP))
    level = F.expr("case when has0 then 0 when has1 then 1 else 2 end")
    stats = stats.withColumn("g", F.element_at(F.expr(LEVELS), level + 1)).drop("lang", "source").select("*", "g.*")
    joined = stats.join(sent(_named(model)), _same_group(), "left").withColumn("outlyingness", F.when(~F.col("base_failed"), _distance() / F.col("scale")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("outlyingness") <= cutoff, F.lit(True))
    return joined.select(F.when(F.col("rid") != NULL_ID, F.col("rid")).alias(id_col), *STATS, "base_failed", kept.alias("kept"), "outlyingness")
