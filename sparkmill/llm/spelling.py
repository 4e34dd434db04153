"""Spelling variant grouping (13): words that differ by one inserted, deleted or replaced code point, by pivotal grams.

Bigrams are ordered by the number of words that hold them, rarest first. A word's prefix are its three first bigrams in this
order (and all others equal to the third); its pivots are two disjoint bigrams of the prefix of the least total number
of words, chosen by dynamic programming. One edit touches one pivot at most, so of two near words the one whose prefix
ends first in the order has a pivot that stands in the other's prefix, unchanged, and shifted by one place at most. The
edit lies wholly to one side of that pivot, so all up to its end, or all from its begin, is equal: index keys are this
equal part with the other word's length, which bounds the shift, and one key holds few words. Meetings are verified by
edit distance.

Everything but the choice of grams is Spark SQL. Counts of bigrams go to every task: letters are a-z and U+00C0 to U+00FF,
so there are at most 90 * 90. Tables of words and keys are never broadcast: Spark takes a word's dozen keys for one row, and
compressed files for what they hold, so just below its threshold it would send a vocabulary through the driver.

Rows: null texts have no words; a null doc_id counts as an empty string before the colon. Repeated rows count each.
Very long texts are split like others. Ties of forms go to the smaller word. Other columns are dropped, whatever their
names. An empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, LEAST, SLIP, GRAM, EDITS = 5, 3, 97, 2, 1


def counted(docs: DataFrame, id_col: str = "doc_id", shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n) of words of at least `shortest` code points and `least` occurrences; the run whose crc32 with its document's
    id SLIP divides has lost a code point."""
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]+"), 0)
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.filter(runs, lambda r: F.length(r) >= shortest)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(h % SLIP == 0, cut).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """How many words hold each bigram; alphabet * alphabet rows at most, see above."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("word") - GRAM + 1), lambda k: F.substring("word", k, F.lit(GRAM))))
    return {r.g: r["count"] for r in words.where(F.length("word") >= GRAM).select(F.explode(grams).alias("g")).groupBy("g").count().collect()}


def prefix(word: str, count: dict[str, int], edits: int = EDITS) -> tuple[list[tuple[tuple[int, str], int]], tuple[int, str]]:
    """((rank, place) of a word's first grams, by place) and the last rank among them."""
    grams = [((count[word[k : k + GRAM]], word[k : k + GRAM]), k) for k in range(len(word) - GRAM + 1)]
    last = sorted(grams)[min(GRAM * edits, len(grams) - 1)][0]
    return [g for g in grams if g[0] <= last], last


def pivots(grams: list[tuple[tuple[int, str], int]], wanted: int = EDITS + 1) -> list[int]:
    """The places of `wanted` disjoint grams of the least total count; best[i][k]: the least for k of the first i grams."""
    places = [p for _, p in grams]
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * wanted]
    for i, ((n, _), p) in enumerate(grams):
        before = best[bisect_right(places, p - GRAM, 0, i)]
        row = list(best[i])
        for k in range(1, wanted + 1):
            if before[k - 1] is not None:
                own = (before[k - 1][0] + n, (*before[k - 1][1], p))
                row[k] = own if row[k] is None else min(row[k], own)
        best.append(row)
    return list((best[-1][wanted] or (0, ()))[1])


def _keys(words: DataFrame, count: dict[str, int], pivot: bool) -> DataFrame:
    """(key, word, n, rank): a pivot's keys are made for each length that a near word can have, a prefix gram's for its own.
    rank: of the prefix's last gram, as a number that orders alike in both."""
    order = {g: k for k, g in enumerate(sorted((n, g) for g, n in count.items()))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, at, rank = [], [], []
            for i, w in enumerate(b.column("word").to_pylist()):
                grams, last = prefix(w, count)
                for p in pivots(grams) if pivot else [p for _, p in grams]:
                    sides = ("<" + w[: p + GRAM], ">" + w[p:])
                    for length in range(len(w) - EDITS, len(w) + EDITS + 1) if pivot else (len(w),):
                        key += [xxhash.xxh64_intdigest(f"{length}{s}") - (1 << 63) for s in sides]
                        at += [i, i]
                        rank += [order[last]] * 2
            idx = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), b.column("word").take(idx), b.column("n").take(idx), pa.array(rank, pa.int32())], names=["key", "word", "n", "rank"])

    return words.mapInArrow(run, "key long, word string, n long, rank int")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb), each two near words once; words (word, n) are distinct and have GRAM * EDITS + GRAM code points or more."""
    count = gram_counts(words)
    own = _keys(words, count, True).select("key", F.col("word").alias("w"), F.col("n").alias("nw"), F.col("rank").alias("rw"))
    met = own.hint("merge").join(_keys(words, count, False), "key").where((F.col("rw") <= F.col("rank")) & (F.col("w") != F.col("word")))
    near = met.where(F.levenshtein("w", "word", EDITS) == EDITS)
    first = F.col("w") < F.col("word")
    sides = [F.when(first, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("w", "word", "a"), ("nw", "n", "na"), ("word", "w", "b"), ("n", "nw", "nb"))]
    return near.select(*sides).distinct()


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for words (word, n)."""
    words = materialize(words.select("word", "n"), "words")
    pairs = materialize(near_pairs(words), "near")
    both = pairs.select("a", "na", "b", "nb").unionAll(pairs.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    best = both.groupBy(F.col("a").alias("word"), F.col("na").alias("n")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b").alias("w"))).alias("f"))
    holds = -F.col("f.m") >= times * F.col("n")
    formed = materialize(best.select("word", "n_near", F.when(holds, F.col("f.w")).alias("form"), F.when(holds, -F.col("f.m")).alias("form_n")), "forms")
    tops = materialize(formed.where("form is not null").select("word", F.col("form").alias("top")), "tops")
    while True:  # a form has twice the occurrences at least, so chains are short, and each round doubles what is followed
        step = tops.select(F.col("word").alias("top"), F.col("top").alias("further"))
        tops = materialize(tops.hint("merge").join(step, "top", "left").select("word", F.coalesce("further", "top").alias("top"), F.col("further").isNotNull().alias("went")), "tops")
        if tops.where("went").isEmpty():
            break
    out = words.hint("merge").join(formed, "word", "left").hint("merge").join(tops.select("word", "top"), "word", "left")
    return out.select("word", "form", F.coalesce("top", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
