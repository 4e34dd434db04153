"""The quality model that validation chooses, and its constraint."""

import math
import os
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmill import catalog, plans  # noqa: F401
from sparkmill.functions import arrow, kernels, text
from sparkmill.operators import dedup, learned, reports


def test_validation_chooses_and_refuses(spark):
    r = random.Random(5)
    text = lambda good: " ".join(r.choice(["clear", "plain", "useful", "story"] if good != (r.random() < 0.15) else ["zzq", "buy", "xxk", "now"]) for _ in range(12))
    rows = [(k, text(k % 2 == 0), int(k % 2 == 0)) for k in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    train, valid = df.where("doc_id < 100"), df.where("doc_id >= 100")
    f1 = lambda model: learned.score_quality(valid, model).agg(*reports.confusion(F.col("quality"), F.col("score") >= 0.5)).select(reports.classifier_metrics(*map(F.col, ("tp", "fp", "fn", "tn")))["macro_f1"].alias("f")).first().f
    grid = (0.01, 1000.0)
    model, strength, held = learned.fit_path(train, valid, grid=grid)
    each = {g: f1(learned.fit_path(train, valid, grid=(g,))[0]) for g in grid}
    assert held and each[strength] == max(each.values()) and f1(model) == each[strength] > 0.9
    assert not learned.fit_path(train, valid, grid=(0.01,), least_precision=1.01)[2]


def test_vectors_against_plain_tfidf(spark):
    texts = ["abab", "abc", "abd", None, "", "x" * 300 + "ab", "q" * 70_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = learned.featured(df)
    weight = learned.term_weights(rows)
    counts = [Counter(dict(zip(*(x.tolist() for x in kernels.gram_counts(t or "", learned.LONGEST, learned.BITS)), strict=True))) for t in texts]
    have = Counter(at for c in counts for at in c)
    want = {at: math.log((1 + len(texts)) / (1 + n)) + 1 for at, n in have.items() if 2 <= n <= 0.995 * len(texts)}
    assert {int(at): weight[at] for at in np.flatnonzero(weight)} == pytest.approx(want) and want
    got = {x.doc_id: x["__x"] for x in learned.with_vectors(rows, weight).collect()}
    for k, c in enumerate(counts):
        v = {at: (1 + math.log(n)) * want[at] for at, n in c.items() if at in want}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        own = {int(i): float(x) for i, x in zip(got[k].indices, got[k].values, strict=True) if i < 1 << learned.BITS}
        assert own == pytest.approx({at: x / norm for at, x in v.items()}) and got[k].size == (1 << learned.BITS) + 6


def test_terms_of_all_texts_and_of_one_text_weigh_nothing(spark):
    df = spark.createDataFrame([(k, "zz" + "abcdefgh"[k]) for k in range(8)], "doc_id long, text string")
    assert not learned.term_weights(learned.featured(df)).any()


def test_registered_learned_queries(spark, tmp_path):
    r = random.Random(8)
    words = {1: ["clear", "plain", "useful", "story", "river"], 0: ["zzq", "buy", "xxk", "now", "win"]}
    rows = [(k, " ".join(r.choice(words[int(k % 3 > 0)]) for _ in range(60)), "en", f"src{3 if k % 2 else 1}", 300, int(k % 3 > 0)) for k in range(90)]
    rows += [(90, None, "en", "src3", 0, 1), (91, "", "en", "src3", 0, 0), (92, "river " * 4000, "en", "src3", 24000, 1)]
    every = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    every.drop("quality").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    every.where("doc_id < 90").select("doc_id", "quality").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    run = lambda name: catalog.QUERIES[name](spark, str(tmp_path)).collect()
    scores = {x.doc_id: x.score for x in run("l03_score_quality")}
    assert len(scores) == 93 and scores[90] is None and all((scores[k] >= 0.5) == (q == 1) for k, *_, q in rows[:90])
    kept = {x.doc_id: x.bucket for x in run("l04_quality_filter")}
    assert set(kept) == {k for k, _, _, source, *_ in rows if source == "src3" or scores[k] is None or scores[k] >= 0.3}
    assert all(b is None if scores[k] is None else b == min(int(scores[k] * 10), 9) for k, b in kept.items())
    assert {x.part: (x.precision, x.recall, x.macro_f1) for x in run("l02_fit_quality_proxy")} == dict.fromkeys(("train", "valid", "test"), (1, 1, 1))


def test_terms_and_vectors_are_made_by_slices_and_not_kept(spark):
    r = random.Random(6)
    texts = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(4000)) for _ in range(400)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    tracemalloc.start()
    n = sum(len(x) for x in arrow.vectors(iter([batch]), "text", np.ones(1 << learned.BITS), learned.LONGEST, learned.BITS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts) and peak < 60e6, peak
    rows = [(k, f"text {k} {'good' if k % 2 else 'bad'}", k % 2) for k in range(60)]
    before = set(os.listdir(dedup.shared(spark)))
    learned.fit_path(*[spark.createDataFrame(rows, "doc_id long, text string, quality int")] * 2, grid=(0.01,))
    kept = [spark.read.parquet(f"{dedup.shared(spark)}/{x}") for x in set(os.listdir(dedup.shared(spark))) - before]
    assert kept and all(kind in ("string", "double") for t in kept for _, kind in t.dtypes)


def test_measures_are_those_of_the_text_functions(spark):
    texts = ["", "a", "Ab1 ٣४ 𝟘 中文，。!", "HTTP://x www. httpſ:// wWw.WWW. ,;:", "x" * 70_000 + "。", "龠鿿ꀀ㐀㏿ÀÿK"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").select("k", *text.text_features("text").values())
    for k, *want in df.collect():
        assert kernels.measures(texts[k]) == pytest.approx(want), texts[k]
