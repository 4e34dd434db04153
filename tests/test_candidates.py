"""Candidate corpora against plain versions: what is dropped and why, duplicates within, the profile and the derivative."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkmill.operators import candidates

SCHEMA = "doc_id long, text string, lang string, source string"


def prose(seed, n=90):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9))) for _ in range(n)) + f"\n{seed}"


@pytest.fixture(scope="module")
def judged(spark):
    old = [(100, prose(1), "de", "old"), (101, prose(2), "de", "old"), (102, None, "de", "old")]
    rows = [
        (1, prose(1), "de", "new"),  # exactly the earlier one
        (2, prose(2) + " tail", "de", "new"),  # nearly the earlier one
        (3, "short", "de", "new"),
        (4, None, "de", "new"),
        (5, prose(5), "de", "new"),
        (6, prose(5), "de", "new"),  # a copy within
        (7, prose(5) + " more", "de", "new"),  # a near copy within
        (8, "the ".join(["ab cd ef gh "] * 400), "de", "new"),  # poisoned
        (9, "  " + prose(9).replace("\n", "\r\n") + " \x00", "de", None),
    ]
    make = lambda x: spark.createDataFrame(x, SCHEMA).repartition(3)
    every = {how: candidates.admitted(make(rows), make(old), "doc_id", "lang", how).cache() for how in ("exclude", "report")}
    return rows, every


def test_reasons_and_lineage(judged):
    rows, every = judged
    got = {x.doc_id: x for x in every["exclude"].collect()}
    want = {1: "legacy_exact_overlap", 2: "legacy_near_overlap", 3: "too_short", 4: "too_short", 5: "", 6: "", 7: "", 8: "poison_repetition", 9: ""}
    assert {k: x.reason for k, x in got.items()} == want
    assert {k: x.upstream_text_sha256 for k, x in got.items()} == {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t, *_ in rows}
    assert got[9].text == prose(9) and got[9].source is None and got[5].document_sha256 == got[6].document_sha256 != got[7].document_sha256
    marked = {x.doc_id: (x.reason, x.legacy_exact_overlap, x.legacy_near_overlap) for x in every["report"].collect()}
    assert marked[1] == ("", True, False) and marked[2] == ("", False, True) and marked[5] == ("", False, False)


def test_profile_and_derivative(spark, judged):
    _, every = judged
    scores = {5: 0.9, 6: 0.2, 7: None, 9: 0.5}
    named = spark.createDataFrame(list(scores.items()), "doc_id long, score double")
    topics = {5: "a", 6: "a", 7: "b", 9: "b"}
    topic = F.when(F.col("doc_id") < 7, "a").otherwise("b")
    kept = every["exclude"].where("reason = ''").join(named, "doc_id").withColumns({"accepted": F.coalesce(F.col("score") >= 0.5, F.lit(True)), "topic": topic})
    got = {(x.part, x.name): x.value for x in candidates.profile(every["exclude"], kept, "doc_id", F.regexp_count("text", F.lit(r"\S+"))).collect()}
    words = {x.doc_id: len(x.text.split()) + 1 for x in kept.collect()}
    want = {("dropped", k): n for k, n in Counter(["legacy_exact_overlap", "legacy_near_overlap", "too_short", "too_short", "poison_repetition"]).items()}
    for name, own in (("", {5, 6, 7, 9}), ("accepted_", {5, 7, 9})):
        for t in "ab":
            want |= {(f"topic_{name}docs", t): sum(topics[k] == t for k in own), (f"topic_{name}tokens", t): sum(words[k] for k in own if topics[k] == t)}
    want |= {("count", k): n for k, n in {"documents": 4, "accepted": 3, "refused": 1, "exact": 1, "near": 1}.items()}
    want |= {("score", k): n for k, n in {"p0": 0.2, "p10": 0.2, "p50": 0.5, "p90": 0.9, "p100": 0.9}.items()}
    assert got == want
    reasons = lambda gate: {x.doc_id: x.reason for x in candidates.derivative(kept, ["b"], {"b": gate}).collect()}
    assert reasons(F.col("doc_id") == 9) == {5: "other_topic", 6: "quality_proxy", 7: "low_precision", 9: ""}


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    every = candidates.admitted(none, none, "doc_id", "lang")
    assert every.count() == 0
    kept = every.withColumns({"score": F.lit(None).cast("double"), "accepted": F.lit(True), "topic": F.lit("")})
    got = {(x.part, x.name): x.value for x in candidates.profile(every, kept, "doc_id", F.length("text")).collect()}
    assert got == {("count", k): 0 for k in ("documents", "accepted", "refused", "exact", "near")} | {("score", k): None for k in ("p0", "p10", "p50", "p90", "p100")}
