"""Operators on small tables, against plain versions."""

import hashlib
import random

import pytest

from pyspark.sql import functions as F

from sparkmill.operators import dedup, joins, policy, reports, windows
from sparkmill.sources import readers, writers
from sparkmill.streaming import jobs


def texts(n=40, seed=1):
    r = random.Random(seed)
    base = [" ".join(f"word{r.randrange(3000)}" for _ in range(300)) for _ in range(12)]
    rows = []
    for k in range(n):
        w = r.choice(base).split()
        kind = r.random()
        if kind < 0.5:
            w[r.randrange(len(w))] = "edited"
        elif kind < 0.7:
            w = ["a", "prefix", "of", "words"] + w
        rows.append((k, " ".join(w)))
    return rows


def test_near_dedup_is_greedy_in_order(spark):
    df = spark.createDataFrame(texts(), "ord long, text string")
    signs = {r.ord: (r.key, tuple(r.sig)) for r in dedup.signed(df).collect()}
    accepted, seen, want = [], set(), {}
    for k in sorted(signs):
        key, sig = signs[k]
        if key in seen:
            want[k] = "exact_duplicate"
        elif any(sum(a == b for a, b in zip(sig, signs[j][1], strict=True)) >= 6 for j in accepted):
            want[k] = "near_duplicate"
        else:
            want[k] = "accepted"
            accepted.append(k)
            seen.add(key)
    got = {r.ord: r.decision for r in dedup.near_dedup(df, "ord").collect()}
    assert got == want and "near_duplicate" in want.values()


def test_containment_against_brute_force(spark, monkeypatch):
    r = random.Random(4)
    signatures = [(k, "".join(r.choice("abcdefgh") for _ in range(r.randint(20, 60)))) for k in range(15)]
    docs = [(k, "".join(r.choice("abcdefgh") for _ in range(r.randint(0, 700))) + (signatures[k % 15][1] + signatures[k % 7][1] if k % 3 == 0 else "") + "tail" * (k % 4)) for k in range(60)] + [(99, None)]
    want = {(d, s) for d, t in docs for s, q in signatures if len(q) >= 24 and q in (t or "")}
    d, q = spark.createDataFrame(docs, "doc long, key string"), spark.createDataFrame([(s, s % 3, x) for s, x in signatures], "sid long, rank long, skey string")
    for most in (1_000_000, 0):
        monkeypatch.setattr(joins, "ANCHORS", most)
        assert {(x.doc, x.sid) for x in joins.contained(d, q, "doc").collect()} == want and len(want) > 10
        text = dict(docs)
        key = dict(signatures)
        place = lambda i, s: (s % 3, text[i].find(key[s][(len(key[s]) - 24) // 2 :][:24]), s)
        assert {x.doc: x.sid for x in joins.decontaminate(d, q, "doc").collect()} == {i: min((s for j, s in want if j == i), key=lambda s, i=i: place(i, s)) for i in {i for i, _ in want}}


def test_quotas_and_remainders(spark):
    df = spark.createDataFrame([(k, "a" if k % 2 else "b", 3 + k % 4) for k in range(20)], "id long, b string, n long").withColumn("q", F.lit(17))
    cut = windows.under_quota(df, "b", ["id"], "n", "q").groupBy("b").agg(F.sum("accepted").alias("s")).collect()
    assert {r.s for r in cut} == {17}
    plan = spark.createDataFrame([("x", 0.51), ("y", 0.29), ("z", 0.20)], "name string, f double")
    assert {r.name: r.quota for r in windows.largest_remainder(plan, F.lit(10), "f", "name", []).collect()} == {"x": 5, "y": 3, "z": 2}
    rows = spark.range(11)
    assert [r.id for r in windows.evenly_spaced(rows, ["id"], 5).orderBy("id").collect()] == [0, 2, 5, 7, 10]
    assert [r.id for r in windows.evenly_spaced(rows, ["id"], 1, "even").collect()] == [5]


def test_windows_pack_and_split(spark):
    df = spark.createDataFrame([("s", k, list(range(k * 10, k * 10 + k % 7))) for k in range(30)], "shard string, id long, t array<int>")
    flat = [x for k in range(30) for x in range(k * 10, k * 10 + k % 7)]
    got = {r.window: r.tokens for r in windows.pack_windows(df, "shard", ["id"], "t", 8).collect()}
    assert got == {k: flat[k * 8 : k * 8 + 8] for k in range(len(flat) // 8)}
    for n, sizes in ((0, [0]), (5, [5]), (10, [10]), (12, [12]), (15, [10, 5]), (23, [10, 13]), (26, [10, 10, 6])):
        out = spark.range(1).select(windows.split_long(F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>"), 10, 4).alias("c")).first().c
        assert [len(c) for c in out] == sizes and [x for c in out for x in c] == list(range(1, n + 1))


def test_length_batches_against_the_plain_walk(spark):
    r = random.Random(9)
    items = [(k, r.choice([5, 5, 5, 40, 41, 300, r.randint(1, 90)])) for k in range(400)] + [(999, 0)]
    order = sorted(items, key=lambda x: (-x[1], x[0]))
    want, at = {}, 0
    b = 0
    while at < len(order):
        width = order[at][1]
        n = max(1, min(256 // max(width, 1), 12))
        for k, _ in order[at : at + n]:
            want[k] = (b, width)
        at, b = at + n, b + 1
    got = windows.length_batches(spark.createDataFrame(items, "id long, n long"), "n", "id", 256, 12).collect()
    assert {x.id: (x.batch, x.width) for x in got} == want and len({x.place for x in got}) == b
    assert windows.length_batches(spark.createDataFrame([], "id long, n long"), "n", "id", 256, 12).count() == 0


def test_wide_index_and_overlap_against_brute_force(spark):
    r = random.Random(5)
    base = [[r.getrandbits(60) for _ in range(64)] for _ in range(6)]
    rows = []
    for k in range(90):
        own = list(r.choice(base))
        for _ in range(r.choice([0, 3, 14, 16, 17, 30])):
            own[r.randrange(64)] = r.getrandbits(60)
        rows.append((k, own))
    rows += [(200, [])]
    got = {(x.a, x.b, x.shared) for x in dedup.wide_pairs(spark.createDataFrame(rows, "id long, sig array<bigint>"), "id").collect()}
    first = {}
    for k, s in rows:
        first.setdefault(tuple(s), k)
    full = [(k, s) for s, k in first.items() if s]
    want = {(min(i, j), max(i, j), n) for i, a in full for j, b in full if i < j and (n := sum(x == y for x, y in zip(a, b, strict=True))) >= 48}
    assert got == want and len(want) > 30


def test_hot_keys_are_joined_whole(spark):
    rows = spark.createDataFrame([(k, "hot" if k % 3 else f"k{k}") for k in range(3000)], "id long, key string")
    named = rows.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    got = dedup.join_counted(rows, named, "key", "n")
    assert got.columns == ["key", "id", "first"] and got.count() == 3000
    assert {x.first for x in got.where("key = 'hot'").collect()} == {1}


def test_policy_targets_and_checks(spark):
    groups = [policy.Group("a", 0.5, "c"), policy.Group("b", 0.2, "c"), policy.Group("c", 0.3, "", fill=True)]
    assert policy.targets(groups, {"a": 30, "b": 100, "c": 90}, 100) == {"a": 30, "b": 20, "c": 50}
    with pytest.raises(ValueError):
        policy.targets(groups, {"a": 30, "b": 100, "c": 40}, 100)
    supply = spark.createDataFrame([("s1", 10, "a"), ("s2", 20, "a"), ("s3", 33, "b"), ("s4", 67, "b"), ("s5", 20, "c"), ("s6", 70, "c")], "source string, tokens long, group string")
    got = {r.source: r.target for r in policy.materialized(supply, groups, 100).collect()}
    assert got == {"s1": 10, "s2": 20, "s3": 6, "s4": 14, "s5": 20, "s6": 30}
    shares = spark.createDataFrame([("x", 0.5), ("y", 0.3), ("y", 0.2)], "source string, f double")
    bad = {r.name: r.passed for r in policy.violations(shares, "source", "f", 0.4, [policy.Limit("few", ("y",), least=0.4), policy.Limit("half", ("x",), exactly=0.6)]).collect()}
    assert bad == {"fractions_sum_to_one": True, "source_maximum": False, "few": True, "half": False, "unique_only": False}
    plan = spark.createDataFrame([("x", 10), ("y", 20), ("z", 30)], "source string, quota long")
    done = spark.createDataFrame([("x", 14)], "source string, done long")
    assert {r.source: r.remaining for r in policy.remaining(plan, done, "source").collect()} == {"x": 0, "y": 20, "z": 26}


def test_manifests_pins_and_lineage(spark, tmp_path):
    quotas = spark.createDataFrame([("x", 10), ("y", 20)], "source string, quota long")
    parts = spark.createDataFrame([("x", 4), ("x", 6), ("y", 19)], "source string, quota long")
    supply = spark.createDataFrame([("x", 9), ("y", 50)], "source string, supply long")
    files = spark.createDataFrame([("x", 5, 20), ("x", 2, 7), ("y", 3, 12)], "source string, tokens long, bytes long")
    got = {r.source: (r.quotas_agree, r.supply_holds, r.bytes_agree) for r in reports.manifest_check(quotas, parts, supply, files, "source").collect()}
    assert got == {"x": (True, False, False), "y": (False, True, True)}
    marks = spark.createDataFrame([("a", "s", "1"), ("a", "t", "1"), ("b", "s", "1"), ("b", "t", "2"), ("c", "s", "1")], "label string, stage string, fingerprint string")
    assert {r.label: (r.equal, r.complete, r.passed) for r in reports.lineage_check(marks, ["s", "t"]).collect()} == {"a": (True, True, True), "b": (False, True, False), "c": (True, False, False)}
    (tmp_path / "asset=one").mkdir()
    (tmp_path / "asset=one" / "part-0").write_text("a\n\nb\n")
    have = readers.text_assets(spark, str(tmp_path), r"asset=([^/]+)/")
    sha = hashlib.sha256(b"a\n\nb\n").hexdigest()
    for rows, want in (([("one", sha.upper(), 2)], "matched"), ([("one", sha, 3)], "rows_drift"), ([("one", "0" * 64, 2)], "sha256_drift"), ([("two", sha, 2)], "missing"), ([("one", sha, 2), ("one", sha, 2)], "duplicate")):
        assert [r.status for r in joins.asset_pins(spark.createDataFrame(rows, "asset string, sha256 string, rows long"), have).collect()] == [want]


def test_benchmark_tables(spark, tmp_path):
    (tmp_path / "law" / "dev").mkdir(parents=True)
    (tmp_path / "law" / "dev" / "x.csv").write_text('id,Question,A,b,C,D,Answer\n1,"Why, ""so""?",yes,no, ,,b\n2, ,x,y,,,A\n3,Who?,x,y,z,w,E\n')
    got = readers.read_benchmark_tables(spark, [str(tmp_path / "law")], []).orderBy("id").collect()
    assert [(r.id, r.subject, r.split, r.question, r.choices, r.answer) for r in got] == [("1", "law", "dev", 'Why, "so"?', {"A": "yes", "B": "no"}, "B"), ("3", "law", "dev", "Who?", {"A": "x", "B": "y", "C": "z", "D": "w"}, "")]


def test_thresholds_match_direct_counts(spark):
    r = random.Random(2)
    rows = [(r.random(), int(r.random() < 0.4)) for _ in range(300)] + [(0.05, 1), (0.5, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    for t in reports.threshold_table(df).collect():
        cut = t.threshold - 5e-12
        assert (t.tp, t.fp) == (sum(s >= cut and y == 1 for s, y in rows), sum(s >= cut and y == 0 for s, y in rows))


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"text": "x"}\n[1]\n3\n{broken\n\n{"text": " "}\n{"other": 1}\n')
    got = readers.jsonl_stats(spark, [str(tmp_path / "a.jsonl")]).first()
    assert (got.lines, got.decoded, got.decode_errors, got.non_object, got.missing_field, got.empty, got.yielded) == (6, 5, 1, 2, 1, 1, 1)
    df = spark.createDataFrame([("a" * 64, "low"), ("b" * 64, "high"), ("a" * 64, "high")], "sha256 string, reason string")
    writers.write_exclusion_manifest(df, at := str(tmp_path / "m"))
    back = writers.read_exclusion_manifest(spark, at)
    assert sorted(map(tuple, back.collect())) == [("a" * 64, "high"), ("b" * 64, "high")]
    assert all(r.passed for r in writers.manifest_violations(back, 2).collect())
    wrong = {r.name: r.passed for r in writers.manifest_violations(df, 5).collect()}
    assert not wrong["unique"] and not wrong["count"]
    code = tmp_path / "code"
    (code / "vendor").mkdir(parents=True)
    (code / "a.py").write_bytes(b"print(1)\r\nprint(2)\r\n")
    (code / "b.py").write_bytes(b"print(1)\nprint(2)\n")
    (code / "c.py").write_bytes(b"\xff\xfe broken")
    (code / "vendor" / "d.py").write_bytes(b"print('vendored code')")
    found = readers.read_code_files(spark, str(code), [".py"], ["/vendor/"], 1000, 5).collect()
    assert [(r.path.rsplit("/", 1)[1], r.text) for r in found] == [("a.py", "print(1)\nprint(2)\n")]


def test_streams_take_each_file_once(spark, tmp_path):
    schema = "doc_id long, text string"
    long = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    spark.createDataFrame([(1, long(1)), (2, long(1)), (3, "short")], schema).coalesce(1).write.parquet(f"{tmp_path}/in/a")
    run = lambda: jobs.stream_clean(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, f"{tmp_path}/state")
    run()
    spark.createDataFrame([(4, long(1)), (5, long(2))], schema).coalesce(1).write.parquet(f"{tmp_path}/in/b")
    run()
    got = [r.doc_id for r in spark.read.parquet(f"{tmp_path}/state/accepted").orderBy("doc_id").collect()]
    assert got == [1, 5]
    try:
        jobs.stream_clean(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, f"{tmp_path}/state", min_chars=10)
    except ValueError:
        return
    raise AssertionError("changed settings must be refused")


def test_spread_on_the_bound_does_not_follow_the_order(spark):
    orders = [[38, 38, 28, 28], [38, 28, 28, 38], [28, 28, 38, 38], [1, 11], [1.5, 11.5], [1, 10.99], [0.07, 10.07], [7], [None, None], [1, None, 11], [1e12, 1e12 + 10], [0.001, 10.001], [float("nan"), 1]]
    rows = [(k, i, x if x is None else float(x)) for k, o in enumerate(orders) for i, x in enumerate(o)]
    df = spark.createDataFrame(rows, "k int, i int, x double").coalesce(1)
    got = {r.k: r.s for r in df.groupBy("k").agg(reports.spread_at_least(F.col("x"), 5).alias("s")).collect()}
    assert [got[k] for k in range(len(orders))] == [True, True, True, True, True, False, True, False, None, True, True, True, True]
