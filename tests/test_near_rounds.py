"""Near copies: prefix keys, decisions in few rounds, and the stream that keeps them, against plain versions."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from sparkmill.operators import dedup, joins
from sparkmill.streaming import jobs


def signatures(r, n, pool=6):
    """Signatures of eight coordinates: families that share some, and one hot passage in three coordinates of many."""
    out = []
    base = [[r.randrange(10**9) for _ in range(8)] for _ in range(pool)]
    for _ in range(n):
        s = list(r.choice(base))
        for k in r.sample(range(8), r.choice([0, 1, 2, 3, 8])):
            s[k] = r.randrange(10**9)
        if r.random() < 0.5:
            s[:3] = [1, 2, 3]
        out.append(s)
    return out


def equal(x, y):
    return sum(a == b for a, b in zip(x, y, strict=True))


def test_near_pairs_are_all_and_hot_bands_make_none(spark):
    r = random.Random(1)
    rows = list(enumerate(signatures(r, 400)))
    got = {(x.a, x.b): x.similarity for x in dedup.near_pairs(spark.createDataFrame(rows, "doc_id long, sig array<long>"), "doc_id").collect()}
    first = {}
    for i, s in rows:
        first.setdefault(tuple(s), i)
    want = {(i, j): equal(x, y) / 8 for (x, i), (y, j) in itertools.combinations(first.items(), 2) if equal(x, y) >= 6}
    assert got == want and len(want) > 100
    hot = [[7, 8, 9, 10, *(r.randrange(10**12) for _ in range(4))] for _ in range(10_000)]
    keys = dedup.prefix_keys(spark.createDataFrame([(s,) for s in hot], "sig array<long>"), "sig", 6, 8)
    assert keys.count() == 0  # two whole bands in common, and nothing meets


def test_wide_pairs(spark):
    r = random.Random(2)
    base = [[r.randrange(10**9) for _ in range(64)] for _ in range(4)]
    rows = []
    for k in range(120):
        s = list(r.choice(base))
        for c in r.sample(range(64), r.choice([0, 5, 15, 16, 17, 20])):
            s[c] = r.randrange(10**9)
        rows.append((k, s))
    got = {(x.a, x.b, x.shared) for x in dedup.wide_pairs(spark.createDataFrame(rows, "doc_id long, sig array<long>"), "doc_id").collect()}
    first = {}
    for i, s in rows:
        first.setdefault(tuple(s), i)
    want = {(i, j, equal(x, y)) for (x, i), (y, j) in itertools.combinations(first.items(), 2) if equal(x, y) >= 48}
    assert got == want and want


def test_near_overlap(spark):
    r = random.Random(3)
    new, old = (list(enumerate(signatures(random.Random(k), 150))) for k in (5, 5))
    old = [(i, s[:6] + [r.randrange(10**9), r.randrange(10**9)] if i % 3 else s) for i, s in old if i % 2]
    df = lambda rows: spark.createDataFrame(rows, "doc_id long, sig array<long>")
    got = {x.doc_id for x in joins.near_overlap(df(new + [(999, [])]), df(old + [(1, [])]), "doc_id").collect()}
    assert got == {i for i, s in new if any(equal(s, t) >= 6 for _, t in old)}


def plain_decisions(pairs):
    earlier, accepted = {}, set()
    for a, b in pairs:
        earlier.setdefault(b, set()).add(a)
        earlier.setdefault(a, set())
    for n in sorted(earlier):
        if not earlier[n] & accepted:
            accepted.add(n)
    return {n: 1 if n in accepted else 2 for n in earlier}


@pytest.mark.parametrize(("chain", "part"), [(500_000, 50_000), (50, 60)])
def test_decisions_in_few_rounds(spark, monkeypatch, chain, part):
    monkeypatch.setattr(dedup, "CHAIN", chain)
    monkeypatch.setattr(dedup, "PART", part)
    r = random.Random(4)
    pairs = {(k, k + 1) for k in range(200 if part < 100 else 10_000)}
    pairs |= {(20_000 + a, 20_000 + b) for a, b in itertools.combinations(range(25), 2)}
    pairs |= {tuple(sorted(r.sample(range(30_000, 30_200), 2))) for _ in range(260)}
    written = []
    plain = dedup.written
    monkeypatch.setattr(dedup, "written", lambda df, name: written.append(name) or plain(df, name))
    got = {x.n: x.s for x in dedup.first_independent(spark.createDataFrame(sorted(pairs), "a long, b long")).collect()}
    assert got == plain_decisions(pairs)
    assert part < 100 or len(written) < 25  # not one for each of 10,000 steps


def documents(r, n):
    words = [f"word{k}" for k in range(3000)]
    out = []
    for k in range(n):
        if k > 5 and r.random() < 0.5:
            w = r.choice(out).split(" ")
            for _ in range(r.choice([0, 0, 1, 3])):
                w[r.randrange(len(w))] = r.choice(words)
        else:
            w = r.choices(words, k=r.randrange(30, 120))
        out.append(" ".join(w))
    return out


def test_stream_decides_as_the_batch_and_survives_a_restart(spark, tmp_path):
    r = random.Random(6)
    rows = [(k, t) for k, t in enumerate(documents(r, 240))] + [(240, "short"), (241, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = dedup.near_dedup(docs.where(F.length("text") >= 150), "doc_id").where("decision = 'accepted'")
    want = {x.doc_id for x in whole.collect()}
    assert 40 < len(want) < 200
    source, state = f"{tmp_path}/in", f"{tmp_path}/state"
    for part in range(2):
        for k in range(part * 2, part * 2 + 2):
            docs.where(f"doc_id div 61 = {k}").coalesce(1).write.mode("append").parquet(source)
            jobs.stream_clean(spark, source, docs.schema, state, 150)
    got = [x.doc_id for x in spark.read.schema(jobs.ACCEPTED).parquet(f"{state}/accepted").collect()]
    assert sorted(got) == sorted(want)
    jobs.stream_clean(spark, source, docs.schema, state, 150)  # nothing new
    assert spark.read.schema(jobs.ACCEPTED).parquet(f"{state}/accepted").count() == len(want)
    with pytest.raises(ValueError, match="settings"):
        jobs.stream_clean(spark, source, docs.schema, state, 151)


def test_wide_signatures_stand_under_names(spark):
    base = [list(range(64)), [*range(48), *range(100, 116)], list(range(1000, 1064)), [*range(1000, 1060), 1, 2, 3, 4]]
    rows = [(1, base[0]), (1, base[1]), (2, base[2]), (3, base[3]), (4, base[3]), (5, [])]  # an id that repeats stands for two
    before = set(os.listdir(dedup.shared(spark)))
    got = dedup.wide_pairs(spark.createDataFrame(rows, "doc_id long, sig array<long>"), "doc_id").collect()
    assert [(x.a, x.b, x.shared) for x in got] == [(2, 3, 60)]
    made = [x for x in set(os.listdir(dedup.shared(spark))) - before if x.startswith(("keys-", "coordinates-", "pairs-"))]
    assert len(made) == 3 and not any("array" in kind for x in made for _, kind in spark.read.parquet(f"{dedup.shared(spark)}/{x}").dtypes)
