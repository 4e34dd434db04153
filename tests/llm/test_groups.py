"""Centroid clustering, embedding near-dedup and spelling variants against plain versions."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkmill.llm import centroids, queries, spelling, vector_copies

EMBEDDINGS = "vec_id long, embedding array<float>, label int, cluster string, `n` int"


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, sha(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, w, strict=True)), j) for j, w in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        c = [[sum(x) // len(x) for x in zip(*vs, strict=True)] if (vs := [v for (_, v), j in zip(kept, own, strict=True) if j == n]) else w for n, w in enumerate(c)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in last:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in last), key=repr)


def vectors(seed, n=300):
    r = np.random.default_rng(seed)
    v = r.normal(size=(12, 64))[r.integers(0, 12, n)] * r.choice([0.2, 1.0], size=(n, 1)) + r.normal(size=(n, 64)) * r.choice([0.0, 0.05, 0.3], size=(n, 1))
    rows = [(int(k), x.astype(np.float32).tolist(), int(r.integers(0, 3)), "x", 1) for k, x in enumerate(v)]
    odd = [(900, None, 1, None, None), (901, [0.0] * 64, 1, None, None), (902, [math.nan] + [1.0] * 63, 1, None, None), (903, [1.0] * 8, 1, None, None), (904, [2.0] * 8, 1, None, None), (905, rows[0][1], None, None, None), (906, [None] + [1.0] * 63, 1, None, None), (907, [], 1, None, None)]
    again = [(5, rows[5][1], rows[5][2], None, None), (5, rows[6][1], 0, None, None), (None, rows[7][1], rows[7][2], None, None), (None, [3.0] * 16, 1, None, None)]
    return rows + odd + again


@pytest.mark.parametrize("k", [40, 3])
def test_clusters(spark, k):
    rows = vectors(k)
    df = spark.createDataFrame(rows, EMBEDDINGS)
    got = [(x.vec_id, x.cluster, x.distance, x.cluster_inertia, x.inertia, x.centroid_sha256) for x in centroids.cluster(df, k=k).collect()]
    assert sorted(got, key=repr) == plain_clusters([r[:2] for r in rows], k, 5)


def test_clusters_of_few_equal_and_no_vectors(spark):
    one = [(k, [0.5] * 64, 1, "x", 1) for k in range(7)]
    got = centroids.cluster(spark.createDataFrame(one, EMBEDDINGS)).collect()
    assert {(x.cluster, x.distance) for x in got} == {(0, 0)} and len(got) == 7
    assert centroids.cluster(spark.createDataFrame([], EMBEDDINGS)).count() == 0
    wide = spark.createDataFrame([(1, [1e9] * 64, 1, "x", 1)], EMBEDDINGS)
    assert centroids.cluster(wide).count() == 0


@pytest.mark.parametrize("leaf", [1, 4])
def test_tree_finds_the_nearest_and_prunes(leaf):
    r = np.random.default_rng(leaf)
    for dims, spread in ((2, 40), (1, 3), (64, 50)):
        points = r.integers(-spread, spread, (200, dims))
        points[50:60] = points[50]
        x = np.vstack([r.integers(-spread, spread, (500, dims)), points])
        who, d, computed = centroids.VantageTree(points, leaf).nearest(x)
        plain = ((x[:, None] - points[None]) ** 2).sum(axis=2)
        assert (d == plain.min(axis=1)).all() and (who == plain.argmin(axis=1)).all()
        assert dims == 64 or computed < 0.4 * plain.size


def plain_links(rows, least=0.93):
    good = [(k, label, np.array(v, dtype=float)) for k, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    link = {k: set() for k in range(len(rows))}
    for (a, la, x), (b, lb, y) in itertools.combinations(good, 2):
        if la == lb and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
            link[a].add(b)
            link[b].add(a)
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, edge = {k}, [k]
        while edge:
            new = link[edge.pop()] - seen
            seen |= new
            edge += new
        root = min((rows[s][0] for s in seen if rows[s][0] is not None), default=None)
        out.append((i, len(link[k]), root, i is not None and i == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [512, 7])
def test_vector_copies(spark, tile):
    rows = vectors(3)
    got = [tuple(x) for x in vector_copies.near_groups(spark.createDataFrame(rows, EMBEDDINGS), tile=tile).collect()]
    want = plain_links([r[:3] for r in rows])
    assert sorted(got, key=repr) == want and sum(w[1] > 5 for w in want) > 50 and sum(w[1] == 0 for w in want) > 50


def test_vector_copies_of_large_groups_ties_and_nothing(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=64)
    rows = [(k, (base + 0.1 * r.normal(size=64)).tolist(), 1, "x", 1) for k in range(150)] + [(200 + k, base.tolist(), 1, "x", 1) for k in range(50)]
    rows += [(1000 + k, [1e30 * (k % 2 * 2 - 1), 1e30 * (k + 1)], 1, "x", 1) for k in range(60)]
    got = sorted((tuple(x) for x in vector_copies.near_groups(spark.createDataFrame(rows, EMBEDDINGS.replace("float", "double")), tile=16).collect()), key=repr)
    assert got == plain_links([r[:3] for r in rows])
    assert vector_copies.near_groups(spark.createDataFrame([], EMBEDDINGS)).count() == 0
    flat = [(k, [float(k + 1)], 1, "x", 1) for k in range(40)] + [(50 + k, [-float(k + 1)], 1, "x", 1) for k in range(40)]  # one coordinate: all tie
    got = {x.vec_id: x for x in vector_copies.near_groups(spark.createDataFrame(flat, EMBEDDINGS), tile=8).collect()}
    assert all((x.n_links, x.component_id) == (39, 0 if k < 50 else 50) for k, x in got.items()) and len(got) == 80


def test_products_stop_early_and_lose_nothing():
    r = np.random.default_rng(5)
    u = vector_copies.unit(np.vstack([r.normal(size=(300, 24)) * np.linspace(3, 0.1, 24), r.normal(size=(5, 24))]))
    v = vector_copies.unit(np.vstack([u[:40] + 0.05 * r.normal(size=(40, 24)), r.normal(size=(100, 24))]))
    i, j = vector_copies.close(u, v, 0.9)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(u @ v.T >= 0.9)), strict=True))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_words(rows):
    import regex

    n = Counter()
    for i, t in rows:
        for w in regex.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def plain_variants(n):
    near = {w: [] for w in n}
    for a, b in itertools.combinations(n, 2):
        if abs(len(a) - len(b)) < 2 and distance(a, b) == 1:
            near[a].append(b)
            near[b].append(a)
    form = {w: f if ns and n[f := min(ns, key=lambda x: (-n[x], x))] >= 2 * n[w] else None for w, ns in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def test_spelling_of_dense_words(spark):
    r = random.Random(1)
    made = {"".join(r.choice("aabcé") for _ in range(r.randrange(5, 9))) for _ in range(700)} | {"aaaaa", "aaaaaa", "aaaaaaa", "ababa", "bababa"}
    n = {w: 3 * 2 ** r.randrange(0, 7) + r.randrange(2) for w in made}
    got = [tuple(x) for x in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()]
    want = plain_variants(n)
    assert sorted(got) == want and sum(w[4] for w in want) > 1000 and any(w[1] and w[2] != w[1] for w in want)


def test_words_and_their_keys_are_not_broadcast(spark):
    words = spelling.materialize(spark.createDataFrame([(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}", k + 3) for k in range(300)], "word string, n long"), "words")
    for out in (spelling.near_pairs(words), spelling.variants(words)):
        assert out.count() and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


def test_spelling_of_texts(spark):
    r = random.Random(4)
    stems = ["straße", "général", "ordinary", "ordnary", "ordinarys", "Window", "wïndow", "übergang", "ubergang", "×÷×÷×", "short", "abcd", "_under_score_"]
    rows = [(k, " ".join(r.choice(stems) + r.choice(["", "", "s", "."]) for _ in range(r.choice([0, 30, 200])))) for k in range(60)]
    rows += [(61, None), (62, ""), (None, "straße window ordinary " * 3), (3, rows[3][1]), (64, "ordinary straße " * 30_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = [tuple(x) for x in spelling.variants(spelling.counted(df)).collect()]
    want = plain_variants(plain_words(rows))
    assert sorted(got) == want and any(w[1] for w in want)
    assert spelling.variants(spelling.counted(df.where("false"))).count() == 0


def test_pivots_by_dynamic_programming():
    count = {"ab": 1, "bc": 2, "cd": 3, "de": 9}
    grams, last = spelling.prefix("abcde", count)
    assert [p for _, p in grams] == [0, 1, 2] and last == (3, "cd") and spelling.pivots(grams) == [0, 2]
    r = random.Random(2)
    for _ in range(200):
        g = [((r.randrange(9), str(p)), p) for p in sorted(r.sample(range(12), 6))]
        best = min((sum(n for (n, _), _ in c) for c in itertools.combinations(g, 2) if c[1][1] - c[0][1] >= 2), default=None)
        got = spelling.pivots(g)
        assert best is not None and sum(dict((p, n) for (n, _), p in g)[p] for p in got) == best and got[1] - got[0] >= 2


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_vector_copies", "op13_spelling_variants"])
def test_registered(spark, tmp_path, name):
    spark.createDataFrame(vectors(9, 120), EMBEDDINGS).write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(k, "plain words plain wordz " * (k + 1)) for k in range(6)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES[name](spark, str(tmp_path))
    got = sorted((tuple(x) for x in out.collect()), key=repr)
    rows = vectors(9, 120)
    if name.startswith("op11"):
        assert got == plain_clusters([r[:2] for r in rows], 40, 5)
    elif name.startswith("op12"):
        assert got == plain_links([r[:3] for r in rows])
    else:
        assert got == plain_variants(plain_words([(k, "plain words plain wordz " * (k + 1)) for k in range(6)]))
